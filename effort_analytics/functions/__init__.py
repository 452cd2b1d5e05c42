"""Column-level building blocks (``Column -> Column``), all built-in Spark expressions."""

from .dates import (date_key, day_name, is_weekend, month_name, month_start, quarter_name,
                    to_date_safe, year_month, year_month_text)
from .numbers import PLAIN_NUMBER, hours_decimal, safe_cast, seconds_to_hours, whole_number
from .status import (code_found_flag, issue_completed_date, issue_productive_date, issue_progress,
                     issue_status, planner_productive_date, planner_progress, planner_status,
                     productivity_class)
from .text import (blank_to_null, bracket_code, bracketed, charindex, full_name, normalized,
                   not_in_normalized, not_like_prefix, split_name_id)

__all__ = [n for n in dir() if not n.startswith("_")]

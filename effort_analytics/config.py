"""Business constants and table specs.

Every literal the published numbers depend on lives here and is passed to the
library functions as a keyword default, so a caller can override any of them
(run date, thresholds, vocabularies) without editing code.
"""

from __future__ import annotations

import datetime as _dt
import json
from dataclasses import dataclass, field
from decimal import Decimal

# ---------------------------------------------------------------------------
# These must equal the values the original notebooks use, or the
# published facts change. Listed plainly, in the order the notebooks use them.
# ---------------------------------------------------------------------------

# audit
UPLOADER = "svc_load"

# planner progress vocabulary (text progress -> status)
PLANNER_PROGRESS_STATUS = {"0": "Not Started", "50": "In Progress", "100": "COMPLETED"}
STATUS_NOT_STARTED = "Not Started"
STATUS_IN_PROGRESS = "In Progress"
STATUS_COMPLETED = "COMPLETED"
STATUS_UNKNOWN = "NOT RECOGNIZED PLEASE CONTACT ADMIN"
PLANNER_DONE_PROGRESS = "100"

# issue-tracker vocabulary
ISSUE_TODO = "To Do"
ISSUE_IN_PROGRESS = ("In Progress", "In Review")
ISSUE_DONE = "Done"
ISSUE_PLANNER_CODE = "CXMRA BAU"
ISSUE_BUCKET_ID = "CbLSYAsOKUCI457rdCaIEmQAMH40"
ISSUE_EXCLUDED_PROJECT_PREFIX = "Generated"
SECONDS_PER_HOUR = 3600

# completed-task filter of the published facts
COMPLETED_PROGRESS = 100
MIN_REPORT_YEAR = 2021

# leave handling
LEAVE_HOURS_PER_UNIT = Decimal("7.5")
HOLIDAY_LEAVE_PREFIX = "Business Unit Holiday"
UNPLANNED_LEAVE_TYPES = ("SICK DAY", "EMERGENCY LEAVE", "PHILIPPINES UNPAID TIME OFF")

# targets
HOURS_PER_WORKING_DAY = Decimal("7.5")
UNDER_TARGET_RATIO = Decimal("0.75")

# productivity class
ADMIN_CATEGORY = "Admin"
LEADS_CODE = "LEADS"
PRODUCTIVE = "Productive"
NONPRODUCTIVE = "Nonproductive"

# planner-code check flag
CODE_FOUND = "Yes"
CODE_MISSING = "No"

# members
OPEN_END_DATE = _dt.date(9999, 12, 31)
OPEN_END_DATE_TEXT = "9999-12-31"

# calendar dimension
CALENDAR_DEFAULT_START_YEAR = 1955
CALENDAR_YEARS_AHEAD = 2
CALENDAR_EFFECTIVE_DATE = _dt.date(1900, 1, 1)
CALENDAR_EXPIRY_DATE = _dt.date(9999, 12, 31)
HOLIDAY_REGIONS = ("HK", "ID", "JP", "PH", "SG", "VN", "CDN", "USA")

# workbook sheet names
SHEET_ISSUES = "CDO-SSR"
SHEET_LEAVES = "All Worker Time Off"
SHEET_MEMBERS = "Members v2"
SHEET_ROLES = "Roles"
SHEET_BUCKETS = "Buckets"
SHEET_PLANNER_CODES = "PlannerCodes"
SHEET_PRODUCTIVITY_TYPES = "ProductivityType"


# ---------------------------------------------------------------------------
# Table specs (driver-side configuration, never data)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class TableSpec:
    """Where a refined/published table comes from and goes to."""

    name: str
    src_paths: tuple[str, ...] = ()
    output_path: str = ""
    database: str = ""
    table: str = ""
    enabled: bool = True
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    @property
    def qualified_name(self) -> str:
        return f"{self.database}.{self.table}" if self.database else self.table


def load_table_specs(path: str, section: str = "refined_tables") -> dict[str, TableSpec]:
    """Read a JSON config of the form ``{section: {name: {...}}}`` into specs.

    Accepts ``src_path`` as a string or a list, and the key spellings used by
    the notebooks' config (``output_path``, ``dbx_db_name``, ``dbx_tbl_name``,
    ``isJobEnabled``).
    """
    with open(path, encoding="utf-8") as fh:
        raw = json.load(fh)
    specs = {}
    for name, entry in raw.get(section, {}).items():
        src = entry.get("src_path", ())
        src = (src,) if isinstance(src, str) else tuple(src)
        known = {"src_path", "output_path", "dbx_db_name", "dbx_tbl_name", "isJobEnabled"}
        specs[name] = TableSpec(
            name=name,
            src_paths=src,
            output_path=entry.get("output_path", ""),
            database=entry.get("dbx_db_name", ""),
            table=entry.get("dbx_tbl_name", name),
            enabled=str(entry.get("isJobEnabled", True)).lower() not in ("false", "0", "no"),
            extra={k: v for k, v in entry.items() if k not in known},
        )
    return specs

"""Numeric parsing that never raises under ANSI mode.

Spark 4 runs with ANSI casts, where ``CAST('' AS INT)`` raises. The notebooks
relied on the old NULL-on-failure casts, so every parse here is guarded by a
pattern and finished with ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ._util import ColumnOrName, as_col

HOURS_TYPE = DecimalType(10, 2)

# A plain decimal number: optional sign, digits with an optional point and
# fraction, or a point with optional digits; spaces around are allowed.
# No exponent, no thousands separator, at most one point.
PLAIN_NUMBER = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]*)\s*$"


def hours_decimal(text: ColumnOrName) -> Column:
    """Free-text hours to DECIMAL(10,2); anything that is not a plain number -> 0.

    ``7.5`` 7.50, ``.5`` 0.50, ``5.`` 5.00, ``.`` 0.00, ``' 3 '`` 3.00,
    ``-.5`` -0.50, ``7.555`` 7.56; ``''``, ``abc``, ``7,5``, ``1e2``, ``1.2.3``,
    NULL and values too wide for DECIMAL(10,2) -> 0.
    """
    h = as_col(text)
    parsed = F.coalesce(h.try_cast(HOURS_TYPE), F.lit(0).cast(HOURS_TYPE))
    return F.when(h.rlike(PLAIN_NUMBER), parsed).otherwise(F.lit(0).cast(HOURS_TYPE)).cast(HOURS_TYPE)


def seconds_to_hours(text: ColumnOrName) -> Column:
    """Seconds as text to hours DECIMAL(10,2) (exact decimal division, half-up).

    Non-numeric text, NULL and results wider than DECIMAL(10,2) -> 0.
    """
    s = as_col(text)
    secs = s.try_cast(DecimalType(20, 4))
    hours = (secs / F.lit(3600)).try_cast(HOURS_TYPE)
    return F.when(s.rlike(PLAIN_NUMBER), F.coalesce(hours, F.lit(0).cast(HOURS_TYPE))).otherwise(
        F.lit(0).cast(HOURS_TYPE)
    ).cast(HOURS_TYPE)


def whole_number(text: ColumnOrName, to: str = "bigint") -> Column:
    """Number text to a whole number, the fraction cut off; anything that is not
    a plain number, and values too wide for ``to`` -> NULL.

    ``50`` 50, ``50.0`` 50, ``1.5`` 1, ``-1.9`` -1, ``.5`` 0, ``' 3 '`` 3;
    ``''``, ``abc``, ``1e2``, NULL -> NULL.
    """
    t = as_col(text)
    digits = F.regexp_extract(t, r"^\s*([+-]?[0-9]*)", 1)
    digits = F.when(digits.isin("", "+", "-"), F.lit("0")).otherwise(digits)
    return F.when(t.rlike(PLAIN_NUMBER), digits.try_cast(to))


def safe_cast(text: ColumnOrName, to: str) -> Column:
    """``try_cast`` spelled as a library function (NULL instead of an error)."""
    return as_col(text).try_cast(to)

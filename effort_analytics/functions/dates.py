"""Date column expressions: keys, parts, names, weekend flag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import ColumnOrName, as_col


def to_date_safe(text: ColumnOrName) -> Column:
    """Text to DATE, NULL when it does not parse (accepts ISO date-times too)."""
    return as_col(text).try_cast("date")


def date_key(d: ColumnOrName) -> Column:
    """``yyyyMMdd`` as BIGINT, computed arithmetically (no string formatting)."""
    c = as_col(d)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("bigint")


def year_month(d: ColumnOrName) -> Column:
    """``yyyyMM`` as BIGINT -- the member-month join key."""
    c = as_col(d)
    return (F.year(c) * 100 + F.month(c)).cast("bigint")


def year_month_text(d: ColumnOrName) -> Column:
    """``yyyyMM`` as a string, as published (first six characters of the date key)."""
    return F.date_format(as_col(d), "yyyyMM")


def day_name(d: ColumnOrName) -> Column:
    return F.date_format(as_col(d), "EEEE")


def month_name(d: ColumnOrName) -> Column:
    return F.date_format(as_col(d), "MMMM")


def quarter_name(d: ColumnOrName) -> Column:
    """``Q<quarter>-<year>``, e.g. ``Q1-2021``."""
    c = as_col(d)
    return F.concat(F.lit("Q"), F.quarter(c).cast("string"), F.lit("-"), F.year(c).cast("string"))


def is_weekend(d: ColumnOrName) -> Column:
    """1 for Saturday/Sunday, else 0 (``dayofweek``: 1 = Sunday, 7 = Saturday)."""
    return F.when(F.dayofweek(as_col(d)).isin(1, 7), 1).otherwise(0)


def month_start(d: ColumnOrName) -> Column:
    return F.trunc(as_col(d), "MM")

"""Calendar dimension (generate, and upsert into an existing one).

Set-based: days come from ``spark.range`` (or, when the start depends on
the target's data, from one bounds row exploded with ``sequence``), never from a
driver loop. The calendar is small and bounded by its date range, which is what
lets the fact plans broadcast it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import date_key, day_name, is_weekend, month_name, quarter_name

CALENDAR_COLUMNS = [
    "DateKey", "IsCurrent", "EffectiveDate", "ExpiryDate", "CreatedDate", "CreatedBy",
    "ModifiedDate", "ModifiedBy", "DateShort", "DateYear", "DateQuarter", "DateQuarterName",
    "DateMonthNum", "DateMonthName", "DateDayNum", "DateDayName", "IsWeekend",
] + [f"IsHoliday_{r}" for r in C.HOLIDAY_REGIONS]

# the columns an existing day gets refreshed with (the rest is kept)
REFRESHED_COLUMNS = [
    "DateShort", "DateYear", "DateQuarter", "DateQuarterName", "DateMonthNum", "DateMonthName",
    "DateDayNum", "DateDayName", "IsWeekend", "ModifiedDate", "ModifiedBy",
]


def calendar_rows_bound(start: dt.date, end_exclusive: dt.date) -> int:
    """Upper bound on the rows of a generated calendar (days plus two sentinels)."""
    return max((end_exclusive - start).days, 0) + 2


def _calendar_columns(d: Column, run_at: Column, run_by: str) -> list[Column]:
    return [
        date_key(d).alias("DateKey"),
        F.lit(1).alias("IsCurrent"),
        F.lit(C.CALENDAR_EFFECTIVE_DATE).alias("EffectiveDate"),
        F.lit(C.CALENDAR_EXPIRY_DATE).alias("ExpiryDate"),
        run_at.alias("CreatedDate"),
        F.lit(run_by).alias("CreatedBy"),
        run_at.alias("ModifiedDate"),
        F.lit(run_by).alias("ModifiedBy"),
        d.alias("DateShort"),
        F.year(d).alias("DateYear"),
        F.quarter(d).alias("DateQuarter"),
        quarter_name(d).alias("DateQuarterName"),
        F.month(d).alias("DateMonthNum"),
        month_name(d).alias("DateMonthName"),
        F.dayofmonth(d).alias("DateDayNum"),
        day_name(d).alias("DateDayName"),
        is_weekend(d).alias("IsWeekend"),
    ] + [F.lit(0).alias(f"IsHoliday_{r}") for r in C.HOLIDAY_REGIONS]


def _run_at(run_at) -> Column:
    if run_at is None:
        return F.current_timestamp()
    return F.lit(run_at.isoformat(sep=" ")).cast("timestamp")


def days_between(spark: SparkSession, start: dt.date, end_exclusive: dt.date) -> DataFrame:
    """One row per day in ``[start, end_exclusive)`` as column ``d`` (distributed)."""
    n = max((end_exclusive - start).days, 0)
    return spark.range(n).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))


def generate_calendar(spark: SparkSession, start: dt.date, end_exclusive: dt.date, *,
                      with_sentinels: bool = True, run_at=None,
                      run_by: str = C.UPLOADER) -> DataFrame:
    """Fresh calendar for ``[start, end_exclusive)``, plus the two sentinel days."""
    ts = _run_at(run_at)
    days = days_between(spark, start, end_exclusive).select(*_calendar_columns(F.col("d"), ts, run_by))
    if not with_sentinels:
        return days
    sentinels = (spark.range(2)
                 .select(F.when(F.col("id") == 0, F.lit(C.CALENDAR_EFFECTIVE_DATE))
                         .otherwise(F.lit(C.CALENDAR_EXPIRY_DATE)).alias("d"))
                 .select(*_calendar_columns(F.col("d"), ts, run_by)))
    return days.join(sentinels.select("DateShort"), "DateShort", "left_anti").unionByName(sentinels)


def upsert_calendar(existing: DataFrame, as_of: dt.date, *, run_at=None, run_by: str = C.UPLOADER,
                    default_start_year: int = C.CALENDAR_DEFAULT_START_YEAR,
                    years_ahead: int = C.CALENDAR_YEARS_AHEAD) -> DataFrame:
    """Refresh/extend an existing calendar table.

    * days from 1 Jan of the second-largest year already present (read before
      sentinels are added) up to 1 Jan of run year + ``years_ahead`` (exclusive);
    * a day already present keeps its holiday flags, ``IsCurrent``, validity and
      ``Created*`` columns; its calendar columns and ``Modified*`` are refreshed;
    * a missing day is inserted with all holiday flags 0;
    * the 1900-01-01 / 9999-12-31 sentinels are added when missing;
    * days outside the range are kept unchanged.

    No driver round trip: the start year is a one-row aggregate exploded with
    ``sequence``.
    """
    spark = existing.sparkSession
    ts = _run_at(run_at)
    end_excl = dt.date(as_of.year + years_ahead, 1, 1)
    # distinct years are bounded (at most 9999), so the set is a safe aggregate
    years = existing.agg(F.sort_array(F.collect_set("DateYear"), asc=False).alias("ys"))
    bounds = years.select(F.get("ys", 1).alias("y")).select(
        F.make_date(F.coalesce(F.col("y"), F.lit(default_start_year)).cast("int"), F.lit(1), F.lit(1))
        .alias("start"))
    days = (bounds.select(F.explode(F.sequence(F.col("start"), F.lit(end_excl) - F.expr("INTERVAL 1 DAY"),
                                               F.expr("INTERVAL 1 DAY"))).alias("d"))
            .where(F.col("d") < F.lit(end_excl)))
    fresh = days.select(*_calendar_columns(F.col("d"), ts, run_by))

    old = existing.alias("o")
    new = fresh.alias("n")
    joined = old.join(new, F.col("o.DateKey") == F.col("n.DateKey"), "full_outer")
    in_new = F.col("n.DateKey").isNotNull()
    in_old = F.col("o.DateKey").isNotNull()
    cols = []
    for c in CALENDAR_COLUMNS:
        if c in REFRESHED_COLUMNS:
            cols.append(F.when(in_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        else:
            cols.append(F.when(in_old, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c))
    merged = joined.select(*cols)

    sentinels = (spark.range(2)
                 .select(F.when(F.col("id") == 0, F.lit(C.CALENDAR_EFFECTIVE_DATE))
                         .otherwise(F.lit(C.CALENDAR_EXPIRY_DATE)).alias("d"))
                 .select(*_calendar_columns(F.col("d"), ts, run_by)))
    missing = sentinels.join(merged.select("DateShort"), "DateShort", "left_anti").select(*CALENDAR_COLUMNS)
    return merged.unionByName(missing)


def date_dimension(spark: SparkSession, as_of: dt.date, *, start: dt.date | None = None,
                   run_at=None, run_by: str = C.UPLOADER,
                   years_ahead: int = C.CALENDAR_YEARS_AHEAD) -> DataFrame:
    """Calendar built from scratch (no existing table): from ``start`` (default
    1 Jan of the default start year) to 1 Jan of run year + ``years_ahead``."""
    start = start or dt.date(C.CALENDAR_DEFAULT_START_YEAR, 1, 1)
    end_excl = dt.date(as_of.year + years_ahead, 1, 1)
    return generate_calendar(spark, start, end_excl, run_at=run_at, run_by=run_by).select(*CALENDAR_COLUMNS)

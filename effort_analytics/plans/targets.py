"""Expected hours, planned-leave deduction and the under-target report.

Everything is keyed at member-month grain ``(WorkdayID, YearMonth)`` so that the
facts are joined to targets once, on two hashable columns.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from .. import config as C
from ..functions import not_in_normalized, year_month
from ..operators.joins import join_bounded

# months of a calendar are few (12 per year); anything up to this many rows is
# broadcast when its bound is known on the driver from the parameters alone.
MONTH_TABLE_BROADCAST_LIMIT = 1_000_000


def countable_days(calendar: DataFrame, as_of: dt.date, min_year: int) -> DataFrame:
    """Weekdays of the calendar from ``min_year`` up to and including ``as_of``."""
    return (calendar.where((F.col("IsWeekend") == 0) & (F.col("DateYear") >= min_year)
                           & (F.col("DateShort") <= F.lit(as_of)))
            .select("DateShort"))


def _hours_times_days(days_col, hours_per_day: Decimal):
    return (days_col * F.lit(hours_per_day).cast(DecimalType(2, 1)))


def expected_hours_literal(members: DataFrame, calendar: DataFrame, as_of: dt.date,
                           min_year: int = C.MIN_REPORT_YEAR,
                           hours_per_day: Decimal = C.HOURS_PER_WORKING_DAY) -> DataFrame:
    """Reference form: every (member, day) pair with the day inside the member's
    interval, then counted per member-month. A non-equi join (nested loop); kept
    as the test oracle for :func:`expected_hours`."""
    days = countable_days(calendar, as_of, min_year)
    m = members.select("WorkdayID", "StartDate", "EndDate")
    pairs = m.join(days, (F.col("DateShort") >= F.col("StartDate")) & (F.col("DateShort") <= F.col("EndDate")))
    return (pairs.groupBy("WorkdayID", year_month("DateShort").alias("YearMonth"))
            .agg(F.count(F.lit(1)).alias("TotalWorkingDays"))
            .withColumn("TargetHours", _hours_times_days(F.col("TotalWorkingDays"), hours_per_day)))


def expected_hours(members: DataFrame, calendar: DataFrame, as_of: dt.date,
                   min_year: int = C.MIN_REPORT_YEAR,
                   hours_per_day: Decimal = C.HOURS_PER_WORKING_DAY,
                   months: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """Weekdays inside each member's employment interval, up to ``as_of``, per month,
    times hours per day. Holidays are not subtracted.

    Scale form, hash joins only:

    1. the countable calendar days are folded into one row per month holding a
       31-slot cumulative count (``cum[k]`` = countable days with day-of-month
       <= k) -- a bounded table (12 rows per year), broadcast;
    2. each member interval is clipped to the countable range *before* it is
       expanded (an open end of 9999-12-31 is never exploded), then expanded to
       its months only;
    3. the days of a member-month are ``cum[last day] - cum[first day - 1]``.

    Work is members x months instead of members x days, and no nested loop.
    ``months`` optionally restricts the output to ``[first, last]`` month starts.
    """
    days = countable_days(calendar, as_of, min_year)
    # per month, the set of countable days-of-month (at most 31 values, so a
    # bounded aggregate) folded into cum[k] = countable days with day <= k
    month_table = (days.groupBy(year_month("DateShort").alias("YearMonth"))
                   .agg(F.collect_set(F.dayofmonth("DateShort")).alias("doms"))
                   .select("YearMonth", F.transform(
                       F.sequence(F.lit(0), F.lit(31)),
                       lambda k: F.size(F.filter("doms", lambda d: d <= k))).alias("cum")))
    # Clip to the countable range before expanding: from 1 Jan of min_year to
    # as_of (an open end of 9999-12-31 becomes as_of, never exploded).
    lo = F.greatest(F.col("StartDate"), F.lit(dt.date(min_year, 1, 1)))
    hi = F.least(F.col("EndDate"), F.lit(as_of))
    if months is not None:
        first_m, last_m = months
        lo = F.greatest(lo, F.lit(first_m))
        hi = F.least(hi, F.last_day(F.lit(last_m)))
    # greatest/least skip NULLs, so a missing end must be rejected explicitly
    # (BETWEEN with a NULL bound matches nothing)
    clipped = (members.where(F.col("StartDate").isNotNull() & F.col("EndDate").isNotNull())
               .select("WorkdayID", lo.alias("lo"), hi.alias("hi"))
               .where(F.col("lo") <= F.col("hi")))
    member_months = clipped.select(
        "WorkdayID", "lo", "hi",
        F.explode(F.sequence(F.trunc("lo", "MM"), F.trunc("hi", "MM"), F.expr("INTERVAL 1 MONTH"))).alias("m"))
    member_months = member_months.select(
        "WorkdayID",
        year_month("m").alias("YearMonth"),
        F.when(F.col("m") == F.trunc("lo", "MM"), F.dayofmonth("lo")).otherwise(1).alias("d0"),
        F.when(F.col("m") == F.trunc("hi", "MM"), F.dayofmonth("hi")).otherwise(31).alias("d1"))

    month_rows_bound = (as_of.year - min_year + 1) * 12
    joined = join_bounded(member_months, month_table.select("YearMonth", "cum"), "YearMonth",
                          small_rows_bound=month_rows_bound, limit=MONTH_TABLE_BROADCAST_LIMIT)
    counted = joined.select(
        "WorkdayID", "YearMonth",
        (F.element_at("cum", F.col("d1") + 1) - F.element_at("cum", F.col("d0"))).alias("n"))
    return (counted.where(F.col("n") > 0)
            .groupBy("WorkdayID", "YearMonth")
            .agg(F.sum("n").alias("TotalWorkingDays"))
            .withColumn("TargetHours", _hours_times_days(F.col("TotalWorkingDays"), hours_per_day)))


def planned_leave_deduction(leaves: DataFrame, calendar: DataFrame, *,
                            excluded_types=C.UNPLANNED_LEAVE_TYPES, as_of: dt.date | None = None,
                            calendar_rows_bound: int | None = None) -> DataFrame:
    """Sum of ``TC_Hours * Unit`` per member-month over days present in the calendar,
    leaving out unplanned types (trimmed, upper-cased; a NULL type *counts*).
    Negative units (cancellations) subtract. With ``as_of`` days after it don't count,
    so that a month under way is cut at the same day as its target
    (:func:`expected_hours`); without, the whole month's leave is deducted."""
    if as_of is not None:
        leaves = leaves.where(F.col("TimeOffDate") <= F.lit(as_of))
    keep = leaves.where(F.col("TimeOffDate").isNotNull()
                        & not_in_normalized("TimeOffTypeforTimeOffEntry", excluded_types))
    cal_days = calendar.select(F.col("DateShort").alias("TimeOffDate"))
    on_calendar = join_bounded(keep, cal_days, "TimeOffDate", small_rows_bound=calendar_rows_bound,
                               how="left_semi")
    return (on_calendar.groupBy(F.col("EmployeeID").alias("WorkdayID"),
                                year_month("TimeOffDate").alias("YearMonth"))
            .agg(F.sum(F.col("TC_Hours") * F.col("Unit")).alias("TotalHoursToDeduct")))


def flag_under_target(facts: DataFrame, run_year: int,
                      ratio: Decimal = C.UNDER_TARGET_RATIO) -> DataFrame:
    """Member-months of ``run_year`` whose logged hours are below ``ratio`` of the
    final target. A NULL target never flags."""
    keys = ["DateYearMonthKey", "DateYear", "DateMonthName", "AssignedTo", "WorkdayID", "Squad",
            "ManagerName", "FinalTargetHours"]
    totals = (facts.where(F.col("DateYear") == run_year)
              .groupBy(*keys).agg(F.sum("Hours").alias("TotalHours")))
    return (totals.where(F.col("TotalHours") < F.col("FinalTargetHours") * F.lit(ratio))
            .select("DateYearMonthKey", "DateYear", "DateMonthName", "AssignedTo", "WorkdayID",
                    "Squad", "ManagerName", "TotalHours", "FinalTargetHours"))

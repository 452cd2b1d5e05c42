"""Published facts: completed tasks, tasks-and-leaves with targets, full names.

Calendar joins are on the ``DateShort`` date itself (equivalent to joining the
``yyyyMMdd`` key built from the date, without string work). The calendar is
broadcast only when its row bound is known on the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import (bracketed, code_found_flag, full_name, not_like_prefix,
                         productivity_class, year_month)
from ..operators.joins import join_bounded
from ..operators.lookup import BROADCAST_BYTES, Lookup, join_lookup, measure_lookups
from ..session import staged

TASK_FACT_COLUMNS = [
    "Title", "Date", "DateKey", "DateYear", "DateMonthName", "DateMonthNum", "DateYearMonthKey",
    "Category", "ProductivityType", "Hours", "AssignedTo", "Role", "Squad", "ManagerName",
    "WorkdayID", "PlannerCodeKey", "PlannerCode", "PlannerName", "IsPlannerCodeCorrect",
]

TASK_LEAVE_FACT_COLUMNS = [
    "Date", "DateKey", "DateYear", "DateMonthName", "DateMonthNum", "DateYearMonthKey", "Category",
    "PlannerCode", "ProductivityType", "AssignedTo", "Role", "Squad", "ManagerName", "WorkdayID",
    "Hours", "WorkdayIDYearMonthKey", "TargetHours", "TotalHoursToDeduct", "FinalTargetHours",
]

#: Of the task-and-leave fact what a sum by member and month can be grouped by, and the sum.
TASK_LEAVE_MONTH_COLUMNS = [
    "DateYear", "DateMonthName", "DateYearMonthKey", "AssignedTo", "Role", "Squad", "ManagerName",
    "WorkdayID", "Hours", "TargetHours", "TotalHoursToDeduct", "FinalTargetHours",
]

_CAL_COLS = ["DateShort", "DateKey", "DateYear", "DateMonthName", "DateMonthNum"]


def _calendar_part(calendar: DataFrame, min_year: int) -> DataFrame:
    return (calendar.where(F.col("DateYear") >= min_year).select(*_CAL_COLS)
            .withColumn("DateYearMonthKey", F.substring(F.col("DateKey").cast("string"), 1, 6)))


def _year_start(year: int):
    # a date bound on the fact itself, which the scan can use; the calendar's year alone prunes nothing
    return F.lit(dt.date(year, 1, 1))


def _member_part(members: DataFrame, key: str) -> DataFrame:
    return members.select(F.col(key).alias("_mkey"), "AssignedTo", F.col("RoleGroup").alias("Role"),
                          "Squad", "ManagerName", "WorkdayID")


def publish_task_fact(tasks: DataFrame, members: DataFrame, calendar: DataFrame, buckets: DataFrame,
                      planner_codes: DataFrame, productivity_types: DataFrame, *,
                      min_year: int = C.MIN_REPORT_YEAR, completed: int = C.COMPLETED_PROGRESS,
                      admin: str = C.ADMIN_CATEGORY, leads: str = C.LEADS_CODE,
                      calendar_rows_bound: int | None = None) -> DataFrame:
    """Completed tasks from ``min_year`` with member, calendar, bucket, planner code
    (left: a wrong code keeps the task, flagged 'No') and productivity class; DISTINCT.
    Star join: inner to members, calendar, buckets and types; left to codes."""
    s = (tasks.where((F.col("Progress") == completed) & (F.col("TC_ProductiveDate") >= _year_start(min_year)))
         .select("Title", "TC_ProductiveDate", "TC_PlannerCode", "BucketID", "Hours",
                 "CreatedByOffice365ID"))
    m = _member_part(members, "Office365ID")
    j = s.join(m, F.col("CreatedByOffice365ID") == F.col("_mkey"), "inner")
    cal = _calendar_part(calendar, min_year)
    j = join_bounded(j, cal.withColumnRenamed("DateShort", "TC_ProductiveDate"), "TC_ProductiveDate",
                     small_rows_bound=calendar_rows_bound)
    b = buckets.select(F.col("BucketID").alias("_bid"), F.col("BucketName").alias("Category"))
    j = j.join(b, F.col("BucketID") == F.col("_bid"), "inner")
    pc = planner_codes.select(F.col("Code").alias("PlannerCodeKey"), F.col("Name").alias("PlannerName"))
    j = j.join(pc, F.col("PlannerCodeKey") == bracketed("TC_PlannerCode"), "left")
    p = productivity_types.select(F.col("Category").alias("_pcat"), F.col("Type").alias("_ptype"))
    j = j.join(p, F.col("_pcat") == F.col("Category"), "inner")
    out = j.select(
        "Title", F.col("TC_ProductiveDate").alias("Date"), "DateKey", "DateYear", "DateMonthName",
        "DateMonthNum", "DateYearMonthKey", "Category",
        productivity_class("Category", "TC_PlannerCode", "_ptype", admin, leads).alias("ProductivityType"),
        "Hours", "AssignedTo", "Role", "Squad", "ManagerName", "WorkdayID", "PlannerCodeKey",
        F.col("TC_PlannerCode").alias("PlannerCode"), "PlannerName",
        code_found_flag("PlannerCodeKey").alias("IsPlannerCodeCorrect"))
    return out.distinct()


def task_leave_rows(tasks: DataFrame, leaves: DataFrame, members: DataFrame, buckets: DataFrame,
                    calendar: DataFrame, *, completed: int = C.COMPLETED_PROGRESS,
                    holiday_prefix: str = C.HOLIDAY_LEAVE_PREFIX, tasks_unique: bool = False,
                    date_range: tuple[dt.date, dt.date] | None = None,
                    calendar_rows_bound: int | None = None) -> DataFrame:
    """Completed task hours UNION ALL leave hours, both with member attributes.

    Task rows: repeated rows once (``tasks_unique``: the caller knows that there
    are none, as after a keyed load, which saves a shuffle of whole rows), inner
    join to members by account id, left join to buckets for the category. Leave
    rows: only dates of the calendar, TaskID '', category and code = leave type,
    hours = hours per unit x units, 'Business Unit Holiday...' types left out
    (a NULL type drops out too). ``date_range`` pre-filters both branches on
    the date (used when the caller only reads those dates).
    """
    t = tasks.where((F.col("Progress") == completed) & F.col("TC_ProductiveDate").isNotNull())
    lv = leaves.where(F.col("TimeOffDate").isNotNull()
                      & not_like_prefix("TimeOffTypeforTimeOffEntry", holiday_prefix))
    if date_range is not None:
        lo, hi = date_range
        t = t.where(F.col("TC_ProductiveDate").between(F.lit(lo), F.lit(hi)))
        lv = lv.where(F.col("TimeOffDate").between(F.lit(lo), F.lit(hi)))
    if not tasks_unique:
        t = t.distinct()
    lv = join_bounded(lv, calendar.select(F.col("DateShort").alias("TimeOffDate")), "TimeOffDate",
                      small_rows_bound=calendar_rows_bound, how="left_semi")
    b = buckets.select(F.col("BucketID").alias("_bid"), F.col("BucketName"))
    t = t.join(b, F.col("BucketID") == F.col("_bid"), "left")
    t = t.join(_member_part(members, "Office365ID"), F.col("CreatedByOffice365ID") == F.col("_mkey"), "inner")
    t = t.select(F.col("TaskID"), F.col("TC_ProductiveDate").alias("Date"),
                 F.col("BucketName").alias("Category"), F.col("TC_PlannerCode").alias("PlannerCode"),
                 F.col("Hours").cast("decimal(21,4)").alias("Hours"),
                 "AssignedTo", "Role", "Squad", "ManagerName", "WorkdayID")
    lv = lv.join(_member_part(members, "WorkdayID"), F.col("EmployeeID") == F.col("_mkey"), "inner")
    lv = lv.select(F.lit("").alias("TaskID"), F.col("TimeOffDate").alias("Date"),
                   F.col("TimeOffTypeforTimeOffEntry").alias("Category"),
                   F.col("TimeOffTypeforTimeOffEntry").alias("PlannerCode"),
                   (F.col("TC_Hours") * F.col("Unit")).cast("decimal(21,4)").alias("Hours"),
                   "AssignedTo", "Role", "Squad", "ManagerName", "WorkdayID")
    return t.unionByName(lv)


def publish_task_leave_fact(rows: DataFrame, calendar: DataFrame, productivity_types: DataFrame,
                            expected: DataFrame, planned: DataFrame, *,
                            min_year: int = C.MIN_REPORT_YEAR, admin: str = C.ADMIN_CATEGORY,
                            leads: str = C.LEADS_CODE, keep_duplicates: bool = False,
                            calendar_rows_bound: int | None = None) -> DataFrame:
    """Task and leave hours per day with the member-month target attached.

    ``FinalTargetHours = TargetHours - coalesce(deduction, 0)``; rows from
    ``min_year``; DISTINCT over the row *including* the task id, which is then
    dropped -- so identical leave entries (all with task id '') collapse unless
    ``keep_duplicates``. Targets are joined at member-month grain on
    ``(WorkdayID, YearMonth)``.
    """
    cal = _calendar_part(calendar, min_year).withColumnRenamed("DateShort", "Date")
    j = join_bounded(rows.where(F.col("Date") >= _year_start(min_year)), cal, "Date", small_rows_bound=calendar_rows_bound)
    p = productivity_types.select(F.col("Category").alias("_pcat"), F.col("Type").alias("_ptype"))
    j = j.join(p, F.col("_pcat") == F.col("Category"), "left")
    j = j.withColumn("YearMonth", year_month("Date"))
    e = expected.select(F.col("WorkdayID").alias("_ew"), F.col("YearMonth").alias("_eym"), "TargetHours")
    j = j.join(e, (F.col("WorkdayID") == F.col("_ew")) & (F.col("YearMonth") == F.col("_eym")), "left")
    pl = planned.select(F.col("WorkdayID").alias("_pw"), F.col("YearMonth").alias("_pym"),
                        "TotalHoursToDeduct")
    j = j.join(pl, (F.col("WorkdayID") == F.col("_pw")) & (F.col("YearMonth") == F.col("_pym")), "left")
    deduct = F.coalesce(F.col("TotalHoursToDeduct"), F.lit(0))
    full = j.select(
        "TaskID", "Date", "DateKey", "DateYear", "DateMonthName", "DateMonthNum", "DateYearMonthKey",
        "Category", "PlannerCode",
        productivity_class("Category", "PlannerCode", "_ptype", admin, leads).alias("ProductivityType"),
        "AssignedTo", "Role", "Squad", "ManagerName", "WorkdayID", "Hours",
        F.concat(F.col("WorkdayID").cast("string"), F.col("DateYearMonthKey")).alias("WorkdayIDYearMonthKey"),
        "TargetHours", deduct.alias("TotalHoursToDeduct"),
        (F.col("TargetHours") - deduct).alias("FinalTargetHours"))
    if not keep_duplicates:
        full = full.distinct()
    return full.select(*TASK_LEAVE_FACT_COLUMNS)


# -- facts from measured lookups: duplicates go before the rows are widened -------------

_MEMBER = ["AssignedTo", "Role", "Squad", "ManagerName", "WorkdayID"]


def _person() -> Column:
    """Names a member by what a fact shows: members that look alike there are one. Where two that
    differ share a hash, :func:`_people` isn't unique by it, and the plain form runs."""
    return F.xxhash64(F.to_json(F.struct(*_MEMBER), {"ignoreNullFields": "false"}))


def _keyed(members: DataFrame, key: str) -> DataFrame:
    """(key, person): a fact carries the person's hash until its duplicates are gone."""
    return _member_part(members, key).select(F.col("_mkey").alias("key"), _person().alias("_person"))


def _people(members: DataFrame) -> DataFrame:
    """(person, attributes), one row a person."""
    return _member_part(members, "WorkdayID").select(_person().alias("_person"), *_MEMBER).distinct()


def _categories(buckets: DataFrame) -> DataFrame:
    return buckets.select(F.col("BucketID").alias("key"), F.col("BucketName").alias("Category"))


def _types(productivity_types: DataFrame) -> DataFrame:
    return productivity_types.select(F.col("Category").alias("key"), F.col("Type").alias("_ptype")).distinct()


def _months(calendar: DataFrame, min_year: int) -> DataFrame:
    return calendar.where(F.col("DateYear") >= min_year).select(year_month("DateShort").alias("YearMonth")).distinct()


def _hours_of(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("Hours").alias("Hours"))


def target_lookup(expected: DataFrame, planned: DataFrame, people: Lookup, months: Lookup) -> Lookup:
    """(WorkdayID, YearMonth) -> TargetHours, TotalHoursToDeduct, for the workers of ``people`` and these
    months: one row a worker and month that has either, so that their numbers bound its size."""
    both = expected.select("WorkdayID", "YearMonth", "TargetHours").unionByName(
        planned.select("WorkdayID", "YearMonth", "TotalHoursToDeduct"), allowMissingColumns=True)
    both = both.groupBy("WorkdayID", "YearMonth").agg(F.max("TargetHours").alias("TargetHours"), F.max("TotalHoursToDeduct").alias("TotalHoursToDeduct"))
    rows = people.rows * months.rows
    size = 72 * rows
    if size <= BROADCAST_BYTES:
        ids = Lookup(people.df.select("WorkdayID").distinct(), ("WorkdayID",), people.rows, people.bytes, True)
        both = join_lookup(join_lookup(both, ids, "WorkdayID", "left_semi"), months, "YearMonth", "left_semi")
    return Lookup(both, ("WorkdayID", "YearMonth"), rows, size, True)


def _unique(lookups: dict[str, Lookup]) -> bool:
    return all(x.unique for x in lookups.values())


def task_fact(tasks: DataFrame, members: DataFrame, calendar: DataFrame, buckets: DataFrame, planner_codes: DataFrame,
              productivity_types: DataFrame, *, min_year: int = C.MIN_REPORT_YEAR, completed: int = C.COMPLETED_PROGRESS,
              admin: str = C.ADMIN_CATEGORY, leads: str = C.LEADS_CODE, calendar_rows_bound: int | None = None) -> DataFrame:
    """The rows of :func:`publish_task_fact`, with the lookups measured first.

    Where they have one row a key, the fact is reduced to what tells its rows apart (title, date,
    category, code, hours and a hash that names the member), these six columns are made distinct, and
    the rest is looked up for what is left. Each column that comes later depends on those six alone,
    so the result is the same; nothing is exchanged on the key of a lookup that fits a broadcast. Else
    the plain form runs.
    """
    codes = planner_codes.select(F.col("Code").alias("key"), F.col("Code").alias("PlannerCodeKey"), F.col("Name").alias("PlannerName"))
    x = measure_lookups(who=(_keyed(members, "Office365ID"), "key"), people=(_people(members), "_person"), category=(_categories(buckets), "key"),
                        kind=(_types(productivity_types), "key"), code=(codes, "key"), day=(_calendar_part(calendar, min_year), "DateShort"))
    if not _unique(x):
        return publish_task_fact(tasks, members, calendar, buckets, planner_codes, productivity_types, min_year=min_year,
                                 completed=completed, admin=admin, leads=leads, calendar_rows_bound=calendar_rows_bound)
    s = tasks.where((F.col("Progress") == completed) & (F.col("TC_ProductiveDate") >= _year_start(min_year)))
    s = join_lookup(join_lookup(s, x["who"], "CreatedByOffice365ID", "inner"), x["category"], "BucketID", "inner")
    s = s.select("Title", F.col("TC_ProductiveDate").alias("Date"), "Category", F.col("TC_PlannerCode").alias("PlannerCode"), "Hours", "_person").distinct()
    s = join_lookup(join_lookup(s, x["people"], "_person", "inner"), x["day"], "Date", "inner")
    s = join_lookup(join_lookup(s, x["kind"], "Category", "inner"), x["code"], bracketed("PlannerCode"), "left")
    return (s.withColumn("ProductivityType", productivity_class("Category", "PlannerCode", "_ptype", admin, leads))
            .withColumn("IsPlannerCodeCorrect", code_found_flag("PlannerCodeKey")).select(*TASK_FACT_COLUMNS))


def task_and_leave_fact(tasks: DataFrame, leaves: DataFrame, members: DataFrame, buckets: DataFrame, calendar: DataFrame,
                        productivity_types: DataFrame, expected: DataFrame, planned: DataFrame, *,
                        min_year: int = C.MIN_REPORT_YEAR, completed: int = C.COMPLETED_PROGRESS,
                        holiday_prefix: str = C.HOLIDAY_LEAVE_PREFIX, admin: str = C.ADMIN_CATEGORY, leads: str = C.LEADS_CODE,
                        keep_duplicates: bool = False, tasks_unique: bool = False, monthly: bool = False,
                        date_range: tuple[dt.date, dt.date] | None = None, calendar_rows_bound: int | None = None) -> DataFrame:
    """The rows of :func:`task_leave_rows` and :func:`publish_task_leave_fact`, with the lookups
    measured first.

    Where they have one row a key, duplicates go while a row is (task id, date, category, code,
    hours, hash of the member): that decides all other columns. With ``tasks_unique`` (one row a
    task id) only leave rows, and tasks without an id, are compared at all; the narrow task rows
    are staged, as they are read for both kinds (with ``date_range`` they are left in one plan). Else
    the plain form runs.

    ``monthly``: for readers that only sum hours by columns of the member and the month. The hours
    of a member and month are summed while a row is these and the member's hash, and targets and
    attributes are looked up for the sums (``TASK_LEAVE_MONTH_COLUMNS``).
    """
    x = measure_lookups(account=(_keyed(members, "Office365ID"), "key"), worker=(_keyed(members, "WorkdayID"), "key"), people=(_people(members), "_person"),
                        category=(_categories(buckets), "key"), kind=(_types(productivity_types), "key"), day=(_calendar_part(calendar, min_year), "DateShort"),
                        month=(_months(calendar, min_year), "YearMonth"))
    if not _unique(x):
        rows = task_leave_rows(tasks, leaves, members, buckets, calendar, completed=completed, holiday_prefix=holiday_prefix,
                               tasks_unique=tasks_unique, date_range=date_range, calendar_rows_bound=calendar_rows_bound)
        fact = publish_task_leave_fact(rows, calendar, productivity_types, expected, planned, min_year=min_year, admin=admin,
                                       leads=leads, keep_duplicates=keep_duplicates, calendar_rows_bound=calendar_rows_bound)
        return _hours_of(fact, [c for c in TASK_LEAVE_MONTH_COLUMNS if c != "Hours"]).select(*TASK_LEAVE_MONTH_COLUMNS) if monthly else fact
    t = tasks.where((F.col("Progress") == completed) & (F.col("TC_ProductiveDate") >= _year_start(min_year)))
    lv = leaves.where((F.col("TimeOffDate") >= _year_start(min_year)) & not_like_prefix("TimeOffTypeforTimeOffEntry", holiday_prefix))
    if date_range is not None:
        lo, hi = (F.lit(x) for x in date_range)
        t, lv = t.where(F.col("TC_ProductiveDate").between(lo, hi)), lv.where(F.col("TimeOffDate").between(lo, hi))
    if not tasks_unique and keep_duplicates:
        t = t.distinct()
    t = join_lookup(join_lookup(t, x["account"], "CreatedByOffice365ID", "inner"), x["category"], "BucketID", "left")
    t = t.select("TaskID", F.col("TC_ProductiveDate").alias("Date"), "Category", F.col("TC_PlannerCode").alias("PlannerCode"),
                 F.col("Hours").cast("decimal(21,4)").alias("Hours"), "_person")
    lv = join_lookup(lv, x["worker"], "EmployeeID", "inner")
    kind_of_leave = F.col("TimeOffTypeforTimeOffEntry")
    lv = lv.select(F.lit("").alias("TaskID"), F.col("TimeOffDate").alias("Date"), kind_of_leave.alias("Category"), kind_of_leave.alias("PlannerCode"),
                   (F.col("TC_Hours") * F.col("Unit")).cast("decimal(21,4)").alias("Hours"), "_person")
    if keep_duplicates:
        rows = t.unionByName(lv)
    elif tasks_unique:
        t = staged(t, "task-rows") if date_range is None else t
        named = F.coalesce(F.col("TaskID") != "", F.lit(False))
        rows = t.where(named).unionByName(t.where(~named).unionByName(lv).distinct())
    else:
        rows = t.unionByName(lv).distinct()
    j = join_lookup(rows, x["day"], "Date", "inner").withColumn("YearMonth", year_month("Date"))
    j = _hours_of(j, ["_person", "YearMonth", "DateYear", "DateMonthName", "DateYearMonthKey"]) if monthly else join_lookup(j, x["kind"], "Category", "left")
    j = join_lookup(j, x["people"], "_person", "inner")
    j = join_lookup(j, target_lookup(expected, planned, x["people"], x["month"]), ["WorkdayID", "YearMonth"], "left")
    deduct = F.coalesce(F.col("TotalHoursToDeduct"), F.lit(0))
    j = j.withColumn("FinalTargetHours", F.col("TargetHours") - deduct).withColumn("TotalHoursToDeduct", deduct)
    if monthly:
        return j.select(*TASK_LEAVE_MONTH_COLUMNS)
    return j.select("*", productivity_class("Category", "PlannerCode", "_ptype", admin, leads).alias("ProductivityType"),
                    F.concat(F.col("WorkdayID").cast("string"), F.col("DateYearMonthKey")).alias("WorkdayIDYearMonthKey")).select(*TASK_LEAVE_FACT_COLUMNS)


def distinct_full_names(people: DataFrame) -> DataFrame:
    """Distinct ``GivenName || ' ' || Surname`` across all files."""
    return people.select(full_name("GivenName", "Surname").alias("FullName")).distinct()

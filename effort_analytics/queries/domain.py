"""Domain queries: the published facts, targets and the refined tables (C1-C19)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import config as C
from ..plans import analogues as A
from ..plans import calendar as cal_plans
from ..plans import facts, targets
from .registry import query
from .sql import LEADS, MIN_YEAR, RUN_YEAR

RUN_YEAR_RANGE = (dt.date(A.RUN_YEAR, 1, 1), dt.date(A.RUN_YEAR, 12, 31))

FLAG_COLUMNS = ("DateYearMonthKey:string, DateYear:bigint, DateMonthName:string, AssignedTo:string, "
                "WorkdayID:bigint, Squad:string, ManagerName:string, TotalHours:double, "
                "FinalTargetHours:double")

FACT_COLUMNS = ("Date:date, DateKey:bigint, DateYear:bigint, DateMonthName:string, DateMonthNum:bigint, "
                "DateYearMonthKey:string, Category:string, PlannerCode:string, ProductivityType:string, "
                "AssignedTo:string, Role:string, Squad:string, ManagerName:string, WorkdayID:bigint, "
                "Hours:double, WorkdayIDYearMonthKey:string, TargetHours:double, "
                "TotalHoursToDeduct:double, FinalTargetHours:double")


def task_leave_fact(spark, sf_dir, *, date_range=None, monthly=False):
    """The published task-and-leave fact over the analogue inputs.

    With ``date_range`` every input is restricted to those dates first (only
    valid for readers that filter the fact to the same dates); ``monthly`` sums
    the hours of a member and month before the attributes are joined."""
    t = A.Tables(spark, sf_dir, stage=True)
    members = A.members(t)
    calendar = A.calendar(spark)
    leaves = dated = A.leaves(t)
    months = None
    if date_range is not None:
        lo, hi = date_range
        months = (lo.replace(day=1), hi.replace(day=1))
        dated = leaves.where(F.col("TimeOffDate").between(F.lit(lo), F.lit(hi)))
    expected = targets.expected_hours(members, calendar, A.AS_OF, A.MIN_YEAR, months=months)
    planned = targets.planned_leave_deduction(dated, calendar, calendar_rows_bound=A.CAL_ROWS)
    return facts.task_and_leave_fact(A.tasks(t), leaves, members, A.buckets(t), calendar, A.productivity_types(t),
                                     expected, planned, min_year=A.MIN_YEAR, leads=A.LEADS, tasks_unique=True, monthly=monthly,
                                     date_range=date_range, calendar_rows_bound=A.CAL_ROWS)


@query("flag_under_target", FLAG_COLUMNS, f"""
SELECT DateYearMonthKey, DateYear, DateMonthName, AssignedTo, WorkdayID, Squad, ManagerName,
       TotalHours, FinalTargetHours
FROM (SELECT DateYearMonthKey, DateYear, DateMonthName, AssignedTo, WorkdayID, Squad, ManagerName,
             SUM(Hours) AS TotalHours, FinalTargetHours
      FROM vw_task_and_leaves WHERE DateYear = {RUN_YEAR}
      GROUP BY DateYearMonthKey, DateYear, DateMonthName, AssignedTo, WorkdayID, Squad, ManagerName,
               FinalTargetHours) m
WHERE TotalHours < FinalTargetHours * 0.75""", covers="C16 A1 A7 F7 C12 C14 C15")
def flag_under_target(spark, sf_dir):
    """Flagship: run-year member-months below 75 % of their final target."""
    fact = task_leave_fact(spark, sf_dir, date_range=RUN_YEAR_RANGE)
    return targets.flag_under_target(fact, A.RUN_YEAR)


@query("publish_task_leave_fact", FACT_COLUMNS, "SELECT * FROM vw_task_and_leaves",
       covers="C12 U2 J3 J6 J8 A5 P7 D2")
def publish_task_leave_fact(spark, sf_dir):
    return task_leave_fact(spark, sf_dir)


@query("agg_sum_by_keys", FLAG_COLUMNS, """
SELECT DateYearMonthKey, DateYear, DateMonthName, AssignedTo, WorkdayID, Squad, ManagerName,
       SUM(Hours) AS TotalHours, FinalTargetHours
FROM vw_task_and_leaves
GROUP BY DateYearMonthKey, DateYear, DateMonthName, AssignedTo, WorkdayID, Squad, ManagerName,
         FinalTargetHours""", covers="A1")
def agg_sum_by_keys(spark, sf_dir):
    keys = ["DateYearMonthKey", "DateYear", "DateMonthName", "AssignedTo", "WorkdayID", "Squad",
            "ManagerName", "FinalTargetHours"]
    return task_leave_fact(spark, sf_dir, monthly=True).groupBy(*keys).agg(F.sum("Hours").alias("TotalHours"))


@query("publish_task_fact",
       "Title:string, Date:date, DateKey:bigint, DateYear:bigint, DateMonthName:string, "
       "DateMonthNum:bigint, DateYearMonthKey:string, Category:string, ProductivityType:string, "
       "Hours:double, AssignedTo:string, Role:string, Squad:string, ManagerName:string, "
       "WorkdayID:bigint, PlannerCodeKey:string, PlannerCode:string, PlannerName:string, "
       "IsPlannerCodeCorrect:string", f"""
SELECT DISTINCT S.Title, S.TC_ProductiveDate AS "Date", D.DateKey, D.DateYear, D.DateMonthName,
       D.DateMonthNum, substring(CAST(D.DateKey AS VARCHAR), 1, 6) AS DateYearMonthKey,
       B.BucketName AS Category,
       CASE WHEN B.BucketName = 'Admin' AND S.TC_PlannerCode = {LEADS} THEN 'Productive'
            WHEN B.BucketName = 'Admin' AND S.TC_PlannerCode <> {LEADS} THEN 'Nonproductive'
            ELSE P."Type" END AS ProductivityType,
       S.Hours, M.AssignedTo, M.RoleGroup AS "Role", M.Squad, M.ManagerName, M.WorkdayID,
       PC.Code AS PlannerCodeKey, S.TC_PlannerCode AS PlannerCode, PC.Name AS PlannerName,
       CASE WHEN PC.Code IS NULL THEN 'No' ELSE 'Yes' END AS IsPlannerCodeCorrect
FROM tasks S
JOIN members M ON M.Office365ID = S.CreatedByOffice365ID
JOIN dim_date D ON D.DateKey = CAST(replace(CAST(S.TC_ProductiveDate AS VARCHAR), '-', '') AS BIGINT)
JOIN buckets B ON B.BucketID = S.BucketID
LEFT JOIN planner_codes PC ON PC.Code = '[' || S.TC_PlannerCode || ']'
JOIN productivity_types P ON P.Category = B.BucketName
WHERE S.Progress = 100 AND S.TC_ProductiveDate IS NOT NULL AND D.DateYear >= {MIN_YEAR}""",
       covers="C11 J2 J4 J5 F1 F2 C13")
def publish_task_fact(spark, sf_dir):
    t = A.Tables(spark, sf_dir)
    return facts.task_fact(A.tasks(t), A.members(t), A.calendar(spark), A.buckets(t),
                                   A.planner_codes(t), A.productivity_types(t), min_year=A.MIN_YEAR,
                                   leads=A.LEADS, calendar_rows_bound=A.CAL_ROWS)


@query("join_interval_days", "WorkdayID:bigint, YearMonth:bigint, TotalWorkingDays:bigint, TargetHours:double",
       "SELECT * FROM expected", covers="J7 C14 A2 A3")
def join_interval_days(spark, sf_dir):
    t = A.Tables(spark, sf_dir)
    return targets.expected_hours(A.members(t), A.calendar(spark), A.AS_OF, A.MIN_YEAR)


@query("planned_leave_deduction", "WorkdayID:bigint, YearMonth:bigint, TotalHoursToDeduct:double",
       "SELECT * FROM planned", covers="C15 F4 A4 X14")
def planned_leave_deduction(spark, sf_dir):
    t = A.Tables(spark, sf_dir)
    return targets.planned_leave_deduction(A.leaves(t), A.calendar(spark), calendar_rows_bound=A.CAL_ROWS)


@query("refine_members",
       "UploadBy:string, Office365ID:string, WorkdayID:bigint, GivenName:string, Surname:string, "
       "AssignedTo:string, JobTitle:string, RoleGroup:string, ManagerName:string, Squad:string, "
       "StartDate:date, EndDate:date, IsActive:bigint",
       "SELECT 'svc_load' AS UploadBy, * FROM members", covers="C9 J1 N1 N2 X18 P5")
def refine_members(spark, sf_dir):
    return A.members(A.Tables(spark, sf_dir))


@query("refine_leaves",
       "UploadBy:string, TimeOffDate:date, DayoftheWeek:string, Worker:string, EmployeeID:bigint, "
       "TimeOffAbsenceTable:string, TimeOffTypeforTimeOffEntry:string, Unit:double, TC_Hours:double, "
       "UnitofTime:string",
       "SELECT 'svc_load' AS UploadBy, * FROM leaves", covers="C17 C8 X12 X17")
def refine_leaves(spark, sf_dir):
    return A.leaves(A.Tables(spark, sf_dir))


@query("union_task_sources",
       "Title:string, TC_PlannerCode:string, TaskID:string, BucketID:string, Progress:bigint, "
       "TC_ProgressDescription:string, CreatedByOffice365ID:string, CreatedDate:date, StartDate:date, "
       "DueDate:date, CompletedDate:date, TC_ProductiveDate:date, Hours:double",
       "SELECT * FROM incoming_tasks", covers="U1 C10 C2-C7 F5")
def union_task_sources(spark, sf_dir):
    return A.incoming_tasks(A.Tables(spark, sf_dir))


@query("load_tasks_upsert",
       "TaskID:string, Title:string, Progress:bigint, TC_ProgressDescription:string, "
       "TC_ProductiveDate:date, CompletedDate:date, Hours:double",
       "SELECT * FROM tasks", covers="C10 K7 K7b K9")
def load_tasks_upsert(spark, sf_dir):
    return A.tasks(A.Tables(spark, sf_dir))


@query("classify_productivity",
       "TaskID:string, Category:string, PlannerCode:string, ProductivityType:string", f"""
SELECT S.TaskID, B.BucketName AS Category, S.TC_PlannerCode AS PlannerCode,
       CASE WHEN B.BucketName = 'Admin' AND S.TC_PlannerCode = {LEADS} THEN 'Productive'
            WHEN B.BucketName = 'Admin' AND S.TC_PlannerCode <> {LEADS} THEN 'Nonproductive'
            ELSE P."Type" END AS ProductivityType
FROM tasks S LEFT JOIN buckets B ON B.BucketID = S.BucketID
LEFT JOIN productivity_types P ON P.Category = B.BucketName""", covers="C13")
def classify_productivity(spark, sf_dir):
    from ..functions import productivity_class
    t = A.Tables(spark, sf_dir)
    b = A.buckets(t).select("BucketID", F.col("BucketName").alias("Category"))
    p = A.productivity_types(t).select(F.col("Category").alias("_pc"), F.col("Type").alias("_pt"))
    j = A.tasks(t).join(b, "BucketID", "left").join(p, F.col("_pc") == F.col("Category"), "left")
    return j.select("TaskID", "Category", F.col("TC_PlannerCode").alias("PlannerCode"),
                    productivity_class("Category", "TC_PlannerCode", "_pt", leads=A.LEADS)
                    .alias("ProductivityType"))


# -- calendar dimension ----------------------------------------------------------

def _existing_calendar(spark, sf_dir):
    """A calendar table as a CSV load would leave it: one row per order date,
    day names in lower case (so a refresh is visible), some holiday flags set."""
    t = A.Tables(spark, sf_dir)
    days = t.orders.select(F.to_date("o_orderdate").alias("d")).distinct()
    fresh = cal_plans._calendar_columns(F.col("d"), F.lit(dt.datetime(1999, 1, 1)).cast("timestamp"), "CSV_LOAD")
    out = days.select(*fresh)
    return out.withColumns({
        "DateDayName": F.lower("DateDayName"),
        "IsHoliday_USA": F.when((F.col("DateMonthNum") == 12) & (F.col("DateDayNum") == 25), 1).otherwise(0),
        "IsHoliday_PH": F.when((F.col("DateMonthNum") == 6) & (F.col("DateDayNum") == 12), 1).otherwise(0),
    })


_EXISTING_SQL = """
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS DateKey, 1 AS IsCurrent, 'CSV_LOAD' AS CreatedBy,
       'CSV_LOAD' AS ModifiedBy, d AS DateShort, year(d) AS DateYear, quarter(d) AS DateQuarter,
       'Q' || CAST(quarter(d) AS VARCHAR) || '-' || CAST(year(d) AS VARCHAR) AS DateQuarterName,
       month(d) AS DateMonthNum, monthname(d) AS DateMonthName, day(d) AS DateDayNum,
       lower(dayname(d)) AS DateDayName, CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS IsWeekend,
       CASE WHEN month(d) = 12 AND day(d) = 25 THEN 1 ELSE 0 END AS IsHoliday_USA,
       CASE WHEN month(d) = 6 AND day(d) = 12 THEN 1 ELSE 0 END AS IsHoliday_PH
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) o"""

_UPSERT_SQL = f"""
WITH existing AS ({_EXISTING_SQL}),
start_year AS (
  SELECT coalesce((SELECT max(DateYear) FROM existing WHERE DateYear < (SELECT max(DateYear) FROM existing)),
                  1955) AS y),
fresh AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS DateKey, 1 AS IsCurrent, 'svc_load' AS CreatedBy,
         'svc_load' AS ModifiedBy, d AS DateShort, year(d) AS DateYear, quarter(d) AS DateQuarter,
         'Q' || CAST(quarter(d) AS VARCHAR) || '-' || CAST(year(d) AS VARCHAR) AS DateQuarterName,
         month(d) AS DateMonthNum, monthname(d) AS DateMonthName, day(d) AS DateDayNum,
         dayname(d) AS DateDayName, CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS IsWeekend,
         0 AS IsHoliday_USA, 0 AS IsHoliday_PH
  FROM (SELECT CAST(g AS DATE) AS d FROM start_year,
        generate_series(make_date(CAST(start_year.y AS INTEGER), 1, 1),
                        DATE '{A.RUN_YEAR + C.CALENDAR_YEARS_AHEAD}-01-01' - INTERVAL 1 DAY,
                        INTERVAL 1 DAY) t(g)) x),
merged AS (
  SELECT coalesce(o.DateKey, n.DateKey) AS DateKey,
         CASE WHEN o.DateKey IS NOT NULL THEN o.IsCurrent ELSE n.IsCurrent END AS IsCurrent,
         CASE WHEN o.DateKey IS NOT NULL THEN o.CreatedBy ELSE n.CreatedBy END AS CreatedBy,
         CASE WHEN n.DateKey IS NOT NULL THEN n.ModifiedBy ELSE o.ModifiedBy END AS ModifiedBy,
         CASE WHEN n.DateKey IS NOT NULL THEN n.DateShort ELSE o.DateShort END AS DateShort,
         CASE WHEN n.DateKey IS NOT NULL THEN n.DateYear ELSE o.DateYear END AS DateYear,
         CASE WHEN n.DateKey IS NOT NULL THEN n.DateQuarter ELSE o.DateQuarter END AS DateQuarter,
         CASE WHEN n.DateKey IS NOT NULL THEN n.DateQuarterName ELSE o.DateQuarterName END AS DateQuarterName,
         CASE WHEN n.DateKey IS NOT NULL THEN n.DateMonthNum ELSE o.DateMonthNum END AS DateMonthNum,
         CASE WHEN n.DateKey IS NOT NULL THEN n.DateMonthName ELSE o.DateMonthName END AS DateMonthName,
         CASE WHEN n.DateKey IS NOT NULL THEN n.DateDayNum ELSE o.DateDayNum END AS DateDayNum,
         CASE WHEN n.DateKey IS NOT NULL THEN n.DateDayName ELSE o.DateDayName END AS DateDayName,
         CASE WHEN n.DateKey IS NOT NULL THEN n.IsWeekend ELSE o.IsWeekend END AS IsWeekend,
         CASE WHEN o.DateKey IS NOT NULL THEN o.IsHoliday_USA ELSE n.IsHoliday_USA END AS IsHoliday_USA,
         CASE WHEN o.DateKey IS NOT NULL THEN o.IsHoliday_PH ELSE n.IsHoliday_PH END AS IsHoliday_PH
  FROM existing o FULL OUTER JOIN fresh n ON o.DateKey = n.DateKey),
sentinels AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS DateKey, 1 AS IsCurrent, 'svc_load' AS CreatedBy,
         'svc_load' AS ModifiedBy, d AS DateShort, year(d) AS DateYear, quarter(d) AS DateQuarter,
         'Q' || CAST(quarter(d) AS VARCHAR) || '-' || CAST(year(d) AS VARCHAR) AS DateQuarterName,
         month(d) AS DateMonthNum, monthname(d) AS DateMonthName, day(d) AS DateDayNum,
         dayname(d) AS DateDayName, CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS IsWeekend,
         0 AS IsHoliday_USA, 0 AS IsHoliday_PH
  FROM (SELECT DATE '1900-01-01' AS d UNION ALL SELECT DATE '9999-12-31') s
  WHERE NOT EXISTS (SELECT 1 FROM merged m WHERE m.DateShort = s.d))
SELECT * FROM merged UNION ALL SELECT * FROM sentinels"""


def _upserted_calendar(spark, sf_dir):
    return cal_plans.upsert_calendar(_existing_calendar(spark, sf_dir), A.AS_OF, run_at=A.RUN_AT)


@query("date_dimension",
       "DateKey:bigint, DateShort:date, DateYear:bigint, DateQuarter:bigint, DateQuarterName:string, "
       "DateMonthNum:bigint, DateMonthName:string, DateDayNum:bigint, DateDayName:string, IsWeekend:bigint",
       _UPSERT_SQL, covers="C1 U3 X19-X24 A8 J9")
def date_dimension(spark, sf_dir):
    return _upserted_calendar(spark, sf_dir)


@query("date_dimension_upsert",
       "DateKey:bigint, IsCurrent:bigint, CreatedBy:string, ModifiedBy:string, DateDayName:string, "
       "IsHoliday_USA:bigint, IsHoliday_PH:bigint", _UPSERT_SQL, covers="C1 (keep/refresh split)")
def date_dimension_upsert(spark, sf_dir):
    return _upserted_calendar(spark, sf_dir)


@query("agg_count_by_year_desc", "DateYear:bigint, n_rows:bigint, n_dates:bigint",
       f"""SELECT DateYear, COUNT(*) AS n_rows, COUNT(DateShort) AS n_dates FROM ({_UPSERT_SQL}) c
GROUP BY DateYear ORDER BY DateYear DESC""", covers="A9 A10 O1")
def agg_count_by_year_desc(spark, sf_dir):
    c = _upserted_calendar(spark, sf_dir)
    return (c.groupBy("DateYear").agg(F.count(F.lit(1)).alias("n_rows"), F.count("DateShort").alias("n_dates"))
            .orderBy(F.col("DateYear").desc()))


@query("agg_second_max", "top_year:bigint, start_year:bigint", """
SELECT (SELECT max(year(o_orderdate)) FROM orders) AS top_year,
       coalesce((SELECT max(year(o_orderdate)) FROM orders
                 WHERE year(o_orderdate) < (SELECT max(year(o_orderdate)) FROM orders)), 1955) AS start_year""",
       covers="A8 J11")
def agg_second_max(spark, sf_dir):
    t = A.Tables(spark, sf_dir)
    # distinct years are a bounded set: one aggregate, no self-join
    ys = t.orders.agg(F.sort_array(F.collect_set(F.year("o_orderdate")), asc=False).alias("ys"))
    return ys.select(F.get("ys", 0).alias("top_year"),
                     F.coalesce(F.get("ys", 1), F.lit(C.CALENDAR_DEFAULT_START_YEAR)).alias("start_year"))

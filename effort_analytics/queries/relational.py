"""Filters, joins, aggregates, set operations and table operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import config as C
from .. import functions as X
from ..operators import dedup_latest, union_by_name_evolve, upsert
from ..operators.joins import anti_missing, join_bounded, semi_existing
from ..plans import analogues as A
from ..plans import facts, targets
from .registry import query
from .sql import ym_sql

# -- filters --------------------------------------------------------------------


@query("filter_conj_notnull", "TaskID:string, TC_ProductiveDate:date, DateYear:bigint, Hours:double", """
SELECT S.TaskID, S.TC_ProductiveDate, D.DateYear, S.Hours
FROM tasks S JOIN dim_date D ON D.DateShort = S.TC_ProductiveDate
WHERE S.Progress = 100 AND S.TC_ProductiveDate IS NOT NULL AND D.DateYear >= 1997""", covers="F1 F2")
def filter_conj_notnull(spark, sf_dir):
    t = A.Tables(spark, sf_dir)
    s = A.tasks(t).where((F.col("Progress") == C.COMPLETED_PROGRESS) & F.col("TC_ProductiveDate").isNotNull())
    cal = A.calendar(spark).where(F.col("DateYear") >= 1997).select(
        F.col("DateShort").alias("TC_ProductiveDate"), "DateYear")
    j = join_bounded(s, cal, "TC_ProductiveDate", small_rows_bound=A.CAL_ROWS)
    return j.select("TaskID", "TC_ProductiveDate", "DateYear", "Hours")


_LEAVE_COLS = "EmployeeID:bigint, TimeOffDate:date, TimeOffTypeforTimeOffEntry:string, Unit:double"


@query("filter_not_like", _LEAVE_COLS, """
SELECT EmployeeID, TimeOffDate, TimeOffTypeforTimeOffEntry, Unit FROM leaves
WHERE TimeOffTypeforTimeOffEntry NOT LIKE 'Business Unit Holiday%'""", covers="F3 X10")
def filter_not_like(spark, sf_dir):
    lv = A.leaves(A.Tables(spark, sf_dir))
    return lv.where(X.not_like_prefix("TimeOffTypeforTimeOffEntry", C.HOLIDAY_LEAVE_PREFIX))


@query("filter_not_in_normalized", _LEAVE_COLS, """
SELECT EmployeeID, TimeOffDate, TimeOffTypeforTimeOffEntry, Unit FROM leaves
WHERE upper(trim(coalesce(TimeOffTypeforTimeOffEntry, ''))) NOT IN
      ('SICK DAY', 'EMERGENCY LEAVE', 'PHILIPPINES UNPAID TIME OFF')""", covers="F4 X8 X9 X14")
def filter_not_in_normalized(spark, sf_dir):
    lv = A.leaves(A.Tables(spark, sf_dir))
    return lv.where(X.not_in_normalized("TimeOffTypeforTimeOffEntry", C.UNPLANNED_LEAVE_TYPES))


@query("filter_not_startswith", "IssueKey:string, Projectname:string", """
SELECT IssueKey, Projectname FROM raw_issues WHERE starts_with(Projectname, 'Generated') = FALSE""",
       covers="F5 X11")
def filter_not_startswith(spark, sf_dir):
    r = A.raw_issues(A.Tables(spark, sf_dir))
    return r.where(F.col("Projectname").startswith(C.ISSUE_EXCLUDED_PROJECT_PREFIX) == F.lit(False))


# -- joins --------------------------------------------------------------------------


@query("join_inner_member", "TaskID:string, WorkdayID:bigint, AssignedTo:string, Hours:double", """
SELECT S.TaskID, M.WorkdayID, M.AssignedTo, S.Hours
FROM tasks S JOIN members M ON M.Office365ID = S.CreatedByOffice365ID""", covers="J1")
def join_inner_member(spark, sf_dir):
    t = A.Tables(spark, sf_dir)
    m = A.members(t).select("Office365ID", "WorkdayID", "AssignedTo")
    j = A.tasks(t).join(m, F.col("CreatedByOffice365ID") == F.col("Office365ID"), "inner")
    return j.select("TaskID", "WorkdayID", "AssignedTo", "Hours")


@query("join_left_enrich", "TaskID:string, BucketID:string, BucketName:string", """
SELECT S.TaskID, S.BucketID, B.BucketName FROM tasks S LEFT OUTER JOIN buckets B ON B.BucketID = S.BucketID""",
       covers="J3")
def join_left_enrich(spark, sf_dir):
    t = A.Tables(spark, sf_dir)
    b = A.buckets(t).select(F.col("BucketID").alias("_b"), "BucketName")
    return (A.tasks(t).join(b, F.col("BucketID") == F.col("_b"), "left")
            .select("TaskID", "BucketID", "BucketName"))


@query("join_date_key", "TaskID:string, DateKey:bigint, DateMonthName:string, DateYearMonthKey:string", """
SELECT S.TaskID, D.DateKey, D.DateMonthName, substring(CAST(D.DateKey AS VARCHAR), 1, 6) AS DateYearMonthKey
FROM tasks S JOIN dim_date D ON D.DateKey = CAST(replace(CAST(S.TC_ProductiveDate AS VARCHAR), '-', '') AS BIGINT)""",
       covers="J4 X4 X5 X23")
def join_date_key(spark, sf_dir):
    t = A.Tables(spark, sf_dir)
    cal = A.calendar(spark).select(F.col("DateShort").alias("TC_ProductiveDate"), "DateKey", "DateMonthName")
    j = join_bounded(A.tasks(t), cal, "TC_ProductiveDate", small_rows_bound=A.CAL_ROWS)
    return j.select("TaskID", "DateKey", "DateMonthName",
                    F.substring(F.col("DateKey").cast("string"), 1, 6).alias("DateYearMonthKey"))


@query("join_bracketed_code",
       "TaskID:string, TC_PlannerCode:string, PlannerCodeKey:string, PlannerName:string, "
       "IsPlannerCodeCorrect:string", """
SELECT S.TaskID, S.TC_PlannerCode, PC.Code AS PlannerCodeKey, PC.Name AS PlannerName,
       CASE WHEN PC.Code IS NULL THEN 'No' ELSE 'Yes' END AS IsPlannerCodeCorrect
FROM tasks S LEFT JOIN planner_codes PC ON PC.Code = '[' || S.TC_PlannerCode || ']'""", covers="J5 X6")
def join_bracketed_code(spark, sf_dir):
    t = A.Tables(spark, sf_dir)
    pc = A.planner_codes(t).select(F.col("Code").alias("PlannerCodeKey"), F.col("Name").alias("PlannerName"))
    j = A.tasks(t).join(pc, F.col("PlannerCodeKey") == X.bracketed("TC_PlannerCode"), "left")
    return j.select("TaskID", "TC_PlannerCode", "PlannerCodeKey", "PlannerName",
                    X.code_found_flag("PlannerCodeKey").alias("IsPlannerCodeCorrect"))


def _rows(spark, sf_dir):
    t = A.Tables(spark, sf_dir)
    return facts.task_leave_rows(A.tasks(t), A.leaves(t), A.members(t), A.buckets(t), A.calendar(spark),
                                 tasks_unique=True, calendar_rows_bound=A.CAL_ROWS)


@query("join_member_month",
       "TaskID:string, Date:date, WorkdayID:bigint, WorkdayIDYearMonthKey:string, TargetHours:double", f"""
SELECT S.TaskID, S."Date", S.WorkdayID,
       CAST(S.WorkdayID AS VARCHAR) || strftime(S."Date", '%Y%m') AS WorkdayIDYearMonthKey, E.TargetHours
FROM task_leave_rows S LEFT JOIN expected E
  ON E.WorkdayID = S.WorkdayID AND E.YearMonth = {ym_sql('S."Date"')}""", covers="J6 X6")
def join_member_month(spark, sf_dir):
    t = A.Tables(spark, sf_dir)
    rows = _rows(spark, sf_dir).withColumn("YearMonth", X.year_month("Date"))
    e = targets.expected_hours(A.members(t), A.calendar(spark), A.AS_OF, A.MIN_YEAR)
    j = rows.join(e, ["WorkdayID", "YearMonth"], "left")
    return j.select("TaskID", "Date", "WorkdayID",
                    F.concat(F.col("WorkdayID").cast("string"), X.year_month_text("Date"))
                    .alias("WorkdayIDYearMonthKey"), "TargetHours")


@query("join_left_null_rejecting", "EmployeeID:bigint, TimeOffDate:date, DateYear:bigint, Unit:double", """
SELECT S.EmployeeID, S.TimeOffDate, D.DateYear, S.Unit
FROM leaves S LEFT JOIN dim_date D ON D.DateShort = S.TimeOffDate WHERE D.DateYear >= 1997""", covers="J8")
def join_left_null_rejecting(spark, sf_dir):
    lv = A.leaves(A.Tables(spark, sf_dir))
    cal = A.calendar(spark).select(F.col("DateShort").alias("TimeOffDate"), "DateYear")
    # the year filter rejects NULLs, so the left join is written as the inner join it is
    j = join_bounded(lv, cal.where(F.col("DateYear") >= 1997), "TimeOffDate", small_rows_bound=A.CAL_ROWS)
    return j.select("EmployeeID", "TimeOffDate", "DateYear", "Unit")


def _order_days(spark, sf_dir):
    return A.Tables(spark, sf_dir).orders.select(F.to_date("o_orderdate").alias("DateShort"))


@query("join_anti_missing", "DateShort:date, DateKey:bigint", """
SELECT D.DateShort, D.DateKey FROM dim_date D
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE CAST(o.o_orderdate AS DATE) = D.DateShort)""",
       covers="J9 F11")
def join_anti_missing(spark, sf_dir):
    cal = A.calendar(spark).select("DateShort", "DateKey")
    return anti_missing(cal, _order_days(spark, sf_dir), "DateShort")


@query("join_semi_existing", "DateShort:date, DateKey:bigint", """
SELECT D.DateShort, D.DateKey FROM dim_date D
WHERE EXISTS (SELECT 1 FROM orders o WHERE CAST(o.o_orderdate AS DATE) = D.DateShort)""", covers="F11")
def join_semi_existing(spark, sf_dir):
    cal = A.calendar(spark).select("DateShort", "DateKey")
    return semi_existing(cal, _order_days(spark, sf_dir), "DateShort")


@query("agg_distinct_then_join", "TaskID:string, Title:string, hours:string, WorkdayID:bigint", """
SELECT S.TaskID, S.Title, S.hours, M.WorkdayID
FROM (SELECT DISTINCT * FROM raw_planner_tasks) S JOIN members M ON M.Office365ID = S.CreatedByOffice365ID""",
       covers="J10 A6")
def agg_distinct_then_join(spark, sf_dir):
    t = A.Tables(spark, sf_dir)
    m = A.members(t).select("Office365ID", "WorkdayID")
    s = A.raw_planner_tasks(t).distinct()
    return s.join(m, F.col("Office365ID") == F.col("CreatedByOffice365ID")).select(
        "TaskID", "Title", "hours", "WorkdayID")


# -- aggregates ---------------------------------------------------------------------


@query("agg_count_by_month", "WorkdayIDYearMonthKey:string, n_tasks:bigint", """
SELECT CAST(M.WorkdayID AS VARCHAR) || strftime(S.TC_ProductiveDate, '%Y%m') AS WorkdayIDYearMonthKey,
       COUNT(1) AS n_tasks
FROM tasks S JOIN members M ON M.Office365ID = S.CreatedByOffice365ID
WHERE S.Progress = 100 AND S.TC_ProductiveDate IS NOT NULL
GROUP BY CAST(M.WorkdayID AS VARCHAR) || strftime(S.TC_ProductiveDate, '%Y%m')""", covers="A2")
def agg_count_by_month(spark, sf_dir):
    t = A.Tables(spark, sf_dir)
    m = A.members(t).select("Office365ID", "WorkdayID")
    s = A.tasks(t).where((F.col("Progress") == 100) & F.col("TC_ProductiveDate").isNotNull())
    j = s.join(m, F.col("Office365ID") == F.col("CreatedByOffice365ID"))
    # group on the two native columns; the concatenated key is output only
    g = j.groupBy("WorkdayID", X.year_month_text("TC_ProductiveDate").alias("ym")).agg(
        F.count(F.lit(1)).alias("n_tasks"))
    return g.select(F.concat(F.col("WorkdayID").cast("string"), "ym").alias("WorkdayIDYearMonthKey"), "n_tasks")


@query("agg_sum_product", "EmployeeID:bigint, leave_hours:double", """
SELECT EmployeeID, SUM(TC_Hours * Unit) AS leave_hours FROM leaves GROUP BY EmployeeID""", covers="A4 X26")
def agg_sum_product(spark, sf_dir):
    lv = A.leaves(A.Tables(spark, sf_dir))
    return lv.groupBy("EmployeeID").agg(F.sum(F.col("TC_Hours") * F.col("Unit")).alias("leave_hours"))


@query("agg_distinct_rows", "CreatedByOffice365ID:string, TC_PlannerCode:string, BucketID:string", """
SELECT DISTINCT CreatedByOffice365ID, TC_PlannerCode, BucketID FROM tasks""", covers="A5")
def agg_distinct_rows(spark, sf_dir):
    return A.tasks(A.Tables(spark, sf_dir)).select("CreatedByOffice365ID", "TC_PlannerCode", "BucketID").distinct()


# -- set operations -------------------------------------------------------------------


@query("union_task_leave",
       "TaskID:string, Date:date, Category:string, PlannerCode:string, Hours:double, AssignedTo:string, "
       "Role:string, Squad:string, ManagerName:string, WorkdayID:bigint",
       "SELECT * FROM task_leave_rows", covers="U2 P4")
def union_task_leave(spark, sf_dir):
    return _rows(spark, sf_dir)


@query("set_union_by_name_evolve",
       "EmployeeID:bigint, TimeOffDate:date, TimeOffTypeforTimeOffEntry:string, Unit:double, "
       "UnitofTime:string, DayoftheWeek:string", """
SELECT EmployeeID, TimeOffDate, TimeOffTypeforTimeOffEntry, Unit, NULL AS UnitofTime, NULL AS DayoftheWeek
FROM leaves WHERE TimeOffDate < DATE '1998-01-01'
UNION ALL
SELECT EmployeeID, TimeOffDate, TimeOffTypeforTimeOffEntry, Unit, UnitofTime, DayoftheWeek
FROM leaves WHERE TimeOffDate >= DATE '1998-01-01'""", covers="K4 U4")
def set_union_by_name_evolve(spark, sf_dir):
    lv = A.leaves(A.Tables(spark, sf_dir))
    old = lv.where(F.col("TimeOffDate") < F.lit(dt.date(1998, 1, 1))).select(
        "EmployeeID", "TimeOffDate", "TimeOffTypeforTimeOffEntry", "Unit")
    new = lv.where(F.col("TimeOffDate") >= F.lit(dt.date(1998, 1, 1))).select(
        "DayoftheWeek", "UnitofTime", "Unit", "TimeOffTypeforTimeOffEntry", "TimeOffDate", "EmployeeID")
    return union_by_name_evolve(old, new)


# -- projections ---------------------------------------------------------------------


@query("proj_rename_drop", "BucketName:string, BucketID:string, IsActive:bigint, UploadBy:string",
       "SELECT BucketName, BucketID, IsActive, 'svc_load' AS UploadBy FROM buckets",
       covers="P2 P3 P4 C18")
def proj_rename_drop(spark, sf_dir):
    return A.buckets(A.Tables(spark, sf_dir))


@query("proj_audit", "Category:string, Type:string, UploadDate:string, UploadBy:string", """
SELECT Category, "Type", '2001-01-01 06:00:00' AS UploadDate, 'svc_load' AS UploadBy FROM productivity_types""",
       covers="P5 P3 C18")
def proj_audit(spark, sf_dir):
    return A.productivity_types(A.Tables(spark, sf_dir))


# -- table maintenance -----------------------------------------------------------------

_LINE_KEYS = ["l_orderkey", "l_linenumber"]
_LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey"]
_LINE_COLS = ("l_orderkey:bigint, l_linenumber:bigint, l_partkey:bigint, l_suppkey:bigint, l_quantity:double, "
              "l_extendedprice:double, l_discount:double, l_tax:double, l_returnflag:string, "
              "l_linestatus:string, l_shipdate:date")
_LINE_DEDUP = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
      l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
      l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST,
      l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS rn
  FROM ({src}) s) x WHERE rn = 1"""


def _lineitem(spark, sf_dir):
    return A.Tables(spark, sf_dir).lineitem


@query("dedup_latest", _LINE_COLS, _LINE_DEDUP.format(src="SELECT * FROM lineitem"), covers="K7b")
def dedup_latest_q(spark, sf_dir):
    return dedup_latest(_lineitem(spark, sf_dir), _LINE_KEYS, _LINE_ORDER)


@query("upsert_by_key", _LINE_COLS, f"""
WITH tgt AS ({_LINE_DEDUP.format(src="SELECT * FROM lineitem WHERE l_returnflag <> 'R'")}),
     src AS ({_LINE_DEDUP.format(src="SELECT * FROM lineitem WHERE l_returnflag = 'R'")})
SELECT * FROM tgt WHERE NOT EXISTS
  (SELECT 1 FROM src WHERE src.l_orderkey = tgt.l_orderkey AND src.l_linenumber = tgt.l_linenumber)
UNION ALL SELECT * FROM src""", covers="K7")
def upsert_by_key(spark, sf_dir):
    li = _lineitem(spark, sf_dir)
    target = dedup_latest(li.where(F.col("l_returnflag") != "R"), _LINE_KEYS, _LINE_ORDER)
    source = dedup_latest(li.where(F.col("l_returnflag") == "R"), _LINE_KEYS, _LINE_ORDER)
    return upsert(target, source, _LINE_KEYS)

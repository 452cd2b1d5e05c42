"""Scalar-function queries (string, number, date, status rules) over derived text."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as X
from ..plans import analogues as A
from .registry import query
from .sql import AS_OF, RUN_YEAR, bracket_sql, datekey_sql, hours_sql, seconds_sql, whole_sql


def _title_variants(part):
    k = F.col("p_partkey") % 7
    b, n = F.col("p_brand"), F.col("p_name")
    title = (F.when(k == 0, F.concat(F.lit("["), b, F.lit("] "), n))
             .when(k == 1, F.concat(F.lit("pre ["), b, F.lit("] "), n))
             .when(k == 2, F.concat(F.lit("] "), n))
             .when(k == 3, F.concat(F.lit("[["), b, F.lit("]x] "), n))
             .when(k == 4, F.concat(F.lit("[open "), n))
             .when(k == 5, n))
    return part.select("p_partkey", title.alias("title"))


_TITLE_SQL = """
SELECT p_partkey,
       CASE p_partkey % 7 WHEN 0 THEN '[' || p_brand || '] ' || p_name
            WHEN 1 THEN 'pre [' || p_brand || '] ' || p_name WHEN 2 THEN '] ' || p_name
            WHEN 3 THEN '[[' || p_brand || ']x] ' || p_name WHEN 4 THEN '[open ' || p_name
            WHEN 5 THEN p_name END AS title
FROM part"""


@query("str_bracket_tag", "p_partkey:bigint, title:string, pos:bigint, code:string",
       f"SELECT p_partkey, title, strpos(title, ']') AS pos, {bracket_sql('title')} AS code FROM ({_TITLE_SQL}) t",
       covers="C2 X1 X2 X5")
def str_bracket_tag(spark, sf_dir):
    t = _title_variants(A.Tables(spark, sf_dir).part)
    return t.select("p_partkey", "title", X.charindex("]", "title").alias("pos"),
                    X.bracket_code("title").alias("code"))


@query("str_split_name_id", "s_suppkey:bigint, worker:string, name:string, employee_id:bigint", """
SELECT s_suppkey, worker, split_part(worker, '(', 1) AS name,
       TRY_CAST(split_part(split_part(worker, '(', 2), ')', 1) AS BIGINT) AS employee_id
FROM (SELECT s_suppkey,
             CASE s_suppkey % 4 WHEN 0 THEN s_name || ' (' || CAST(s_suppkey AS VARCHAR) || ')'
                  WHEN 1 THEN s_name || ' (' || CAST(s_suppkey AS VARCHAR) || ') (On Leave)'
                  WHEN 2 THEN s_name ELSE s_name || ' (x' || CAST(s_suppkey AS VARCHAR) || ')' END AS worker
      FROM supplier) s""", covers="C8 X12")
def str_split_name_id(spark, sf_dir):
    s = A.Tables(spark, sf_dir).supplier
    k, key = F.col("s_suppkey") % 4, F.col("s_suppkey").cast("string")
    worker = (F.when(k == 0, F.concat("s_name", F.lit(" ("), key, F.lit(")")))
              .when(k == 1, F.concat("s_name", F.lit(" ("), key, F.lit(") (On Leave)")))
              .when(k == 2, F.col("s_name"))
              .otherwise(F.concat("s_name", F.lit(" (x"), key, F.lit(")"))))
    s = s.select("s_suppkey", worker.alias("worker"))
    name, ident = X.split_name_id("worker")
    return s.select("s_suppkey", "worker", name.alias("name"), ident.alias("employee_id"))


@query("str_trim_upper_like", "Type:string, norm:string, not_holiday:bigint, is_planned:bigint, n:bigint", """
SELECT "Type", upper(trim(coalesce("Type", ''))) AS norm,
       CAST("Type" NOT LIKE 'Business Unit Holiday%' AS BIGINT) AS not_holiday,
       CAST(upper(trim(coalesce("Type", ''))) NOT IN ('SICK DAY', 'EMERGENCY LEAVE', 'PHILIPPINES UNPAID TIME OFF')
            AS BIGINT) AS is_planned,
       COUNT(*) AS n
FROM raw_leaves GROUP BY "Type" """, covers="X8 X9 X10 X11 F3 F4")
def str_trim_upper_like(spark, sf_dir):
    from .. import config as C
    lv = A.raw_leaves(A.Tables(spark, sf_dir))
    return (lv.groupBy("Type").agg(F.count(F.lit(1)).alias("n"))
            .select("Type", X.normalized("Type").alias("norm"),
                    X.not_like_prefix("Type", C.HOLIDAY_LEAVE_PREFIX).cast("bigint").alias("not_holiday"),
                    X.not_in_normalized("Type", C.UNPLANNED_LEAVE_TYPES).cast("bigint").alias("is_planned"),
                    "n"))


@query("date_parts",
       "o_orderkey:bigint, d:date, date_key:bigint, ym:string, year:bigint, quarter:bigint, "
       "quarter_name:string, month:bigint, month_name:string, day:bigint, day_name:string, "
       "dow:bigint, is_weekend:bigint", f"""
SELECT o_orderkey, d, {datekey_sql('d')} AS date_key, strftime(d, '%Y%m') AS ym, year(d) AS year,
       quarter(d) AS quarter, 'Q' || CAST(quarter(d) AS VARCHAR) || '-' || CAST(year(d) AS VARCHAR) AS quarter_name,
       month(d) AS month, monthname(d) AS month_name, day(d) AS day, dayname(d) AS day_name,
       dayofweek(d) + 1 AS dow, CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders) o""",
       covers="X4 X17 X19 X20 X21 X22 X23")
def date_parts(spark, sf_dir):
    o = A.Tables(spark, sf_dir).orders.select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    d = F.col("d")
    return o.select("o_orderkey", "d", X.date_key(d).alias("date_key"), X.year_month_text(d).alias("ym"),
                    F.year(d).alias("year"), F.quarter(d).alias("quarter"),
                    X.quarter_name(d).alias("quarter_name"), F.month(d).alias("month"),
                    X.month_name(d).alias("month_name"), F.dayofmonth(d).alias("day"),
                    X.day_name(d).alias("day_name"), F.dayofweek(d).alias("dow"),
                    X.is_weekend(d).alias("is_weekend"))


# progress text with fractions, signs and words, by the task's line number
_PROGRESS_SQL = """(Progress || CASE right(TaskID, 2) WHEN '-1' THEN '.0' WHEN '-2' THEN '.75' WHEN '-3' THEN 'e1'
                    WHEN '-4' THEN ' %' ELSE '' END)"""


def _progress_text():
    line = F.right("TaskID", F.lit(2))
    return F.concat("Progress", F.when(line == "-1", ".0").when(line == "-2", ".75").when(line == "-3", "e1")
                    .when(line == "-4", " %").otherwise(""))


@query("cast_safe",
       "TaskID:string, progress:bigint, completed:date, created_iso:date, bad_date:date", f"""
SELECT TaskID, {whole_sql(_PROGRESS_SQL)} AS progress, TRY_CAST(CompletedDate AS DATE) AS completed,
       TRY_CAST(CreatedDate || 'T10:00:00Z' AS DATE) AS created_iso,
       TRY_CAST('x' || CreatedDate AS DATE) AS bad_date
FROM raw_planner_tasks""", covers="X15 X16")
def cast_safe(spark, sf_dir):
    r = A.raw_planner_tasks(A.Tables(spark, sf_dir))
    return r.select("TaskID", X.whole_number(_progress_text()).alias("progress"),
                    X.to_date_safe("CompletedDate").alias("completed"),
                    X.to_date_safe(F.concat("CreatedDate", F.lit("T10:00:00Z"))).alias("created_iso"),
                    X.to_date_safe(F.concat(F.lit("x"), "CreatedDate")).alias("bad_date"))


@query("num_seconds_to_hours", "IssueKey:string, TimeSpent:string, Hours:double",
       f"SELECT IssueKey, TimeSpent, {seconds_sql('TimeSpent')} AS Hours FROM raw_issues",
       covers="C7 X26")
def num_seconds_to_hours(spark, sf_dir):
    r = A.raw_issues(A.Tables(spark, sf_dir))
    return r.select("IssueKey", "TimeSpent", X.seconds_to_hours("TimeSpent").alias("Hours"))


def _dirty_hours(lineitem):
    q = F.col("l_quantity").cast("bigint").cast("string")
    v = (F.col("l_orderkey") + F.col("l_linenumber")) % 16
    choices = [F.concat(q, F.lit(".5")), F.concat(F.lit("."), (F.col("l_quantity").cast("bigint") % 10).cast("string")),
               F.concat(q, F.lit(".")), F.lit("."), q, F.lit(""), F.lit("abc"), F.concat(q, F.lit(",5")),
               F.concat(F.lit(" "), q, F.lit(" ")), F.lit("1e2"), F.concat(F.lit("-"), q), F.lit("-.5"),
               F.lit("1.2.3"), F.concat(q, F.lit(".555")), F.lit(None).cast("string"), F.lit("2000000000")]
    expr = F.when(v == 0, choices[0])
    for i, c in enumerate(choices[1:], start=1):
        expr = expr.when(v == i, c)
    return lineitem.select("l_orderkey", "l_linenumber", expr.alias("hours_text"))


_DIRTY_HOURS_SQL = """
SELECT l_orderkey, l_linenumber,
       CASE (l_orderkey + l_linenumber) % 16
            WHEN 0 THEN q || '.5' WHEN 1 THEN '.' || CAST(CAST(l_quantity AS BIGINT) % 10 AS VARCHAR)
            WHEN 2 THEN q || '.' WHEN 3 THEN '.' WHEN 4 THEN q WHEN 5 THEN '' WHEN 6 THEN 'abc'
            WHEN 7 THEN q || ',5' WHEN 8 THEN ' ' || q || ' ' WHEN 9 THEN '1e2' WHEN 10 THEN '-' || q
            WHEN 11 THEN '-.5' WHEN 12 THEN '1.2.3' WHEN 13 THEN q || '.555' WHEN 14 THEN NULL
            ELSE '2000000000' END AS hours_text
FROM (SELECT *, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS q FROM lineitem) l"""


@query("hours_normalize",
       "l_orderkey:bigint, l_linenumber:bigint, hours_text:string, hours:double, has_comma:bigint",
       f"""SELECT l_orderkey, l_linenumber, hours_text, {hours_sql('hours_text')} AS hours,
       CAST(hours_text LIKE '%,%' AS BIGINT) AS has_comma FROM ({_DIRTY_HOURS_SQL}) h""",
       covers="C3 X7 X13 F9")
def hours_normalize(spark, sf_dir):
    h = _dirty_hours(A.Tables(spark, sf_dir).lineitem)
    return h.select("l_orderkey", "l_linenumber", "hours_text", X.hours_decimal("hours_text").alias("hours"),
                    F.col("hours_text").contains(",").cast("bigint").alias("has_comma"))


@query("status_normalize", "id:string, source:string, progress:bigint, status:string", f"""
SELECT TaskID AS id, 'planner' AS source, {whole_sql(_PROGRESS_SQL)} AS progress,
       CASE WHEN Progress = '0' THEN 'Not Started' WHEN Progress = '50' THEN 'In Progress'
            WHEN Progress = '100' THEN 'COMPLETED' ELSE 'NOT RECOGNIZED PLEASE CONTACT ADMIN' END AS status
FROM raw_planner_tasks
UNION ALL
SELECT IssueKey, 'issue',
       CASE WHEN Status = 'Done' THEN 100 ELSE 0 END,
       CASE WHEN Status = 'To Do' THEN 'Not Started' WHEN Status IN ('In Progress', 'In Review') THEN 'In Progress'
            WHEN Status = 'Done' THEN 'COMPLETED' ELSE 'NOT RECOGNIZED PLEASE CONTACT ADMIN' END
FROM raw_issues""", covers="C4 C5 F8")
def status_normalize(spark, sf_dir):
    t = A.Tables(spark, sf_dir)
    p = A.raw_planner_tasks(t).select(F.col("TaskID").alias("id"), F.lit("planner").alias("source"),
                                      X.planner_progress(_progress_text()).alias("progress"),
                                      X.planner_status("Progress").alias("status"))
    i = A.raw_issues(t).select(F.col("IssueKey").alias("id"), F.lit("issue").alias("source"),
                               X.issue_progress(F.lit(""), "Status").alias("progress"),
                               X.issue_status(F.lit(""), "Status").alias("status"))
    return p.unionByName(i)


@query("productive_date", "id:string, productive_date:date", """
SELECT TaskID AS id,
       CASE WHEN Progress = '100' AND DueDate IS NOT NULL THEN TRY_CAST(DueDate AS DATE)
            WHEN Progress = '100' AND StartDate IS NOT NULL THEN TRY_CAST(StartDate AS DATE)
            ELSE TRY_CAST(CompletedDate AS DATE) END AS productive_date
FROM raw_planner_tasks
UNION ALL
SELECT IssueKey,
       CASE WHEN Status = 'Done' AND Resolved IS NOT NULL AND trim(Resolved) <> '' THEN TRY_CAST(Resolved AS DATE)
            WHEN Status = 'Done' AND Created IS NOT NULL THEN TRY_CAST(Created AS DATE) ELSE NULL END
FROM raw_issues""", covers="C6")
def productive_date(spark, sf_dir):
    t = A.Tables(spark, sf_dir)
    p = A.raw_planner_tasks(t).select(
        F.col("TaskID").alias("id"),
        X.planner_productive_date("Progress", "DueDate", "StartDate", "CompletedDate").alias("productive_date"))
    i = A.raw_issues(t).select(
        F.col("IssueKey").alias("id"),
        X.issue_productive_date("Status", "Resolved", "Created").alias("productive_date"))
    return p.unionByName(i)


@query("date_blank_to_null", "IssueKey:string, Resolved:string, is_blank:bigint, CompletedDate:date", """
SELECT IssueKey, Resolved, CAST(trim(Resolved) = '' AS BIGINT) AS is_blank,
       TRY_CAST(CASE WHEN trim(Resolved) = '' THEN NULL ELSE Resolved END AS DATE) AS CompletedDate
FROM raw_issues""", covers="F10")
def date_blank_to_null(spark, sf_dir):
    r = A.raw_issues(A.Tables(spark, sf_dir))
    return r.select("IssueKey", "Resolved", (F.trim("Resolved") == "").cast("bigint").alias("is_blank"),
                    X.issue_completed_date("Resolved").alias("CompletedDate"))


@query("proj_full_name", "FullName:string", """
SELECT DISTINCT split_part(n, '#', 1) || ' ' || split_part(n, '#', 2) AS FullName
FROM (SELECT s_name AS n FROM supplier UNION ALL SELECT c_name FROM customer) p""", covers="C19 X6 A5")
def proj_full_name(spark, sf_dir):
    from ..plans.facts import distinct_full_names
    t = A.Tables(spark, sf_dir)
    people = (t.supplier.select(F.col("s_name").alias("n"))
              .unionByName(t.customer.select(F.col("c_name").alias("n"))))
    people = people.select(F.split_part("n", F.lit("#"), F.lit(1)).alias("GivenName"),
                           F.split_part("n", F.lit("#"), F.lit(2)).alias("Surname"))
    return distinct_full_names(people)


@query("filter_as_of", "EmployeeID:bigint, TimeOffDate:date, DateKey:bigint", f"""
SELECT EmployeeID, TimeOffDate, {datekey_sql('TimeOffDate')} AS DateKey FROM leaves
WHERE {datekey_sql('TimeOffDate')} <= {datekey_sql(AS_OF)} AND year(TimeOffDate) = {RUN_YEAR}""",
       covers="F6")
def filter_as_of(spark, sf_dir):
    lv = A.leaves(A.Tables(spark, sf_dir))
    # a range of dates, so that the scan can skip
    dates = F.col("TimeOffDate").between(F.lit(A.AS_OF.replace(month=1, day=1)), F.lit(A.AS_OF))
    return lv.where(dates).select("EmployeeID", "TimeOffDate", X.date_key("TimeOffDate").alias("DateKey"))

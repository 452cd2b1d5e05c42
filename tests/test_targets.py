"""Expected hours (scale form vs literal form), deduction, under-target filter."""

import datetime as dt
from decimal import Decimal

import duckdb
from pyspark.sql import functions as F

from effort_analytics.plans import analogues as A
from effort_analytics.plans import targets as T
from effort_analytics.plans.calendar import generate_calendar

from .conftest import SF0001, SF001

MEMBER_EDGES = [
    (1, dt.date(1990, 1, 1), dt.date(9999, 12, 31)),   # starts before the calendar, open end
    (2, dt.date(2020, 3, 10), dt.date(2020, 3, 20)),   # inside one month
    (3, dt.date(2020, 3, 15), dt.date(2020, 2, 1)),    # end before start
    (4, dt.date(2019, 1, 1), dt.date(2019, 6, 30)),    # rehire: same id twice, disjoint
    (4, dt.date(2020, 1, 1), dt.date(9999, 12, 31)),
    (5, dt.date(2020, 3, 14), dt.date(2020, 3, 15)),   # weekend only
    (6, dt.date(2000, 1, 1), dt.date(2005, 1, 1)),     # ends before the data
    (7, None, dt.date(2020, 1, 1)),                    # missing start
    (8, dt.date(2020, 1, 31), dt.date(2020, 2, 1)),    # month boundary
]


def test_scale_form_equals_literal_form(spark):
    cal = generate_calendar(spark, dt.date(2018, 1, 1), dt.date(2022, 1, 1))
    members = spark.createDataFrame(MEMBER_EDGES, "WorkdayID bigint, StartDate date, EndDate date")
    as_of = dt.date(2021, 5, 17)
    a = T.expected_hours(members, cal, as_of, 2019)
    b = T.expected_hours_literal(members, cal, as_of, 2019)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(a) == rows(b) and len(rows(a)) > 20
    # and with the month window the flagship uses
    c = T.expected_hours(members, cal, as_of, 2019, months=(dt.date(2020, 1, 1), dt.date(2020, 12, 1)))
    assert rows(c) == rows(b.where((F.col("YearMonth") >= 202001) & (F.col("YearMonth") <= 202012)))


def test_scale_form_has_no_nested_loop(spark):
    cal = generate_calendar(spark, dt.date(2018, 1, 1), dt.date(2022, 1, 1))
    members = spark.createDataFrame(MEMBER_EDGES, "WorkdayID bigint, StartDate date, EndDate date")
    plan = T.expected_hours(members, cal, dt.date(2021, 5, 17), 2019)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    lit = T.expected_hours_literal(members, cal, dt.date(2021, 5, 17), 2019)
    assert "NestedLoop" in lit._jdf.queryExecution().executedPlan().toString()


def test_planned_leave_deduction_rules(spark):
    cal = generate_calendar(spark, dt.date(2020, 1, 1), dt.date(2021, 1, 1))
    leaves = spark.createDataFrame(
        [(1, dt.date(2020, 2, 3), "Vacation", Decimal("1.00")), (1, dt.date(2020, 2, 4), None, Decimal("1.00")),
         (1, dt.date(2020, 2, 5), " sick day ", Decimal("1.00")), (1, dt.date(2020, 2, 6), "Vacation", Decimal("-1.00")),
         (1, dt.date(2020, 2, 7), "Vacation", Decimal("0.50")), (1, dt.date(2030, 1, 1), "Vacation", Decimal("1.00")),
         (1, None, "Vacation", Decimal("1.00"))],
        "EmployeeID bigint, TimeOffDate date, TimeOffTypeforTimeOffEntry string, Unit decimal(10,2)"
    ).withColumn("TC_Hours", F.lit(Decimal("7.5")).cast("decimal(10,2)"))
    out = T.planned_leave_deduction(leaves, cal).collect()
    assert [(r.WorkdayID, r.YearMonth, r.TotalHoursToDeduct) for r in out] == [(1, 202002, Decimal("11.2500"))]


def test_flag_is_strict_and_null_target_never_flags(spark):
    facts = spark.createDataFrame(
        [("202001", 2020, "January", "A", 1, "s", "m", Decimal("75"), Decimal("100")),
         ("202002", 2020, "February", "A", 1, "s", "m", Decimal("74.99"), Decimal("100")),
         ("202003", 2020, "March", "A", 1, "s", "m", Decimal("1"), None),
         ("201912", 2019, "December", "A", 1, "s", "m", Decimal("1"), Decimal("100"))],
        "DateYearMonthKey string, DateYear int, DateMonthName string, AssignedTo string, WorkdayID bigint, "
        "Squad string, ManagerName string, Hours decimal(10,2), FinalTargetHours decimal(10,2)")
    out = T.flag_under_target(facts, 2020).collect()
    assert [r.DateYearMonthKey for r in out] == ["202002"]


APPENDIX_A = """
WITH dim_date AS (
  SELECT CAST(strftime(d,'%Y%m%d') AS BIGINT) AS date_key, d AS date_short, year(d) AS date_year,
         CASE WHEN dayofweek(d) IN (0,6) THEN 1 ELSE 0 END AS is_weekend
  FROM (SELECT CAST(x AS DATE) FROM generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY) g(x)) t(d)),
members AS (
  SELECT s_suppkey AS member_id, s_name AS member_name, s_nationkey AS squad,
         DATE '1995-01-01' + CAST(s_suppkey % 700 AS INT) AS start_date,
         CASE WHEN s_suppkey % 4 = 0 THEN DATE '1999-12-31' ELSE DATE '9999-12-31' END AS end_date
  FROM supplier),
tasks AS (
  SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey AS member_id, CAST(l_shipdate AS DATE) AS d,
         CAST(l_quantity AS DECIMAL(10,2)) AS hours FROM lineitem WHERE l_returnflag <> 'R'),
leaves AS (
  SELECT l_suppkey AS member_id, CAST(l_shipdate AS DATE) AS d,
         CASE WHEN l_linenumber = 1 THEN 'SICK DAY' WHEN l_linenumber = 2 THEN 'Business Unit Holiday' ELSE 'Vacation' END AS leave_type,
         CAST(l_discount AS DECIMAL(10,2)) * CAST(7.5 AS DECIMAL(10,2)) AS hours FROM lineitem WHERE l_returnflag = 'R'),
main AS (
  SELECT member_id, d, hours FROM tasks UNION ALL
  SELECT member_id, d, hours FROM leaves WHERE leave_type NOT LIKE 'Business Unit Holiday%'),
planned AS (
  SELECT l.member_id, CAST(floor(dd.date_key / 100) AS BIGINT) AS ym, SUM(l.hours) AS deduct
  FROM leaves l JOIN dim_date dd ON dd.date_short = l.d
  WHERE upper(trim(coalesce(leave_type, ''))) NOT IN ('SICK DAY', 'EMERGENCY LEAVE') GROUP BY 1, 2),
expected AS (
  SELECT m.member_id, CAST(floor(dd.date_key / 100) AS BIGINT) AS ym, COUNT(*) * 7.5 AS target
  FROM members m JOIN dim_date dd ON dd.is_weekend = 0 AND dd.date_short BETWEEN m.start_date AND m.end_date
   AND dd.date_short <= DATE '2000-12-31' GROUP BY 1, 2),
facts AS (
  SELECT x.member_id, m.member_name, m.squad, dd.date_year, CAST(floor(dd.date_key / 100) AS BIGINT) AS ym, x.hours
  FROM main x JOIN members m ON m.member_id = x.member_id JOIN dim_date dd ON dd.date_short = x.d),
totals AS (
  SELECT f.member_id, f.member_name, f.squad, f.ym, SUM(f.hours) AS total_hours, e.target - coalesce(p.deduct, 0) AS final_target
  FROM facts f LEFT JOIN expected e ON e.member_id = f.member_id AND e.ym = f.ym
  LEFT JOIN planned p ON p.member_id = f.member_id AND p.ym = f.ym
  WHERE f.date_year = 2000 GROUP BY f.member_id, f.member_name, f.squad, f.ym, e.target - coalesce(p.deduct, 0))
SELECT member_id, member_name, squad, ym, CAST(total_hours AS DOUBLE) AS total_hours, CAST(final_target AS DOUBLE) AS final_target
FROM totals WHERE total_hours < final_target * 0.75
"""


def _appendix_a_spark(spark, sf_dir):
    """The acceptance statement composed from library pieces (no completed filter,
    no DISTINCT, Appendix A's simplified inputs)."""
    t = A.Tables(spark, sf_dir)
    cal = generate_calendar(spark, dt.date(1995, 1, 1), dt.date(2002, 1, 1), with_sentinels=False)
    members = t.supplier.select(
        F.col("s_suppkey").alias("WorkdayID"), F.col("s_name").alias("AssignedTo"),
        F.col("s_nationkey").cast("string").alias("Squad"), F.lit("m").alias("ManagerName"),
        F.date_add(F.lit(dt.date(1995, 1, 1)), (F.col("s_suppkey") % 700).cast("int")).alias("StartDate"),
        F.when(F.col("s_suppkey") % 4 == 0, F.lit(dt.date(1999, 12, 31))).otherwise(F.lit(dt.date(9999, 12, 31)))
        .alias("EndDate"))
    li = t.lineitem
    tasks = li.where(F.col("l_returnflag") != "R").select(
        F.col("l_suppkey").alias("WorkdayID"), F.to_date("l_shipdate").alias("Date"),
        F.col("l_quantity").cast("decimal(10,2)").cast("decimal(21,4)").alias("Hours"))
    leaves = li.where(F.col("l_returnflag") == "R").select(
        F.col("l_suppkey").alias("EmployeeID"), F.to_date("l_shipdate").alias("TimeOffDate"),
        F.when(F.col("l_linenumber") == 1, "SICK DAY").when(F.col("l_linenumber") == 2, "Business Unit Holiday")
        .otherwise("Vacation").alias("TimeOffTypeforTimeOffEntry"),
        F.col("l_discount").cast("decimal(10,2)").alias("Unit"), F.lit(Decimal("7.5")).cast("decimal(10,2)").alias("TC_Hours"))
    main = tasks.unionByName(
        leaves.where(~F.col("TimeOffTypeforTimeOffEntry").startswith("Business Unit Holiday")).select(
            F.col("EmployeeID").alias("WorkdayID"), F.col("TimeOffDate").alias("Date"),
            (F.col("TC_Hours") * F.col("Unit")).cast("decimal(21,4)").alias("Hours")))
    expected = T.expected_hours(members, cal, dt.date(2000, 12, 31), 1995)
    planned = T.planned_leave_deduction(leaves, cal, excluded_types=("SICK DAY", "EMERGENCY LEAVE"))
    facts = (main.join(members.select("WorkdayID", "AssignedTo", "Squad", "ManagerName"), "WorkdayID")
             .withColumn("YearMonth", (F.year("Date") * 100 + F.month("Date")).cast("bigint"))
             .withColumn("DateYear", F.year("Date"))
             .join(expected, ["WorkdayID", "YearMonth"], "left").join(planned, ["WorkdayID", "YearMonth"], "left")
             .withColumn("FinalTargetHours", F.col("TargetHours") - F.coalesce("TotalHoursToDeduct", F.lit(0)))
             .withColumn("DateYearMonthKey", F.col("YearMonth").cast("string"))
             .withColumn("DateMonthName", F.date_format("Date", "MMMM")))
    return T.flag_under_target(facts, 2000)


def _appendix_a_duck(sf_dir):
    con = duckdb.connect()
    for name in ("supplier", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con.sql(APPENDIX_A).fetchall()


def test_appendix_a_acceptance_counts(spark):
    for sf_dir, expected_rows in ((SF0001, 33), (SF001, 469)):
        got = _appendix_a_spark(spark, sf_dir).collect()
        duck = _appendix_a_duck(sf_dir)
        assert len(got) == len(duck) == expected_rows
        mine = sorted((r.WorkdayID, int(r.DateYearMonthKey), float(r.TotalHours), float(r.FinalTargetHours)) for r in got)
        theirs = sorted((r[0], r[3], r[4], r[5]) for r in duck)
        assert mine == theirs

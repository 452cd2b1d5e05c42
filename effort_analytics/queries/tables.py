"""Table queries: loads that replace each other in part, published upserts, snapshots found by their
folders, fixed-schema tables, empty clones, audit values, a calendar from scratch.

Those that write use a folder of their own below the shared one, and read it back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ..operators.project import with_audit
from ..operators.snapshot import newest_entries
from ..operators.tables import empty_like, union_by_name_evolve
from ..plans import analogues as A
from ..plans import calendar as cal_plans
from ..plans import targets
from ..plans.jobs import LEAVE_ENTRY
from ..session import shared_dir
from ..sources import create_table, insert_into, read_keyed, read_newest, upsert_keyed
from .registry import query
from .sql import AS_OF

RUN_DATE = dt.date(2000, 3, 15)


def _own(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("leaves_newest_entries", "EmployeeID:bigint, TimeOffDate:date, LeaveType:string, Unit:double, n_rows:bigint", """
WITH loads AS (
  SELECT 9 AS load_id, EmployeeID, TimeOffDate, TimeOffTypeforTimeOffEntry AS LeaveType, Unit FROM leaves
  UNION ALL
  SELECT 10, EmployeeID, TimeOffDate, TimeOffTypeforTimeOffEntry, Unit * 2 FROM leaves WHERE EmployeeID % 7 = 0
  UNION ALL
  SELECT 10, EmployeeID, TimeOffDate + 4000, TimeOffTypeforTimeOffEntry, Unit FROM leaves WHERE EmployeeID % 11 = 0),
newest AS (SELECT *, max(load_id) OVER (PARTITION BY EmployeeID, TimeOffDate, LeaveType) AS last FROM loads)
SELECT EmployeeID, TimeOffDate, LeaveType, Unit, COUNT(*) AS n_rows FROM newest WHERE load_id = last
GROUP BY EmployeeID, TimeOffDate, LeaveType, Unit""", covers="K3 D1")
def leaves_newest_entries(spark, sf_dir):
    """Load 9 holds all entries; load 10 changes those of some workers and adds later days of others."""
    first = A.leaves(A.Tables(spark, sf_dir))
    changed = first.where(F.col("EmployeeID") % 7 == 0).withColumn("Unit", (F.col("Unit") * 2).cast("decimal(10,2)"))
    added = first.where(F.col("EmployeeID") % 11 == 0).withColumn("TimeOffDate", F.date_add("TimeOffDate", 4000))
    loads = first.withColumn("load_id", F.lit("9")).unionByName(changed.unionByName(added).withColumn("load_id", F.lit("10")))
    keys = [F.col("EmployeeID"), F.col("TimeOffDate"), F.col("TimeOffTypeforTimeOffEntry").alias("LeaveType"), F.col("Unit")]
    return newest_entries(loads, LEAVE_ENTRY).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


@query("upsert_keyed_publish", "o_orderkey:bigint, o_orderstatus:string, o_totalprice:double", """
WITH first AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 3 <> 1),
second AS (SELECT o_orderkey, 'X' AS o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderkey % 5 = 0)
SELECT * FROM second UNION ALL SELECT * FROM first f WHERE NOT EXISTS (SELECT 1 FROM second s WHERE s.o_orderkey = f.o_orderkey)""",
       covers="K7 C10")
def upsert_keyed_publish(spark, sf_dir):
    """A first load and an upsert, each published in one step, and the table read back."""
    o = A.Tables(spark, sf_dir).orders
    path = _own(spark, "orders")
    upsert_keyed(o.where(F.col("o_orderkey") % 3 != 1).select("o_orderkey", "o_orderstatus", "o_totalprice"), path, "o_orderkey", buckets=16)
    upsert_keyed(o.where(F.col("o_orderkey") % 5 == 0).select("o_orderkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice")),
                 path, "o_orderkey", buckets=16)
    return read_keyed(spark, path)


@query("planned_leave_clipped", "WorkdayID:bigint, YearMonth:bigint, TotalHoursToDeduct:double", f"""
SELECT l.EmployeeID AS WorkdayID, CAST(year(l.TimeOffDate) * 100 + month(l.TimeOffDate) AS BIGINT) AS YearMonth,
       SUM(l.TC_Hours * l.Unit) AS TotalHoursToDeduct
FROM leaves l
WHERE l.TimeOffDate <= DATE '{RUN_DATE}'
  AND upper(trim(coalesce(l.TimeOffTypeforTimeOffEntry, ''))) NOT IN
      ('SICK DAY', 'EMERGENCY LEAVE', 'PHILIPPINES UNPAID TIME OFF')
  AND EXISTS (SELECT 1 FROM dim_date dd WHERE dd.DateShort = l.TimeOffDate)
GROUP BY 1, 2""", covers="D7 C15")
def planned_leave_clipped(spark, sf_dir):
    """The deduction cut at a run date in the middle of a month."""
    return targets.planned_leave_deduction(A.leaves(A.Tables(spark, sf_dir)), A.calendar(spark), as_of=RUN_DATE,
                                           calendar_rows_bound=A.CAL_ROWS)


@query("src_newest_partition", "event_type:string, event_id:bigint, y:bigint, m:bigint, d:bigint", """
SELECT event_type, event_id, year(ts) AS y, month(ts) AS m, day(ts) AS d FROM events e
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events x WHERE x.event_type = e.event_type)""", covers="S5 D5")
def src_newest_partition(spark, sf_dir):
    """Events kept in folders by type and day; the newest day of each type, found by folder names."""
    ts = F.col("ts")
    events = A.Tables(spark, sf_dir).events.select("event_id", "event_type", F.year(ts).alias("y"), F.month(ts).alias("m"), F.dayofmonth(ts).alias("d"))
    path, levels = _own(spark, "events"), ("y", "m", "d")
    # a day of one type, however large, is dealt to several files
    spread = F.pmod(F.xxhash64("event_id"), F.lit(4))
    events.repartition("event_type", *levels, spread).write.partitionBy("event_type", *levels).parquet(path)
    return read_newest(spark, path, levels, ["event_type"], schema="event_id BIGINT, event_type STRING, y INT, m INT, d INT")


@query("insert_fixed_ddl", "Code:string, Name:string, Loaded:bigint", """
SELECT Code, Name, 1 AS Loaded FROM planner_codes UNION ALL
SELECT BucketID, BucketName, 2 AS Loaded FROM buckets""", covers="K6 K10")
def insert_fixed_ddl(spark, sf_dir):
    """A table of fixed schema, filled by position from two sources with other names."""
    t = A.Tables(spark, sf_dir)
    name = f"fixed_{uuid.uuid4().hex}"
    create_table(spark, name, "Code STRING, Name STRING, Loaded BIGINT", _own(spark, "fixed"))
    insert_into(A.planner_codes(t).select("Code", "Name", F.lit(1).cast("bigint")), name)
    insert_into(A.buckets(t).select("BucketID", "BucketName", F.lit(2).cast("bigint")), name)
    return spark.table(name)


@query("empty_clone_evolve", "EmployeeID:bigint, TimeOffDate:date, Note:string", """
SELECT EmployeeID, TimeOffDate, 'kept' AS Note FROM leaves WHERE EmployeeID % 2 = 0""", covers="K9 U4")
def empty_clone_evolve(spark, sf_dir):
    """An empty clone of the leave table, filled by name with rows that have a column more."""
    leaves = A.leaves(A.Tables(spark, sf_dir)).select("EmployeeID", "TimeOffDate")
    return union_by_name_evolve(empty_like(leaves), leaves.where(F.col("EmployeeID") % 2 == 0).withColumn("Note", F.lit("kept")))


@query("audit_parameters", "UploadDate:string, UploadBy:string, WorkdayID:bigint", """
SELECT '2001-02-03 04:05:06' AS UploadDate, 'loader' AS UploadBy, WorkdayID FROM members""", covers="X25 P5")
def audit_parameters(spark, sf_dir):
    """Run time and uploader are parameters, not the clock's and the session's."""
    m = A.members(A.Tables(spark, sf_dir)).select("WorkdayID")
    return with_audit(m, "loader", dt.datetime(2001, 2, 3, 4, 5, 6)).withColumn("UploadDate", F.date_format("UploadDate", "yyyy-MM-dd HH:mm:ss"))


@query("calendar_from_scratch", "DateKey:bigint, DateShort:date, DateDayName:string, IsWeekend:bigint, n_orders:bigint", f"""
WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n FROM orders GROUP BY 1),
days AS (SELECT CAST(g AS DATE) AS d FROM (SELECT make_date(CAST(min(year(d)) AS INTEGER), 1, 1) AS lo FROM o) b,
         generate_series(b.lo, CAST(make_date(year({AS_OF}) + 2, 1, 1) - INTERVAL 1 DAY AS DATE), INTERVAL 1 DAY) t(g)
         UNION ALL SELECT DATE '1900-01-01' UNION ALL SELECT DATE '9999-12-31')
SELECT CAST(strftime(days.d, '%Y%m%d') AS BIGINT) AS DateKey, days.d AS DateShort, dayname(days.d) AS DateDayName,
       CASE WHEN dayofweek(days.d) IN (0, 6) THEN 1 ELSE 0 END AS IsWeekend, coalesce(o.n, 0) AS n_orders
FROM days LEFT JOIN o ON o.d = days.d""", covers="C1")
def calendar_from_scratch(spark, sf_dir):
    """A calendar built without a table to start from, from the first order's year; orders of each day."""
    o = A.Tables(spark, sf_dir).orders.select(F.to_date("o_orderdate").alias("DateShort"))
    first = o.agg(F.min("DateShort")).first()[0] or A.AS_OF
    cal = cal_plans.date_dimension(spark, A.AS_OF, start=dt.date(first.year, 1, 1), run_at=A.RUN_AT)
    n = o.groupBy("DateShort").agg(F.count(F.lit(1)).alias("n_orders"))
    return cal.join(n, "DateShort", "left").withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))

"""Domain inputs derived from the driver's TPC-H-style tables.

The library's real inputs (planner exports, issue workbooks, leave and member
sheets) are not part of the test data, so each is derived deterministically from
a table that grows with the scale factor:

* members        <- supplier (+ nation/region for roles)
* planner tasks  <- lineitem (return flag <> 'R') x part
* issue tasks    <- orders
* leave entries  <- lineitem (return flag = 'R') x supplier
* lookups        <- part (types -> buckets / productivity types, brands -> codes)
* calendar       <- generated for the data's years

The same derivations are written in SQL for the oracle
(``effort_analytics.queries.sql``), so both engines see identical text.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from .calendar import calendar_rows_bound, generate_calendar
from ..operators.tables import empty_like
from ..session import staged
from .refine import (refine_buckets, refine_leaves, refine_members, refine_planner_codes,
                     refine_productivity_types, unified_tasks, load_tasks)

# Run parameters of the analogue (the data spans 1995-01-01 .. 2001-11-04)
AS_OF = dt.date(2000, 12, 31)
RUN_YEAR = 2000
MIN_YEAR = 1995
CAL_START = dt.date(1995, 1, 1)
CAL_END_EXCL = dt.date(AS_OF.year + C.CALENDAR_YEARS_AHEAD, 1, 1)
CAL_ROWS = calendar_rows_bound(CAL_START, CAL_END_EXCL)
RUN_AT = dt.datetime(2001, 1, 1, 6, 0, 0)
LEADS = "Brand#1"          # plays the leads planner code
ADMIN_TYPE = "ECONOMY"     # part type that plays the 'Admin' bucket


# Declared schemas of the driver tables used here (explicit, not inferred)
SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


class Tables:
    """Lazy access to the driver tables of one scale-factor folder.

    Each table is opened once per instance, and each derived input is built
    once (``memo``), so a query plan that uses, say, the members table in four
    places refers to one analysed DataFrame instead of four copies -- this keeps
    driver-side analysis and footer reads from growing with plan size.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, stage: bool = False):
        self.spark = spark
        self.stage = stage  # keep refined members and leaves as tables, as the jobs do
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            reader = self.spark.read
            if name in SCHEMAS:  # declared schema: no footer-reading job per open
                reader = reader.schema(SCHEMAS[name])
            df = reader.parquet(f"{self.sf_dir}/{name}.parquet")
            self._cache[name] = df
        return self._cache[name]


def memo(fn):
    """Build a derived input once per :class:`Tables` instance."""
    key = f"__{fn.__name__}"

    def wrapper(t: "Tables") -> DataFrame:
        if key not in t._cache:
            t._cache[key] = fn(t)
        return t._cache[key]

    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


def _s(c) -> F.Column:
    return c.cast("string")


def _d(c) -> F.Column:
    return F.to_date(c)


# -- raw sources -------------------------------------------------------------

@memo
def raw_members(t: Tables) -> DataFrame:
    s, n = t.supplier, t.nation
    j = s.join(n, s.s_nationkey == n.n_nationkey)
    start = F.date_add(F.lit(dt.date(1995, 1, 1)), (F.col("s_suppkey") % 700).cast("int"))
    return j.select(
        F.concat(F.lit("O365-"), _s(F.col("s_suppkey"))).alias("Office365ID"),
        _s(F.col("s_suppkey")).alias("WorkdayID"),
        F.split_part(F.col("s_name"), F.lit("#"), F.lit(1)).alias("GivenName"),
        F.split_part(F.col("s_name"), F.lit("#"), F.lit(2)).alias("Surname"),
        F.col("s_name").alias("AssignedTo (Display Name in Teams)"),
        F.col("n_name").alias("JobTitle"),
        F.concat(F.lit("Manager "), _s(F.col("s_nationkey") % 5)).alias("ManagerName"),
        _s(F.col("s_nationkey")).alias("Squad"),
        _s(start).alias("StartDate"),
        F.when(F.col("s_suppkey") % 4 == 0, F.lit("1999-12-31")).otherwise(F.lit("9999-12-31")).alias("EndDate"),
    )


@memo
def raw_roles(t: Tables) -> DataFrame:
    n, r = t.nation, t.region
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_name").alias("JobTitle"), F.col("r_name").alias("Group"))


@memo
def raw_planner_tasks(t: Tables) -> DataFrame:
    l = t.lineitem.where(F.col("l_returnflag") != "R")
    p = t.part
    j = l.join(p, l.l_partkey == p.p_partkey)
    d = _d(F.col("l_shipdate"))
    q = _s(F.col("l_quantity").cast("bigint"))
    ln = F.col("l_linenumber")
    hours = (F.when(ln % 4 == 0, q).when(ln % 4 == 1, F.concat(q, F.lit(".0")))
             .when(ln % 4 == 2, F.concat(q, F.lit("."))).otherwise(F.concat(F.lit(" "), q, F.lit(" "))))
    return j.select(
        F.concat(F.lit("["), F.col("p_brand"), F.lit("] "), F.col("p_name")).alias("Title"),
        F.concat(_s(F.col("l_orderkey")), F.lit("-"), _s(ln)).alias("TaskID"),
        F.concat(F.lit("BKT-"), F.col("p_type")).alias("BucketID"),
        F.when(F.col("l_linestatus") == "F", F.lit("100")).when(ln % 2 == 1, F.lit("50"))
        .otherwise(F.lit("0")).alias("Progress"),
        F.concat(F.lit("O365-"), _s(F.col("l_suppkey"))).alias("CreatedByOffice365ID"),
        _s(F.date_sub(d, 10)).alias("CreatedDate"),
        _s(F.date_sub(d, ln)).alias("StartDate"),
        F.when(ln == 7, F.lit(None).cast("string")).otherwise(_s(d)).alias("DueDate"),
        F.when(F.col("l_linestatus") == "F", _s(F.date_add(d, 1))).otherwise(F.lit("")).alias("CompletedDate"),
        hours.alias("hours"),
    )


@memo
def raw_issues(t: Tables) -> DataFrame:
    o = t.orders
    k = F.col("o_orderkey")
    d = _d(F.col("o_orderdate"))
    status = (F.when(k % 13 == 0, F.lit("In Review")).when(k % 17 == 0, F.lit("Blocked"))
              .when(F.col("o_orderstatus") == "F", F.lit("Done"))
              .when(F.col("o_orderstatus") == "O", F.lit("In Progress")).otherwise(F.lit("To Do")))
    resolved = F.when(F.col("o_orderstatus") == "F",
                      F.when(k % 11 == 0, F.lit(" ")).otherwise(_s(F.date_add(d, 5))))
    spent = F.when(k % 19 == 0, F.lit("n/a")).otherwise(_s(F.floor("o_totalprice").cast("bigint") % 100000))
    project = (F.when(k % 23 == 0, F.lit(None).cast("string"))
               .when(k % 9 == 0, F.concat(F.lit("Generated "), F.col("o_orderpriority")))
               .otherwise(F.concat(F.lit("Project "), F.col("o_orderpriority"))))
    return o.select(
        F.concat(F.lit("Order "), _s(k), F.lit(" "), F.col("o_orderpriority")).alias("Summary"),
        F.concat(F.lit("ISS-"), _s(k)).alias("IssueKey"),
        status.alias("Status"),
        _s(d).alias("Created"),
        resolved.alias("Resolved"),
        spent.alias("TimeSpent"),
        F.concat(F.lit("Supplier#"), F.lpad(_s(F.col("o_custkey") % 100), 9, "0")).alias("Assignee"),
        project.alias("Projectname"),
    )


@memo
def raw_leaves(t: Tables) -> DataFrame:
    l = t.lineitem.where(F.col("l_returnflag") == "R")
    s = t.supplier
    j = l.join(s, l.l_suppkey == s.s_suppkey)
    ln = F.col("l_linenumber")
    label = F.concat(F.col("s_name"), F.lit(" ("), _s(F.col("s_suppkey")), F.lit(")"))
    leave_type = (F.when(ln == 1, F.lit("SICK DAY")).when(ln == 2, F.lit("Business Unit Holiday"))
                  .when(ln == 3, F.lit(" sick day ")).when(ln == 4, F.lit("Emergency Leave"))
                  .otherwise(F.lit("Vacation")))
    units = (F.when(F.col("l_orderkey") % 10 == 0, F.lit("-1")).when(ln % 2 == 0, F.lit("0.5"))
             .otherwise(F.lit("1")))
    return j.select(
        _s(_d(F.col("l_shipdate"))).alias("TimeOffDate"),
        F.when(ln == 6, F.concat(label, F.lit(" (On Leave)"))).otherwise(label).alias("Worker"),
        F.concat(F.lit("Absence "), _s(ln)).alias("TimeOffAbsenceTable"),
        leave_type.alias("Type"),
        units.alias("Approved"),
        F.lit("Days").alias("UnitofTime"),
    )


@memo
def raw_buckets(t: Tables) -> DataFrame:
    ty = t.part.select("p_type").distinct()
    return ty.select(
        F.when(F.col("p_type") == ADMIN_TYPE, F.lit(C.ADMIN_CATEGORY)).otherwise(F.col("p_type")).alias("Bucket Name"),
        F.concat(F.lit("BKT-"), F.col("p_type")).alias("Bucket ID"),
        F.concat(F.lit("Planner "), F.col("p_type")).alias("Source Planner"),
    )


@memo
def raw_planner_codes(t: Tables) -> DataFrame:
    b = t.part.select("p_brand").distinct()
    b = b.where(F.split_part(F.col("p_brand"), F.lit("#"), F.lit(2)).try_cast("int") % 3 != 0)
    return b.select(F.concat(F.lit("["), F.col("p_brand"), F.lit("]")).alias("Code"),
                    F.concat(F.lit("Code "), F.col("p_brand")).alias("Name"))


@memo
def raw_productivity_types(t: Tables) -> DataFrame:
    ty = t.part.select("p_type").distinct()
    buckets = ty.select(
        F.when(F.col("p_type") == ADMIN_TYPE, F.lit(C.ADMIN_CATEGORY)).otherwise(F.col("p_type")).alias("Category"),
        F.when(F.col("p_type") == ADMIN_TYPE, F.lit("Mixed"))
        .when(F.col("p_type").isin("STANDARD", "MEDIUM", "LARGE"), F.lit(C.PRODUCTIVE))
        .otherwise(F.lit(C.NONPRODUCTIVE)).alias("Type"))
    entered = leaves(t).select(F.col("TimeOffTypeforTimeOffEntry").alias("Category"))
    leave_types = entered.where(F.col("Category").isNotNull()).distinct().select("Category", F.lit("Leave").alias("Type"))
    return buckets.unionByName(leave_types).withColumn("Unnamed: 4", F.lit(None).cast("string"))


# -- refined tables ------------------------------------------------------------

@memo
def members(t: Tables) -> DataFrame:
    out = refine_members(raw_members(t), raw_roles(t), at=RUN_AT)
    return staged(out, "members") if t.stage else out


@memo
def leaves(t: Tables) -> DataFrame:
    out = refine_leaves(raw_leaves(t), at=RUN_AT)
    return staged(out, "leaves") if t.stage else out


@memo
def buckets(t: Tables) -> DataFrame:
    return refine_buckets(raw_buckets(t), at=RUN_AT)


@memo
def planner_codes(t: Tables) -> DataFrame:
    return refine_planner_codes(raw_planner_codes(t), at=RUN_AT)


@memo
def productivity_types(t: Tables) -> DataFrame:
    return refine_productivity_types(raw_productivity_types(t), at=RUN_AT)


@memo
def incoming_tasks(t: Tables) -> DataFrame:
    return unified_tasks(raw_planner_tasks(t), raw_issues(t), members(t), at=RUN_AT)


@memo
def tasks(t: Tables) -> DataFrame:
    """The refined task table: the unified load upserted into an empty table."""
    incoming = incoming_tasks(t)
    return load_tasks(empty_like(incoming), incoming)


def calendar(spark: SparkSession) -> DataFrame:
    return generate_calendar(spark, CAL_START, CAL_END_EXCL, run_at=RUN_AT)

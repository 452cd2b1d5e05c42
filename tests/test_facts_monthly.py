"""Task-and-leave facts: sums by member and month, lookups beyond a broadcast, tasks worked out once."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from effort_analytics.plans import facts
from effort_analytics.plans.calendar import generate_calendar

KEYS = ["DateYearMonthKey", "DateYear", "DateMonthName", "AssignedTo", "WorkdayID", "Squad", "ManagerName", "FinalTargetHours"]
DAY = dt.date(2021, 3, 4)


def _inputs(spark):
    members = spark.createDataFrame(  # member 4 has no attributes
        [("o1", 1, "Ann", "Dev", "S1", "Boss"), ("o2", 2, "Bob", "Dev", "S1", "Boss"), ("o4", 4, None, None, None, None)],
        "Office365ID string, WorkdayID bigint, AssignedTo string, RoleGroup string, Squad string, ManagerName string")
    tasks = [(f"T{i}", "X" if i % 2 else "LEADS", f"B{i % 3}", 100, f"o{i % 5}", dt.date(2020, 11, 1) + dt.timedelta(days=7 * i), Decimal(i))
             for i in range(60)]
    tasks += [(None, "X", "B1", 100, "o1", DAY, Decimal(3)), (None, "X", "B1", 100, "o1", DAY, Decimal(3)), ("", "X", "B1", 100, "o1", DAY, Decimal(3)),
              ("U1", "X", None, 100, "o2", DAY, None), ("U2", "X", "B1", 50, "o1", DAY, Decimal(9)), ("U3", "X", "B1", 100, None, None, Decimal(9))]
    tasks = spark.createDataFrame(tasks, "TaskID string, TC_PlannerCode string, BucketID string, Progress bigint, CreatedByOffice365ID string, "
                                         "TC_ProductiveDate date, Hours decimal(10,2)").withColumn("Title", F.lit("t"))
    leaves = spark.createDataFrame(
        [(1, DAY, "Vacation", Decimal(1)), (1, DAY, "Vacation", Decimal(1)), (2, DAY, "Vacation", None), (4, DAY, "Sick", Decimal(2)),
         (1, DAY, None, Decimal(1)), (None, DAY, "Sick", Decimal(1)), (1, dt.date(2050, 1, 3), "Sick", Decimal(1))],
        "EmployeeID bigint, TimeOffDate date, TimeOffTypeforTimeOffEntry string, Unit decimal(10,2)"
    ).withColumn("TC_Hours", F.lit(Decimal("7.5")).cast("decimal(10,2)"))
    buckets = spark.createDataFrame([("B1", "Admin"), ("B2", "Dev")], "BucketID string, BucketName string")
    types = spark.createDataFrame([("Admin", "Mixed"), ("Vacation", "Leave")], "Category string, Type string")
    expected = spark.createDataFrame([(1, 202103, Decimal(100)), (2, 202103, Decimal(50))], "WorkdayID bigint, YearMonth bigint, TargetHours decimal(20,1)")
    planned = spark.createDataFrame([(1, 202103, Decimal("7.5"))], "WorkdayID bigint, YearMonth bigint, TotalHoursToDeduct decimal(31,4)")
    cal = generate_calendar(spark, dt.date(2020, 1, 1), dt.date(2022, 1, 1))
    return tasks, leaves, members, buckets, cal, types, expected, planned


def _got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _sums(df):
    return _got(df.groupBy(*KEYS).agg(F.sum("Hours").cast("decimal(31,4)").alias("TotalHours")))


def _plain(tasks, leaves, members, buckets, cal, types, expected, planned):
    rows = facts.task_leave_rows(tasks, leaves, members, buckets, cal, tasks_unique=True)
    return facts.publish_task_leave_fact(rows, cal, types, expected, planned, min_year=2020)


@pytest.mark.parametrize("fits", [True, False])
def test_monthly_sums_equal_those_of_the_plain_fact(spark, monkeypatch, fits):
    given = _inputs(spark)
    plain = _plain(*given)
    want, sums = _got(plain), _sums(plain)
    measure = facts.measure_lookups
    if not fits:  # as if the members took terabytes: the narrow form still runs
        monkeypatch.setattr(facts, "measure_lookups", lambda **t: {k: replace(v, bytes=1 << 40) for k, v in measure(**t).items()})
    monkeypatch.setattr(facts, "publish_task_leave_fact", lambda *a, **k: pytest.fail("plain form"))
    fact = facts.task_and_leave_fact(*given, min_year=2020, tasks_unique=True)
    assert fact.columns == plain.columns and _got(fact) == want
    monthly = facts.task_and_leave_fact(*given, min_year=2020, tasks_unique=True, monthly=True)
    assert monthly.columns == facts.TASK_LEAVE_MONTH_COLUMNS and _sums(monthly) == sums
    assert monthly.count() < fact.count()


def test_monthly_of_members_listed_twice(spark):
    tasks, leaves, members, *rest = _inputs(spark)
    given = (tasks, leaves, members.unionByName(members.where("WorkdayID = 1").withColumn("Squad", F.lit("other"))), *rest)
    monthly = facts.task_and_leave_fact(*given, min_year=2020, tasks_unique=True, monthly=True)
    assert monthly.columns == facts.TASK_LEAVE_MONTH_COLUMNS and _sums(monthly) == _sums(_plain(*given))


def test_tasks_are_worked_out_once(spark):
    """The fact of named and of unnamed tasks comes from one pass over the task table."""
    tasks, *rest = _inputs(spark)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    given = tasks.mapInArrow(count, tasks.schema)
    facts.task_and_leave_fact(given, *rest, min_year=2020, tasks_unique=True).count()
    assert seen.value == tasks.count()

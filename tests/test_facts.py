"""Published facts: duplicate leave rows, code check flag, productivity classes."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from effort_analytics.plans import facts as Fx
from effort_analytics.plans.calendar import generate_calendar


def _inputs(spark):
    members = spark.createDataFrame(
        [("o1", 1, "Ann", "Dev", "S1", "Boss")],
        "Office365ID string, WorkdayID bigint, AssignedTo string, RoleGroup string, Squad string, ManagerName string")
    tasks = spark.createDataFrame(
        [("T1", "[LEADS] a", "LEADS", "B1", 100, "o1", dt.date(2021, 3, 1), Decimal("2.00")),
         ("T2", "[X] b", "X", "B1", 100, "o1", dt.date(2021, 3, 2), Decimal("3.00")),
         ("T3", "c", "c", "B2", 50, "o1", dt.date(2021, 3, 3), Decimal("4.00"))],
        "TaskID string, Title string, TC_PlannerCode string, BucketID string, Progress bigint, "
        "CreatedByOffice365ID string, TC_ProductiveDate date, Hours decimal(10,2)")
    leaves = spark.createDataFrame(
        [(1, dt.date(2021, 3, 4), "Vacation", Decimal("1.00")), (1, dt.date(2021, 3, 4), "Vacation", Decimal("1.00")),
         (1, dt.date(2021, 3, 5), "Business Unit Holiday", Decimal("1.00"))],
        "EmployeeID bigint, TimeOffDate date, TimeOffTypeforTimeOffEntry string, Unit decimal(10,2)"
    ).withColumn("TC_Hours", F.lit(Decimal("7.5")).cast("decimal(10,2)"))
    buckets = spark.createDataFrame([("B1", "Admin"), ("B2", "Dev")], "BucketID string, BucketName string")
    types = spark.createDataFrame([("Admin", "Mixed"), ("Vacation", "Leave")], "Category string, Type string")
    codes = spark.createDataFrame([("[LEADS]", "Leads")], "Code string, Name string")
    cal = generate_calendar(spark, dt.date(2021, 1, 1), dt.date(2022, 1, 1))
    return members, tasks, leaves, buckets, types, codes, cal


def test_task_leave_fact_collapses_identical_leave_rows(spark):
    members, tasks, leaves, buckets, types, _, cal = _inputs(spark)
    rows = Fx.task_leave_rows(tasks, leaves, members, buckets, cal)
    empty = spark.createDataFrame([], "WorkdayID bigint, YearMonth bigint, TargetHours decimal(20,1)")
    none = spark.createDataFrame([], "WorkdayID bigint, YearMonth bigint, TotalHoursToDeduct decimal(31,4)")
    fact = Fx.publish_task_leave_fact(rows, cal, types, empty, none, min_year=2021)
    got = sorted((r.Category, r.PlannerCode, float(r.Hours), r.ProductivityType) for r in fact.collect())
    # completed tasks only; two identical vacation rows become one; holiday type left out
    assert got == [("Admin", "LEADS", 2.0, "Productive"), ("Admin", "X", 3.0, "Nonproductive"),
                   ("Vacation", "Vacation", 7.5, "Leave")]
    kept = Fx.publish_task_leave_fact(rows, cal, types, empty, none, min_year=2021, keep_duplicates=True)
    assert kept.where(F.col("Category") == "Vacation").count() == 2
    assert all(r.TotalHoursToDeduct == 0 and r.FinalTargetHours is None for r in fact.collect())


def test_rows_leave_out_repeated_tasks_and_leaves_off_the_calendar(spark):
    members, tasks, leaves, buckets, _, _, cal = _inputs(spark)
    off = leaves.limit(1).withColumn("TimeOffDate", F.lit(dt.date(2050, 1, 3)))
    rows = Fx.task_leave_rows(tasks.union(tasks), leaves.union(off), members, buckets, cal)
    got = sorted((r.TaskID, r.Date) for r in rows.collect())
    day = dt.date(2021, 3, 4)  # two equal leave entries stay two rows here
    assert got == [("", day), ("", day), ("T1", dt.date(2021, 3, 1)), ("T2", dt.date(2021, 3, 2))]


def test_task_fact_flags_unknown_codes(spark):
    members, tasks, _, buckets, types, codes, cal = _inputs(spark)
    fact = Fx.publish_task_fact(tasks, members, cal, buckets, codes, types, min_year=2021)
    got = sorted((r.PlannerCode, r.PlannerCodeKey, r.IsPlannerCodeCorrect, r.ProductivityType) for r in fact.collect())
    assert got == [("LEADS", "[LEADS]", "Yes", "Productive"), ("X", None, "No", "Nonproductive")]

"""A key holding a third of all rows: results stay whole and exact, and the
plans reduce the hot key map-side (partial aggregates) instead of gathering
the group in one task."""

from pyspark.sql import functions as F

from effort_analytics.operators import dedup_latest, dedup_latest_window, latest_snapshot


def _skewed(spark, n=30000):
    # key 0 holds a third of the rows; the rest are spread
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("k"),
        (F.col("id") % 101).alias("o"), F.col("id").alias("v"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_with_hot_key_is_exact_and_partial(spark):
    df = _skewed(spark)
    a = dedup_latest(df, ["k"], ["o"])
    b = dedup_latest_window(df, ["k"], [F.col("o").desc(), F.col("v").desc()])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert a.where("k = 0").first().o == 100
    plan = _plan(a)
    assert "partial_max" in plan and "Window" not in plan


def test_latest_snapshot_with_hot_source(spark):
    df = _skewed(spark).select(
        F.when(F.col("k") == 0, "hot").otherwise("cold").alias("src"),
        (F.col("v") % 3 + 2022).cast("string").alias("y"), (F.col("v") % 12 + 1).cast("string").alias("m"),
        F.lit("1").alias("d"), F.lit("0000").alias("hm"), "v")
    out = latest_snapshot(df, by=["src"])
    from pyspark.sql import Window
    w = Window.partitionBy("src").orderBy(*[F.col(c).cast("int").desc() for c in ("y", "m", "d", "hm")])
    expected = df.withColumn("r", F.rank().over(w)).where("r = 1").drop("r")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, expected.collect()))
    assert out.where("src = 'hot'").count() > 0
    plan = _plan(out)
    assert "partial_max" in plan and "Window" not in plan


def test_group_sums_with_hot_member_are_partial(spark):
    from effort_analytics.plans.targets import flag_under_target
    df = _skewed(spark).select(
        F.lit("202001").alias("DateYearMonthKey"), F.lit(2020).alias("DateYear"), F.lit("January").alias("DateMonthName"),
        F.col("k").cast("string").alias("AssignedTo"), F.col("k").alias("WorkdayID"), F.lit("s").alias("Squad"),
        F.lit("m").alias("ManagerName"), F.lit(1).cast("decimal(10,2)").alias("Hours"),
        F.lit(20000).cast("decimal(10,2)").alias("FinalTargetHours"))
    out = flag_under_target(df, 2020)
    rows = {r.WorkdayID: float(r.TotalHours) for r in out.collect()}
    assert rows[0] == 10000.0 and len(rows) == 998
    assert "partial_sum" in _plan(out)

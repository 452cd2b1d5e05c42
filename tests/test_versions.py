"""Tables published in one step: keyed upserts, whole rewrites, cleaning, failures on the way."""

import os

import pytest
from pyspark.sql import functions as F

from effort_analytics.operators import upsert
from effort_analytics.sources import keyed, read_keyed, register_keyed, replace_table, upsert_keyed, versions
from effort_analytics.sources.sinks import with_key_bucket


def _rows(spark, n=200, step=1):
    return spark.range(0, n, step).select(F.col("id").cast("string").alias("TaskID"), F.col("id").alias("Hours"))


def _got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upsert_keyed_equals_upsert(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    assert upsert_keyed(_rows(spark), path, ["TaskID"], buckets=16) == 1
    source = spark.createDataFrame([("5", 500), ("7", 700), ("new", 1)], "TaskID string, Hours bigint")
    want = _got(upsert(_rows(spark), source, ["TaskID"]))
    assert upsert_keyed(source, path, "TaskID", buckets=16) == 2
    assert _got(read_keyed(spark, path)) == want
    assert upsert_keyed(source, path, "TaskID", buckets=16) == 3 and _got(read_keyed(spark, path)) == want
    assert upsert_keyed(source.limit(0), path, "TaskID", buckets=16) is None


def test_only_touched_buckets_are_written_and_read(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    upsert_keyed(_rows(spark), path, ["TaskID"], buckets=16)
    one = spark.createDataFrame([("5", 500)], "TaskID string, Hours bigint")
    upsert_keyed(one, path, ["TaskID"], buckets=16)
    bucket = with_key_bucket(one, ["TaskID"], 16).first().key_bucket
    parts = versions.current(spark, path)[1]["parts"]
    assert sorted(len(p["buckets"]) for p in parts.values()) == [1, 15]
    files = read_keyed(spark, path, [bucket]).inputFiles()
    assert files and all(f"key_bucket={bucket}/" in f for f in files)


def test_failed_write_leaves_the_table(spark, tmpdir_path, monkeypatch):
    """A write that dies after some of its buckets, and one that dies before it is published."""
    path = os.path.join(tmpdir_path, "t")
    upsert_keyed(_rows(spark), path, ["TaskID"], buckets=8)
    before = _got(read_keyed(spark, path))
    new = _rows(spark).withColumn("Hours", F.lit(-1).cast("bigint"))
    # some buckets of a write are there, the others never come
    half = with_key_bucket(new, ["TaskID"], 8).where("key_bucket < 4")
    half.write.partitionBy("key_bucket").parquet(f"{path}/part=dead")
    assert _got(read_keyed(spark, path)) == before

    # the place of one bucket is blocked, so its task fails while others have been written
    monkeypatch.setattr(keyed.uuid, "uuid4", lambda: type("U", (), {"hex": "blocked"})())
    os.makedirs(f"{path}/part=blocked")
    with pytest.raises(Exception):
        upsert_keyed(new, path, ["TaskID"], buckets=8)
    monkeypatch.undo()
    assert _got(read_keyed(spark, path)) == before and versions.numbers(spark, path) == [1]

    def dies(*_):
        raise OSError("lost")
    monkeypatch.setattr(keyed.versions, "commit", dies)
    with pytest.raises(OSError, match="lost"):
        upsert_keyed(new, path, ["TaskID"], buckets=8)
    monkeypatch.undo()
    assert _got(read_keyed(spark, path)) == before
    upsert_keyed(new, path, ["TaskID"], buckets=8)  # and again
    assert {r[1] for r in _got(read_keyed(spark, path))} == {-1}


def test_two_writers(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    versions.commit(spark, path, {"folder": "v=a"}, 0)
    with pytest.raises(versions.ConcurrentWrite):
        versions.commit(spark, path, {"folder": "v=b"}, 0)
    assert versions.current(spark, path) == (1, {"folder": "v=a"})


def test_layout_keys_and_columns(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    rows = _rows(spark, 100).withColumn("TaskID", F.when(F.col("Hours") < 50, F.col("TaskID")))
    upsert_keyed(rows, path, ["TaskID"], buckets=8)
    with pytest.raises(ValueError, match="is stored with"):
        upsert_keyed(rows, path, ["TaskID"], buckets=4)
    with pytest.raises(ValueError, match="2 source rows for key"):
        upsert_keyed(rows.where("Hours = 7").union(rows.where("Hours = 7")), path, ["TaskID"], buckets=8)
    new = spark.createDataFrame([("7", 700, "x"), (None, 1, "y")], "TaskID string, Hours bigint, Note string")
    upsert_keyed(new, path, ["TaskID"], buckets=8)
    after = read_keyed(spark, path)
    assert after.columns == ["TaskID", "Hours", "Note"] and after.count() == 101 and after.where("TaskID IS NULL").count() == 51
    assert [tuple(r) for r in after.where("TaskID = '7'").collect()] == [("7", 700, "x")]
    upsert_keyed(spark.createDataFrame([("8", 800)], "TaskID string, Hours bigint"), path, ["TaskID"], buckets=8)
    assert read_keyed(spark, path).count() == 101 and read_keyed(spark, path).where("Note IS NOT NULL").count() == 2


def test_view_follows_the_versions(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    upsert_keyed(_rows(spark, 50), path, ["TaskID"], buckets=8)
    register_keyed(spark, "ea_versions_db", "t", path)
    assert spark.table("ea_versions_db.t").count() == 50
    upsert_keyed(spark.createDataFrame([("1", -1, "n")], "TaskID string, Hours bigint, Note string"), path, ["TaskID"], buckets=8)
    register_keyed(spark, "ea_versions_db", "t", path)
    assert _got(spark.table("ea_versions_db.t")) == _got(read_keyed(spark, path))
    spark.range(1).write.mode("overwrite").option("path", os.path.join(tmpdir_path, "x")).saveAsTable("ea_versions_db.x")
    with pytest.raises(ValueError, match="left alone"):
        register_keyed(spark, "ea_versions_db", "x", path)
    spark.sql("DROP TABLE ea_versions_db.x")
    spark.sql("DROP VIEW ea_versions_db.t")


def test_clean_keeps_what_versions_need(spark, tmpdir_path):
    base = os.path.join(tmpdir_path, "w")
    for n in (1, 2, 3):
        replace_table(spark.range(n), base)
    assert versions.read_current(spark, base).count() == 3
    assert len(versions.clean(spark, base, keep=1)) == 2 and versions.numbers(spark, base) == [3]
    assert versions.read_current(spark, base).count() == 3
    with pytest.raises(ValueError):
        versions.clean(spark, base, keep=0)

    path = os.path.join(tmpdir_path, "k")
    upsert_keyed(_rows(spark), path, ["TaskID"], buckets=4)
    for i in range(3):
        upsert_keyed(spark.createDataFrame([(str(i), -i)], "TaskID string, Hours bigint"), path, ["TaskID"], buckets=4)
    before = _got(read_keyed(spark, path))
    versions.clean(spark, path, keep=1)
    assert _got(read_keyed(spark, path)) == before
    assert {d for d in os.listdir(path) if d.startswith("part=")} == set(versions.current(spark, path)[1]["parts"])


def test_calendar_job_keeps_flags_without_a_catalogue(spark, tmpdir_path):
    import datetime as dt

    from effort_analytics.config import TableSpec
    from effort_analytics.plans import jobs
    spec = TableSpec("dim_date", (), os.path.join(tmpdir_path, "dim_date"))
    jobs.refine_date_job(spark, spec, as_of=dt.date(2024, 1, 1))
    flagged = jobs.read_refined(spark, spec).withColumn("IsHoliday_USA", F.when(F.col("DateMonthNum") == 12, 1).otherwise(0))
    replace_table(flagged, spec.output_path)
    n = jobs.read_refined(spark, spec).where("IsHoliday_USA = 1").count()
    jobs.refine_date_job(spark, spec, as_of=dt.date(2024, 6, 1))
    assert n > 0 and jobs.read_refined(spark, spec).where("IsHoliday_USA = 1").count() == n


def test_stream_batches_once(spark, tmpdir_path):
    from effort_analytics.streaming import upsert_keyed_each_batch
    path = os.path.join(tmpdir_path, "s")
    run = upsert_keyed_each_batch(path, ["TaskID"], ["ts"], stream="planner", buckets=4)
    batch = spark.createDataFrame([("1", 2, 20), ("1", 3, 30), ("2", 5, 5), (None, 9, 9)], "TaskID string, v int, ts int")
    run(batch, 0)
    first = _got(read_keyed(spark, path))
    run(batch, 0)  # replayed: the row without a key isn't inserted again
    assert _got(read_keyed(spark, path)) == first and len(first) == 3
    run(spark.createDataFrame([("2", 6, 6)], "TaskID string, v int, ts int"), 1)
    assert [r.v for r in read_keyed(spark, path).where("TaskID = '2'").collect()] == [6]

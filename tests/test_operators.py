"""Table operators: upsert, dedup, snapshot, schema-evolving union."""

import random

from pyspark.sql import functions as F

from effort_analytics.operators import (dedup_latest, dedup_latest_window, duplicate_keys, empty_like,
                                        latest_path_string_max, latest_snapshot, union_by_name_evolve,
                                        upsert)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _model_upsert(target, source):
    """Row-by-row MERGE model: matched -> replaced, unmatched -> inserted, NULL never matches."""
    src_keys = {k for k, _ in source if k is not None}
    out = [r for r in target if r[0] is None or r[0] not in src_keys]
    return sorted(out + list(source), key=repr)


def test_upsert_matches_row_model(spark):
    target = [(1, "a"), (2, "b"), (None, "n1")]
    source = [(2, "B"), (3, "C"), (None, "n2")]
    schema = "k int, v string"
    got = upsert(spark.createDataFrame(target, schema), spark.createDataFrame(source, schema), ["k"])
    assert sorted(map(tuple, got.collect()), key=repr) == _model_upsert(target, source)


def test_upsert_twice_equals_once_for_non_null_keys(spark):
    rnd = random.Random(7)
    for _ in range(3):
        target = [(k, f"t{k}") for k in rnd.sample(range(30), 12)]
        source = [(k, f"s{k}") for k in rnd.sample(range(30), 8)]
        t = spark.createDataFrame(target, "k int, v string")
        s = spark.createDataFrame(source, "k int, v string")
        once = upsert(t, s, "k")
        twice = upsert(once, s, "k")
        assert _rows(once) == _rows(twice) == sorted(_model_upsert(target, source), key=repr)


def test_dedup_latest_picks_greatest_and_is_total(spark):
    rows = [(1, 5, "x"), (1, 9, "a"), (1, 9, "b"), (2, None, "z"), (2, 1, "y"), (None, 3, "n"), (None, 4, "m")]
    df = spark.createDataFrame(rows, "k int, o int, v string")
    got = _rows(dedup_latest(df, ["k"], ["o"]))
    assert got == sorted([(1, 9, "b"), (2, 1, "y"), (None, 4, "m")], key=repr)
    kept = dedup_latest(df, ["k"], ["o"], keep_null_keys=True)
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(
        [(1, 9, "b"), (2, 1, "y"), (None, 3, "n"), (None, 4, "m")], key=repr)
    assert duplicate_keys(dedup_latest(df, ["k"], ["o"]), ["k"]).count() == 0


def test_dedup_struct_equals_window(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 20), rnd.randint(0, 5), rnd.choice("abcd")) for _ in range(300)]
    df = spark.createDataFrame(rows, "k int, o int, v string")
    a = dedup_latest(df, ["k"], ["o"])
    b = dedup_latest_window(df, ["k"], [F.col("o").desc_nulls_last(), F.col("v").desc_nulls_last()])
    assert _rows(a) == _rows(b)


def test_latest_snapshot_numeric_vs_text(spark):
    rows = [("s1", "2024", "9", "30", "2359", 1), ("s1", "2024", "10", "1", "0000", 2),
            ("s1", "2024", "10", "1", "0000", 3), ("s2", "2023", "12", "31", "0100", 4)]
    df = spark.createDataFrame(rows, "src string, y string, m string, d string, hm string, id int")
    got = sorted(r.id for r in latest_snapshot(df, by=["src"]).collect())
    assert got == [2, 3, 4]          # October beats September when compared as numbers
    text_rule = latest_path_string_max(df.where("src = 's1'"))
    assert [r.id for r in text_rule.collect()] == [1]   # the notebooks' text maximum picks '9'


def test_union_by_name_evolve_and_empty_like(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("y", 2, 3.5)], "v string, k int, extra double")
    u = union_by_name_evolve(a, b)
    assert u.columns == ["k", "v", "extra"]
    assert sorted(map(tuple, u.collect()), key=repr) == sorted([(1, "x", None), (2, "y", 3.5)], key=repr)
    e = empty_like(u)
    assert e.schema == u.schema and e.count() == 0

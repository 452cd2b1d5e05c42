"""Round trips for sources and sinks, each in its own fresh folder."""

import json
import os

from pyspark.sql import functions as F

from effort_analytics.config import load_table_specs
from effort_analytics.operators import upsert
from effort_analytics.sources import (append_load, export_single_csv, read_csv_tagged, read_evolving,
                                      read_json, read_workbooks, register_table, replace_table,
                                      string_schema)
from effort_analytics.sources.xlsx import write_workbook


def test_csv_folder_tagged_with_file_name(spark, tmpdir_path):
    for name, rows in (("a.csv", [("Ann", "Lee"), ("Bo", "Kim")]), ("b.csv", [("Ann", "Lee")])):
        with open(os.path.join(tmpdir_path, name), "w") as fh:
            fh.write("GivenName,Surname\n" + "".join(f"{g},{s}\n" for g, s in rows))
    df = read_csv_tagged(spark, tmpdir_path, string_schema(["GivenName", "Surname"]))
    got = sorted((r.GivenName, r.FileName) for r in df.collect())
    assert got == [("Ann", "a.csv"), ("Ann", "b.csv"), ("Bo", "a.csv")]


def test_json_folder_with_declared_schema(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "t.json"), "w") as fh:
        fh.write(json.dumps({"TaskID": "1", "hours": "7.5", "extra": 1}) + "\n")
        fh.write(json.dumps({"TaskID": "2"}) + "\n")
    df = read_json(spark, tmpdir_path, "TaskID string, hours string")
    assert sorted(map(tuple, df.collect()), key=repr) == [("1", "7.5"), ("2", None)]


def test_workbook_sheet_from_every_file(spark, tmpdir_path):
    write_workbook(os.path.join(tmpdir_path, "one.xlsx"), {
        "Other": [["x"], [1]],
        "Buckets": [["Bucket Name", "Bucket ID", "Source Planner"], ["Admin", "B1", "P"], ["Dev", "B2", None]]})
    write_workbook(os.path.join(tmpdir_path, "two.xlsx"), {
        "Buckets": [["Bucket ID", "Bucket Name"], ["B3", "Ops"], [None, None], [7, "Num"]]})
    df = read_workbooks(spark, tmpdir_path, "Buckets", ["Bucket Name", "Bucket ID", "Source Planner"],
                        file_column="File")
    got = sorted(tuple(r) for r in df.collect())
    assert got == sorted([("Admin", "B1", "P", "one.xlsx"), ("Dev", "B2", None, "one.xlsx"),
                          ("Ops", "B3", None, "two.xlsx"), ("Num", "7", None, "two.xlsx")], key=repr)


def test_single_csv_export(spark, tmpdir_path):
    df = spark.createDataFrame([("Ann Lee",), ("Bo Kim",)], "FullName string").repartition(3)
    target = os.path.join(tmpdir_path, "result_2024-01-01.csv")
    export_single_csv(df, target)
    assert os.path.isfile(target)
    lines = open(target).read().splitlines()
    assert lines[0] == "FullName" and sorted(lines[1:]) == ["Ann Lee", "Bo Kim"]
    assert [p for p in os.listdir(tmpdir_path) if "staging" in p] == []


def test_replace_table_allows_upsert_of_itself(spark, tmpdir_path):
    db = "ea_test_db"
    base = os.path.join(tmpdir_path, "tasks")
    first = spark.createDataFrame([("1", 1), ("2", 2)], "TaskID string, Hours int")
    v1 = replace_table(first, base)
    register_table(spark, db, "tasks", v1)
    current = spark.table(f"{db}.tasks")
    src = spark.createDataFrame([("2", 20), ("3", 30)], "TaskID string, Hours int")
    replace_table(upsert(current, src, ["TaskID"]), base, f"{db}.tasks")
    got = sorted(map(tuple, spark.table(f"{db}.tasks").collect()))
    assert got == [("1", 1), ("2", 20), ("3", 30)]
    spark.sql(f"DROP TABLE {db}.tasks")


def test_append_load_is_idempotent_and_schema_evolves(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "leaves")
    a = spark.createDataFrame([(1, 7.5)], "EmployeeID bigint, Hours double")
    append_load(a, path, "load1")
    append_load(a, path, "load1")                       # rerun of the same load
    b = spark.createDataFrame([(2, 3.0, "Days")], "EmployeeID bigint, Hours double, UnitofTime string")
    append_load(b, path, "load2")
    df = read_evolving(spark, path)
    assert df.count() == 2
    assert sorted((r.EmployeeID, r.UnitofTime) for r in df.collect()) == [(1, None), (2, "Days")]


def test_table_specs_from_config(tmpdir_path):
    cfg = os.path.join(tmpdir_path, "config.json")
    with open(cfg, "w") as fh:
        json.dump({"refined_tables": {"tasks": {"script_name": "x", "isJobEnabled": True,
                                                "src_path": ["a/", "b/"], "output_path": "out/",
                                                "dbx_db_name": "db", "dbx_tbl_name": "tasks"},
                                      "buckets": {"isJobEnabled": False, "src_path": "c/", "output_path": "o/",
                                                  "dbx_db_name": "db", "dbx_tbl_name": "buckets"}}}, fh)
    specs = load_table_specs(cfg)
    assert specs["tasks"].src_paths == ("a/", "b/") and specs["tasks"].qualified_name == "db.tasks"
    assert specs["buckets"].enabled is False and specs["buckets"].src_paths == ("c/",)


def test_upsert_partitions_refuses_another_layout_and_repeated_keys(spark, tmpdir_path):
    import pytest
    from effort_analytics.sources import upsert_partitions
    path = os.path.join(tmpdir_path, "tasks")
    rows = spark.range(200).select(F.col("id").cast("string").alias("TaskID"), F.col("id").alias("Hours"))
    upsert_partitions(rows, path, ["TaskID"], buckets=64)
    one = spark.createDataFrame([("5", 500)], "TaskID string, Hours bigint")
    with pytest.raises(ValueError, match="is stored with"):
        upsert_partitions(one, path, ["TaskID"], buckets=16)
    with pytest.raises(ValueError, match="2 source rows for key"):
        upsert_partitions(one.union(one), path, ["TaskID"], buckets=64)
    upsert_partitions(one.limit(0), path, ["TaskID"], buckets=64)
    assert spark.read.parquet(path).count() == 200
    with pytest.raises(ValueError, match="its bucket count is unknown"):
        other = os.path.join(tmpdir_path, "other")
        rows.withColumn("key_bucket", F.lit(1)).write.partitionBy("key_bucket").parquet(other)
        upsert_partitions(one, other, ["TaskID"])


def test_upsert_partitions_reads_only_touched_buckets(spark, tmpdir_path):
    from effort_analytics.sources import read_key_buckets, upsert_partitions
    path = os.path.join(tmpdir_path, "tasks")
    rows = spark.range(300).select(F.col("id").cast("string").alias("TaskID"), F.col("id").alias("Hours"))
    upsert_partitions(rows, path, ["TaskID"], buckets=16)
    some = read_key_buckets(spark, path, [3, 5])
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [key_bucket#" in plan and "IN (3,5)" in plan
    assert len(some.inputFiles()) == 16 and 0 < some.count() < 300  # listed, then pruned


def test_upsert_partitions_spreads_null_keys_and_adds_columns(spark, tmpdir_path):
    from effort_analytics.sources import upsert_partitions
    path = os.path.join(tmpdir_path, "tasks")
    rows = spark.range(100).select(F.when(F.col("id") < 50, F.col("id").cast("string")).alias("TaskID"),
                                   F.col("id").alias("Hours"))
    upsert_partitions(rows, path, ["TaskID"], buckets=8)
    stored = spark.read.parquet(path)
    assert stored.count() == 100
    assert stored.where("TaskID IS NULL").select("key_bucket").distinct().count() > 4
    new = spark.createDataFrame([("7", 700, "x"), (None, 1, "y")], "TaskID string, Hours bigint, Note string")
    upsert_partitions(new, path, ["TaskID"], buckets=8)
    after = spark.read.option("mergeSchema", True).parquet(path)
    assert after.count() == 101 and after.where("TaskID IS NULL").count() == 51
    assert [tuple(r) for r in after.where("TaskID = '7'").select("Hours", "Note").collect()] == [(700, "x")]


def test_registered_table_shows_added_columns(spark, tmpdir_path):
    db, path = "ea_test_db", os.path.join(tmpdir_path, "m")
    spark.range(2).write.parquet(path)
    register_table(spark, db, "m", path)
    spark.range(3).withColumn("more", F.lit("x")).write.mode("overwrite").parquet(path)
    register_table(spark, db, "m", path)
    assert spark.table(f"{db}.m").columns == ["id", "more"] and spark.table(f"{db}.m").count() == 3
    base = os.path.join(tmpdir_path, "v")
    replace_table(spark.range(3), base, f"{db}.v")
    replace_table(spark.range(3).withColumn("more", F.lit(1)), base, f"{db}.v")
    assert spark.table(f"{db}.v").columns == ["id", "more"] and spark.table(f"{db}.v").count() == 3
    spark.sql(f"DROP TABLE {db}.m")
    spark.sql(f"DROP TABLE {db}.v")


def test_newest_load_supersedes_earlier_ones(spark, tmpdir_path):
    from effort_analytics.operators import newest_load
    path = os.path.join(tmpdir_path, "leaves")
    row = spark.createDataFrame([(1, 7.5)], "EmployeeID bigint, Hours double")
    append_load(row, path, "2024-10-14")
    append_load(row, path, "2024-10-15")
    got = newest_load(spark.read.parquet(path))
    assert got.agg(F.sum("Hours")).first()[0] == 7.5 and got.columns == ["EmployeeID", "Hours"]
    assert newest_load(row) is row


def test_upsert_partitions_rewrites_only_touched_buckets(spark, tmpdir_path):
    from effort_analytics.operators import upsert
    from effort_analytics.sources import upsert_partitions
    path = os.path.join(tmpdir_path, "tasks")
    target = spark.range(200).select(F.col("id").cast("string").alias("TaskID"), F.col("id").alias("Hours"))
    upsert_partitions(target, path, ["TaskID"], buckets=16)
    before = {d: sorted(os.listdir(os.path.join(path, d))) for d in os.listdir(path) if d.startswith("key_bucket=")}
    source = spark.createDataFrame([("5", 500), ("7", 700), ("new", 1)], "TaskID string, Hours bigint")
    upsert_partitions(source, path, ["TaskID"], buckets=16)
    got = sorted(map(tuple, spark.read.parquet(path).select("TaskID", "Hours").collect()))
    want = sorted(map(tuple, upsert(target, source, ["TaskID"]).collect()))
    assert got == want
    after = {d: sorted(os.listdir(os.path.join(path, d))) for d in os.listdir(path) if d.startswith("key_bucket=")}
    touched = {r.key_bucket for r in spark.read.parquet(path).where("TaskID in ('5','7','new')").collect()}
    unchanged = [d for d in before if int(d.split("=")[1]) not in touched]
    assert unchanged and all(before[d] == after[d] for d in unchanged)

"""Loads that replace each other in part, snapshots found by folder names, workbooks read in a
stream, re-pointed tables, exports without a gap, clipped leave, measured lookups."""

import datetime as dt
import io
import os
import tracemalloc
import zipfile

import pytest
from pyspark.sql import functions as F

from effort_analytics.operators import join_lookup, load_order, measure_lookups, newest_entries, newest_load
from effort_analytics.sources import append_load, export_single_csv, newest_partitions, read_newest, register_table, sinks
from effort_analytics.sources.readers import workbook_rows
from effort_analytics.sources.xlsx import sheet_records, write_workbook

ENTRY = "load_id string, EmployeeID bigint, Day string, Type string, Unit int"


def _got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_newest_entries(spark):
    rows = [("9", 1, "d1", "V", 1), ("9", 1, "d1", "V", 1), ("9", 1, "d2", "V", 1), ("9", 2, "d1", "V", 1), ("9", None, "d1", None, 3),
            ("10", 1, "d1", "V", -1), ("10", 3, "d9", "S", 1), ("10", None, "d1", None, 4), ("8", 1, "d1", "V", 7)]
    df = spark.createDataFrame(rows, ENTRY)
    want = [(None, "d1", None, 4), (1, "d1", "V", -1), (1, "d2", "V", 1), (2, "d1", "V", 1), (3, "d9", "S", 1)]
    keys = ["EmployeeID", "Day", "Type"]
    assert _got(newest_entries(df, keys)) == sorted(want, key=repr)
    again = df.unionByName(df.where("load_id = '10'").withColumn("load_id", F.lit("11")))  # the same load once more
    assert _got(newest_entries(again, keys)) == sorted(want, key=repr)
    assert _got(newest_entries(df.where("load_id = '9'"), keys)) == _got(df.where("load_id = '9'").drop("load_id"))  # repeats within a load stay
    assert newest_entries(df.drop("load_id"), keys).count() == len(rows)
    assert newest_entries(df.limit(0), keys).count() == 0


def test_newest_entries_with_a_hot_entry(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, "7").otherwise(F.concat((F.col("id") % 11).cast("string"))).alias("load_id"),
                                   F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).alias("k"), F.col("id").alias("v"))
    out = newest_entries(df, "k")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan
    last = {}
    for r in df.collect():
        last[r.k] = max(last.get(r.k, -1), int(r.load_id))
    assert _got(out) == sorted(((r.k, r.v) for r in df.collect() if int(r.load_id) == last[r.k]), key=repr)


def test_load_order(spark):
    ids = ["9", "10", "009", "2024-9-30", "2024-10-02", "2024-10-14", "run-2b", "run-10a", None, ""]
    rows = spark.createDataFrame([(x,) for x in ids], "x string")
    got = [r.x for r in rows.orderBy(load_order("x")).collect()]
    assert got[0] is None and got[1] == ""
    assert got.index("9") < got.index("10") and got.index("2024-9-30") < got.index("2024-10-02") < got.index("2024-10-14") and got.index("run-2b") < got.index("run-10a")
    both = spark.createDataFrame([("9", 1), ("10", 2)], "load_id string, v int")
    assert _got(newest_load(both)) == [(2,)]


def test_partial_second_load_of_a_table(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "leaves")
    row = spark.createDataFrame([(1, "d1", 7.5), (2, "d1", 7.5)], "EmployeeID bigint, Day string, Hours double")
    append_load(row, path, "9")
    append_load(row.where("EmployeeID = 1").withColumn("Hours", F.lit(3.0)), path, "10")
    append_load(row.where("EmployeeID = 1").withColumn("Hours", F.lit(3.0)), path, "10")
    got = newest_entries(spark.read.parquet(path), ["EmployeeID", "Day"])
    assert _got(got) == [(1, "d1", 3.0), (2, "d1", 7.5)]


def test_newest_snapshot_by_folder_names(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "snap")
    rows = [("a", 2024, 9, 30, 1), ("a", 2024, 10, 1, 2), ("a", 2024, 10, 1, 3), ("b", 2023, 12, 31, 4), ("b", 2024, 2, 9, 5), ("b", 2024, 2, 10, 6)]
    df = spark.createDataFrame(rows, "src string, y int, m int, d int, v int")
    df.write.partitionBy("src", "y", "m", "d").parquet(path)
    levels = ("y", "m", "d")
    os.makedirs(f"{path}/src=b/y=2024/m=11")  # a snapshot that has not been filled yet
    assert newest_partitions(spark, path, levels, ["src"]) == [{"src": "a", "y": "2024", "m": "10", "d": "1"}, {"src": "b", "y": "2024", "m": "2", "d": "10"}]
    out = read_newest(spark, path, levels, ["src"])
    assert sorted(r.v for r in out.collect()) == [2, 3, 6]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and not any(x in plan for x in ("SortMergeJoin", "HashJoin", "NestedLoop")) and "DataFilters: []" in plan and "(src#" in plan
    assert [r.v for r in read_newest(spark, f"{path}/src=b", levels).collect()] == [6]
    empty = os.path.join(tmpdir_path, "none")
    os.makedirs(empty)
    assert newest_partitions(spark, empty, levels) == []
    assert read_newest(spark, path, ("nope",)).count() == 0


def _workbook(path, n):
    write_workbook(path, {"S": [["a", "b"]] + [[f"text {i} of {path}", i] for i in range(n)]})


def test_workbooks_are_read_in_a_stream(tmpdir_path):
    import pyarrow as pa
    files = []
    for i in range(24):
        _workbook(f"{tmpdir_path}/{i}.xlsx", 3000)
        files.append((f"{tmpdir_path}/{i}.xlsx", open(f"{tmpdir_path}/{i}.xlsx", "rb").read()))
    batch = pa.RecordBatch.from_arrays([pa.array([f for f, _ in files]), pa.array([c for _, c in files], pa.binary())], names=["path", "content"])
    parse = workbook_rows("S", ["a", "b"], "file", 500)
    list(parse([batch.slice(0, 1)]))
    tracemalloc.start()
    rows = sum(b.num_rows for b in parse([batch.slice(0, 1)]))
    one = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    rows += sum(b.num_rows for b in parse([batch]))
    many = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 25 * 3000 and many < 4 * one  # of 24 times the files
    assert max(b.num_rows for b in parse([batch.slice(0, 2)])) == 500


@pytest.mark.parametrize("attribute, want", [("", ["1900-01-01", "1900-02-28", "1900-03-01", "2024-10-15", "2024-10-15 12:00:00"]),
                                             (' date1904="1"', ["1904-01-02", "1904-02-29", "1904-03-02", "2028-10-16", "2028-10-16 12:00:00"])])
def test_date_systems(tmpdir_path, attribute, want):
    serials = [1, 59, 61, 45580, 45580.5]
    path = f"{tmpdir_path}/d.xlsx"
    write_workbook(path, {"S": [["d"]] + [[x] for x in serials]})
    out = io.BytesIO()
    with zipfile.ZipFile(path) as old, zipfile.ZipFile(out, "w") as new:
        for n in old.namelist():
            text = old.read(n).decode()
            if n == "xl/workbook.xml":
                text = text.replace("<sheets>", f"<workbookPr{attribute}/><sheets>")
            new.writestr(n, text.replace("><v>", ' s="0"><v>') if "worksheets" in n else text)
        new.writestr("xl/styles.xml", '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><cellXfs><xf numFmtId="14"/></cellXfs></styleSheet>')
    assert [r["d"] for r in sheet_records(out.getvalue(), "S")] == want


def test_register_switches_the_location(spark, tmpdir_path):
    db, a, b = "ea_loads_db", os.path.join(tmpdir_path, "a"), os.path.join(tmpdir_path, "b")
    spark.range(3).write.parquet(a)
    spark.range(7).write.parquet(b)
    register_table(spark, db, "t", a)
    register_table(spark, db, "t", b)
    assert spark.table(f"{db}.t").count() == 7
    register_table(spark, db, "t", b + "/")
    assert spark.table(f"{db}.t").count() == 7
    p, q = os.path.join(tmpdir_path, "p"), os.path.join(tmpdir_path, "q")
    for path, n in ((p, 3), (q, 7)):
        spark.range(n).withColumn("part", F.col("id") % 2).write.partitionBy("part").parquet(path)
        register_table(spark, db, "u", path)
        assert spark.table(f"{db}.u").count() == n
    assert spark.read.parquet(a).count() == 3
    spark.sql(f"DROP TABLE {db}.t")
    spark.sql(f"DROP TABLE {db}.u")


def test_export_keeps_the_old_file_on_failure(spark, tmpdir_path, monkeypatch):
    path = f"{tmpdir_path}/out.csv"
    export_single_csv(spark.createDataFrame([(1,)], "a int"), path)
    old = open(path).read()

    class Broken:
        """A file system whose second rename, the new file's, fails."""

        def __init__(self, fs):
            self.fs, self.n = fs, 0

        def rename(self, x, y):
            self.n += 1
            return False if self.n == 2 else self.fs.rename(x, y)

        def __getattr__(self, name):
            return getattr(self.fs, name)

    plain = sinks._move_in
    monkeypatch.setattr(sinks, "_move_in", lambda fs, *a: plain(Broken(fs), *a))
    with pytest.raises(OSError, match="can't be moved"):
        export_single_csv(spark.createDataFrame([(2,)], "a int"), path)
    monkeypatch.undo()
    assert open(path).read() == old and [f for f in os.listdir(tmpdir_path) if "staging" in f] == []
    export_single_csv(spark.createDataFrame([(2,)], "a int"), path)
    assert open(path).read() == "a\n2\n"
    export_single_csv(spark.createDataFrame([], "a int, b int"), path)
    assert open(path).read() == "a,b\n"


def test_leave_is_clipped_at_the_run_date(spark):
    from effort_analytics.plans.calendar import generate_calendar
    from effort_analytics.plans.targets import planned_leave_deduction
    as_of = dt.date(2024, 10, 15)
    cal = generate_calendar(spark, dt.date(2024, 10, 1), dt.date(2024, 11, 1))
    days = [(1, dt.date(2024, 10, 9)), (1, as_of), (1, dt.date(2024, 10, 16)), (2, dt.date(2024, 10, 31))]
    leaves = spark.createDataFrame([(e, d, "Vacation", 1, 7.5) for e, d in days],
                                   "EmployeeID bigint, TimeOffDate date, TimeOffTypeforTimeOffEntry string, Unit int, TC_Hours double")
    plain = {r.WorkdayID: r.TotalHoursToDeduct for r in planned_leave_deduction(leaves, cal).collect()}
    cut = {r.WorkdayID: r.TotalHoursToDeduct for r in planned_leave_deduction(leaves, cal, as_of=as_of).collect()}
    assert plain == {1: 22.5, 2: 7.5} and cut == {1: 15.0}


def test_measured_lookups(spark):
    a = spark.createDataFrame([("x", "1"), ("y", "2"), (None, "3"), (None, "4")], "k string, v string")
    b = spark.createDataFrame([("x", "1"), ("x", "2")], "k string, v string")
    got = measure_lookups(a=(a, "k"), b=(b, "k"), none=(a.limit(0), "k"))
    assert got["a"].unique and got["a"].rows == 2 and got["a"].bytes == 2 * (40 + 16 + 2)
    assert not got["b"].unique and got["none"].unique and got["none"].rows == 0
    big = spark.createDataFrame([("x",), ("z",), (None,)], "k string")
    for limit in (1 << 20, 0):  # broadcast or not: the same rows
        out = join_lookup(big, got["a"], "k", limit=limit)
        assert _got(out) == sorted([("x", "1"), ("z", None), (None, None)], key=repr)
        assert ("BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()) or limit == 0


@pytest.mark.parametrize("twice", [False, True])
def test_facts_from_lookups_equal_the_plain_ones(spark, twice):
    """With unique lookups (narrow rows) and with a member listed twice (the plain form)."""
    from effort_analytics.plans import analogues as A
    from effort_analytics.plans import facts, targets

    from .conftest import SF0001
    t = A.Tables(spark, SF0001)
    members, cal, leaves = A.members(t), A.calendar(spark), A.leaves(t)
    members = members.unionByName(members.where("WorkdayID = 3").withColumn("Squad", F.lit("other"))) if twice else members
    leaves = leaves.unionByName(leaves.limit(50))
    few = A.tasks(t).where("Progress = 100")
    expected = targets.expected_hours(A.members(t), cal, A.AS_OF, A.MIN_YEAR)
    planned = targets.planned_leave_deduction(leaves, cal)
    rows = facts.task_leave_rows(few, leaves, members, A.buckets(t), cal)
    for keep in (False, True):
        want = facts.publish_task_leave_fact(rows, cal, A.productivity_types(t), expected, planned, min_year=A.MIN_YEAR, keep_duplicates=keep)
        got = facts.task_and_leave_fact(few, leaves, members, A.buckets(t), cal, A.productivity_types(t), expected, planned,
                                        min_year=A.MIN_YEAR, keep_duplicates=keep, tasks_unique=not twice)
        assert got.columns == want.columns and _got(got) == _got(want)
    if not twice:
        one = facts.task_fact(few, members, cal, A.buckets(t), A.planner_codes(t), A.productivity_types(t), min_year=A.MIN_YEAR)
        plain = facts.publish_task_fact(few, members, cal, A.buckets(t), A.planner_codes(t), A.productivity_types(t), min_year=A.MIN_YEAR)
        assert one.columns == plain.columns and _got(one) == _got(plain)
        plan = one._jdf.queryExecution().executedPlan().toString()
        narrow = [line for line in plan.splitlines() if "Exchange hashpartitioning(Title" in line]
        assert narrow and all("AssignedTo" not in line and line.count("#") <= 8 for line in narrow)
        assert not any(f"SortMergeJoin [{c}" in plan for c in ("Category", "BucketID", "_person", "Date"))

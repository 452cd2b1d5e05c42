"""Stars of sorted buckets, however they are cut into batches and tasks."""

import numpy as np
import pyarrow as pa
import pytest

from effort_analytics.llm import minhash_dedup as M


@pytest.mark.parametrize("step", [1, 2, 3, 1000])
def test_runs_over_batches(step):
    rows = sorted({(k, d) for k, d in zip([1, 1, 1, 2, 3, 3, 4, 5, 5, 5, 5], [7, 2, 9, 4, 8, 6, 1, 3, 2, 4, 9])})
    batch = pa.RecordBatch.from_pydict({"key": [k for k, _ in rows], "d": [d for _, d in rows], "n": [d * 10 for _, d in rows]})
    got = [tuple(r.values()) for b in M._stars(batch.slice(i, step) for i in range(0, len(rows), step)) for r in b.to_pylist()]
    assert sorted(r for r in got if r[2] is not None) == [(1, 7, 2, 70, 20), (1, 9, 2, 90, 20), (3, 8, 6, 80, 60), (5, 3, 2, 30, 20), (5, 4, 2, 40, 20), (5, 9, 2, 90, 20)]
    assert [r[:2] for r in got if r[2] is None] == [(1, 2), (5, 2)]
    assert list(M._stars(iter([]))) == []


@pytest.mark.parametrize("tasks", [1, 3, 40])
def test_buckets_shared_by_tasks(spark, tasks):
    """A bucket that holds a third of all rows, cut by the range partitions."""
    rng = np.random.default_rng(1)
    rows = [(0, int(d), 5) for d in range(100)] + [(int(k), int(d), 5) for k, d in {(k, d) for k, d in zip(rng.integers(1, 60, 200), rng.integers(0, 500, 200))}]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    try:
        got = [(r.key, r.d, r.u) for r in M.stars(spark.createDataFrame(rows, "key long, d long, n long")).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for key in {r[0] for r in rows}:
        nodes = {d for k, d, _ in rows if k == key}
        edges = [(d, u) for k, d, u in got if k == key and d != u]
        listed = {d for k, d, _ in got if k == key}
        assert len(edges) == len(nodes) - 1 and listed | {min(nodes)} == nodes
        of = {d: d for d in nodes}  # one component
        for d, u in edges:
            a, b = of[d], of[u]
            of = {x: b if c == a else c for x, c in of.items()}
        assert len(set(of.values())) == 1
        direct = all(u == min(nodes) for _, u in edges)
        assert direct or min(nodes) in listed  # where some weren't compared with the first, it counts as a member

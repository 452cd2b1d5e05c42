"""Top-k search: bounds that never cut a point off, cells split over groups, large components, clusters."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from effort_analytics.llm import voronoi_topk as V

SCHEMA = "vec_id long, embedding array<double>"


def _plain(rows, k=5):
    def whole(x):
        return max(-2**63, min(2**63 - 1, int(np.floor(256 * x)) if abs(x) < 2**60 else int(np.sign(x)) * 2**63))
    ok = {i: [whole(x) for x in v] for i, v in rows}
    ok = {i: [float(x) for x in v] for i, v in ok.items()}  # a long as double
    ints = {i: [int(x) for x in v] for i, v in ok.items()}
    out = []
    for q in (i for i in ok if i % 50 == 0):
        best = sorted((-max(-(2**63 - 1), min(2**63 - 1, sum(a * b for a, b in zip(ints[q], v)))), i) for i, v in ints.items() if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def _check(spark, rows, **sizes):
    got = V.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, **sizes)
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == _plain(rows)


@pytest.mark.parametrize("sizes", [{}, {"block": 40}, {"pivots": 3, "block": 7, "home": 1}, {"pivots": 1, "sample": 5, "block": 30}])
def test_clusters(spark, sizes):
    rnd = np.random.default_rng(4)
    centres = rnd.normal(size=(12, 8)) * 3
    rows = [(i, (centres[i % 12 if i % 3 else 0] + rnd.normal(size=8) * 0.05).tolist()) for i in range(600)] + [(600 + i, [0.0] * 8) for i in range(60)]
    _check(spark, rows, **sizes)


@pytest.mark.parametrize("big", [1e18, 1e300, 1e6])
def test_large_components(spark, big):
    rnd = np.random.default_rng(5)
    rows = [(i, (rnd.normal(size=4) * (big if i % 5 == 0 else 1)).tolist()) for i in range(150)] + [(150, [big] * 4), (200, [-big] * 4), (201, [big, -big, 1.0, 1.0])]
    for sizes in ({}, {"pivots": 4, "block": 16, "home": 1}):
        _check(spark, rows, **sizes)


def test_reach_is_a_bound():
    rnd = np.random.default_rng(6)
    for size in (1.0, 300.0, 1e9):
        x, q, p = (rnd.normal(size=(n, 5)) * size for n in (200, 30, 1))
        radius, norm = np.sqrt(((x - p) ** 2).sum(axis=1)).max(), np.sqrt((x * x).sum(axis=1)).max()
        assert (V.reach(q, p, np.array([radius]), np.array([norm]))[:, 0] >= (q @ x.T).max(axis=1)).all()
        assert (V.reach(x, p, np.array([0.0]), np.sqrt((p * p).sum(axis=1)))[:, 0] >= (x @ p.T)[:, 0]).all()


def test_groups_hold_each_cell():
    rnd = np.random.default_rng(7)
    counts = np.array([3, 100, 0, 7, 9, 25, 1])
    base, parts, n = V._groups(rnd.normal(size=(7, 3)), counts, 20)
    assert parts.tolist() == [1, 5, 1, 1, 1, 2, 1] and (base + parts).max() <= n
    used = [g for b, p in zip(base, parts) for g in range(b, b + p)]
    for g in set(used):
        held = [i for i in range(7) if base[i] <= g < base[i] + parts[i]]
        assert sum(counts[i] for i in held) <= 20 or len(held) == 1 and parts[held[0]] > 1

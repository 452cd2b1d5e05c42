"""The exact step of near-dedup: no link between components is lost by the prefixes, whatever their size."""

import random

import pytest
from pyspark.sql import functions as F

from effort_analytics.llm import minhash_dedup as M


def _shingles(text, k):
    w = text.lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


def _alike(a, b, percent):
    return 100 * len(a & b) >= percent * len(a | b)


def _texts():
    """Chains of texts near the limit over a few words, so that many shingles are frequent."""
    rnd = random.Random(11)
    out = {}
    for _ in range(6):
        words = [f"w{rnd.randrange(40)}" for _ in range(rnd.choice([3, 9, 40, 70]))]
        for _ in range(25):
            words = list(words)
            for _ in range(rnd.randint(1, 3)):
                words[rnd.randrange(len(words))] = f"w{rnd.randrange(40)}"
            out[" ".join(words)] = None
    return {t: i * 7919 - 6 for i, t in enumerate([*out, "one", "w1 w2"])}


def _table(spark, texts):
    return spark.createDataFrame([(d, t) for t, d in texts.items()], "d long, text string")


def _unsettled(spark, texts, label, k, percent, buckets=1):
    """(key, d) pairs left of buckets that each hold the nodes d with d % buckets = key or key + 1."""
    left = [(key, d) for d in texts.values() for key in {d % buckets, (d + 1) % buckets}]
    table = spark.createDataFrame(left, "key long, d long")
    return {(r.key, r.d) for r in M.unsettled(table, _table(spark, texts), label, k, percent).collect()}, set(left)


@pytest.mark.parametrize("k,percent,buckets", [(1, 80, 1), (2, 80, 3), (2, 93, 1), (2, 100, 1), (5, 80, 3)])
def test_alike_nodes_stay_in_their_buckets(spark, k, percent, buckets):
    texts = _texts()
    label = spark.createDataFrame([], "d long, c long")  # each node a component of its own
    got, left = _unsettled(spark, texts, label, k, percent, buckets)
    assert got <= left
    sets = {d: _shingles(t, k) for t, d in texts.items()}
    pairs = [(a, b) for a in sets for b in sets if a < b and _alike(sets[a], sets[b], percent) and sets[a] != sets[b]]
    assert pairs or percent == 100
    for a, b in pairs:
        for key in range(buckets):
            assert not {(key, a), (key, b)} <= left or {(key, a), (key, b)} <= got


def test_prefixes_are_whole_numbers(spark):
    """Lengths of prefixes at every size: no rounding loses a place."""
    texts = {" ".join(f"w{i}" for i in range(n)): n for n in range(1, 130)}
    for percent in (80, 70, 93):
        got = {r.d: r["count"] for r in M.prefixes(_table(spark, texts), 1, percent).groupBy("d").count().collect()}
        for n in range(1, 129):  # the last has a shingle of its own, which takes the first place
            assert got[n] == n - -(-n * percent // 100) + 1


def test_nodes_of_one_component_leave(spark):
    texts = _texts()
    label = spark.createDataFrame([(d, -9) for d in texts.values()], "d long, c long")
    assert not _unsettled(spark, texts, label, 2, 80)[0]


def test_own_words_beside_a_template_join_nothing(spark):
    template = " ".join(f"t{i}" for i in range(70))
    texts = {f"{template} " + " ".join(f"o{n}x{i}" for i in range(30)): n for n in range(600)}
    assert not _unsettled(spark, texts, spark.createDataFrame([], "d long, c long"), 2, 80)[0]


@pytest.mark.parametrize("block", [256, 5])
def test_links_do_not_depend_on_sizes(spark, block, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", block)
    texts = _texts()
    table = _table(spark, texts)
    got = M._exact(table.select(F.lit(0).cast("long").alias("key"), "d"), table, spark.createDataFrame([], "d long, c long"), 2, 80)
    links = {(r.u, r.v) for r in got.distinct().collect()}
    sets = {d: _shingles(t, 2) for t, d in texts.items()}
    assert all(_alike(sets[u], sets[v], 80) for u, v in links)

    def components(edges):
        of = {d: d for d in sets}
        for a, b in edges:
            x, y = of[a], of[b]
            of = {d: y if c == x else c for d, c in of.items()}
        out = {}
        for d, c in of.items():
            out.setdefault(c, set()).add(d)
        return {frozenset(c) for c in out.values()}

    assert components(links) == components((a, b) for a in sets for b in sets if a < b and _alike(sets[a], sets[b], 80))


def test_no_nodes(spark):
    none = spark.createDataFrame([], "d long, text string")
    label = none.select("d", F.col("d").alias("c"))
    assert M.unsettled(none.select(F.col("d").alias("key"), "d"), none, label, 2, 80).isEmpty()

"""Ranked lexical search against plain counting and sorting."""

import math
import random
import re

import numpy as np
import pytest

from effort_analytics.llm import lexical_search

DOCS = "doc_id long, text string, item_id int, item int, n int, score int, t int"
ITEMS = "item_id long, text string, doc_id int, rank int"


def _terms(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def _brute(docs, items, k):
    have = [(d, _terms(t)) for d, t in docs]
    n, total = sum(bool(w) for _, w in have), sum(len(w) for _, w in have)
    out = []
    for item, text in set(items):
        scored = []
        for d, w in have:
            score = 0
            for t in set(_terms(text)):
                tf, df = w.count(t), sum(t in x for _, x in have)
                if tf:
                    m = 100 - 90 + 90 * len(w) * n // total
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d, score))
        scored.sort(key=lambda x: x[:2] + (x[2] or 0,))
        out += [(item, r, d, s) for r, (_, _, d, s) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def _docs():
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(30)] + ["Été", "été", "ÉTÉ", "x'y", "A1", "a1", "日本", " z"]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 25)))) for i in range(60)]
    docs += [(100 + i, docs[5][1]) for i in range(15)] + [docs[7], docs[7], (None, docs[5][1]), (None, None), (200, ""), (201, " \n-- ")]
    return docs


ITEM_ROWS = [(1, "w1 W2 w2 w3 été"), (2, "a1, A1! 日本 x"), (3, None), (4, "--"), (5, "nowhere"), (6, "w1 w2 w3 w4 w5 w6 w7 w8 w9 y"), (6, "w1 w2 w3 w4 w5 w6 w7 w8 w9 y"), (6, "w7"), (None, "w8 w9")]


@pytest.mark.parametrize("sizes", [{}, {"item_tile": 2, "column_tile": 3, "doc_tile": 4}, {"block_terms": 6, "doc_tile": 1}])
def test_search(spark, sizes):
    docs = _docs()
    table = spark.createDataFrame([(*d, 0, 0, 0, 0, 0) for d in docs], DOCS).repartition(5)
    items = spark.createDataFrame([(*i, 0, 0) for i in ITEM_ROWS], ITEMS)
    got = lexical_search.search(table, items, 10, **sizes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == _brute(docs, ITEM_ROWS, 10)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "w1", 0, 0, 0, 0, 0)], DOCS)
    items = spark.createDataFrame([(1, "w1", 0, 0)], ITEMS)
    assert lexical_search.search(docs.limit(0), items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0
    assert lexical_search.search(docs.selectExpr("doc_id", "CAST(NULL AS STRING) AS text"), items).count() == 0


def test_long_text_and_long_item(spark):
    docs = [(1, "word " * 300_000 + "rare"), (2, "rare"), (3, "other")]
    items = [(1, " ".join(f"q{i}" for i in range(20_000)) + " rare")]
    got = lexical_search.search(spark.createDataFrame([(*d, 0, 0, 0, 0, 0) for d in docs], DOCS), spark.createDataFrame([(*i, 0, 0) for i in items], ITEMS), column_tile=512)
    assert sorted(tuple(r) for r in got.collect()) == _brute(docs, [(1, "rare")], 10)


def test_columns_are_limited_to_exact_sums():
    weight = np.full(100, 2**31, np.int64)
    parts = lexical_search.tiles([np.arange(100)], weight, 4, 4096)[0][1]
    assert sum(len(t) for t, _ in parts) == 100
    assert all(int(w.sum()) * lexical_search.MAX_IMPACT < 2**53 for _, w in parts)
    x = np.full((4, 1), 999_999.0)
    assert int((parts[0][1] @ x[:parts[0][1].shape[1]])[0, 0]) == 2**31 * 999_999 * len(parts[0][0])


def test_ties_at_the_edge():
    score, ids = np.array([5, 5, 5, 7, 0, 5], np.int64), np.array([9, 2, 4, 8, 1, 3])
    assert ids[lexical_search.best(score, ids, 3)].tolist() == [8, 2, 3]
    assert lexical_search.impacts(np.array([1]), np.array([2**50]), 2**20, 2**60).tolist() == [10**9 // (1000 + 8 * (10 + 90 * 2**10))]

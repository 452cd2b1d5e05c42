"""Fingerprints of tables whose rows share an id or have none, and of repeated rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from effort_analytics.llm import _common, fingerprints

SCHEMA = "doc_id long, text string"


def _texts(n):
    rnd = random.Random(3)
    return ["\n".join(" ".join(rnd.choice("abcdefgh") * rnd.randint(1, 3) for _ in range(rnd.randint(0, 9))) for _ in range(rnd.randint(0, 3))) + f" {i}" for i in range(n)]


def _want(spark, rows):
    """The operator's order is by id (NULL last), then the text's hash; each text's next is the one after it."""
    keys = _common.keyed(spark.createDataFrame(rows, SCHEMA)).select("d", "h", "doc_id", "text").collect()
    order = sorted(keys, key=lambda r: (r.d, r.h))
    out = []
    for i, r in enumerate(order):
        then, k = order[(i + 1) % len(order)].text, len(r.text) // 4
        edited = r.text[:len(r.text) - k] + then[:k]
        v = fingerprints.vectors([r.text.encode(), edited.encode()])
        out.append((r.doc_id, len(r.text), hashlib.sha256(edited.encode()).hexdigest(), v[0].tobytes().hex(), v[1].tobytes().hex()))
    return out


@pytest.mark.parametrize("buckets", [1, 2, 7, 16])
@pytest.mark.parametrize("ids", ["half null", "all null", "one id", "two hot", "repeated rows", "extreme"])
def test_hot_ids(spark, ids, buckets):
    texts = _texts(400)
    rows = {"half null": [(i if i % 2 else None, t) for i, t in enumerate(texts)], "all null": [(None, t) for t in texts], "one id": [(5, t) for t in texts],
            "two hot": [(i if i % 4 == 3 else 90 if i % 4 else 210, t) for i, t in enumerate(texts)],
            "repeated rows": [(i % 3 or None, texts[i % 2]) for i in range(60)] + [(4, None), (4, ""), (4, None)],
            "extreme": [((-2**63, 2**63 - 1, None, 0)[i % 4], t) for i, t in enumerate(texts)]}[ids]
    got = fingerprints.edited_fingerprints(spark.createDataFrame(rows, SCHEMA), buckets=buckets).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(_want(spark, rows), key=repr)


def test_a_hot_id_is_spread_over_tasks(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("doc_id"), F.concat(F.lit("some text "), "id").alias("text"))
    out = fingerprints.edited_fingerprints(rows, buckets=16).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
    assert len(out) >= 15 and max(r.n for r in out) <= 2 * 20_000 / 16


def test_no_rows(spark):
    assert fingerprints.edited_fingerprints(spark.createDataFrame([], SCHEMA)).collect() == []
    one = fingerprints.edited_fingerprints(spark.createDataFrame([(None, "abcd")], SCHEMA)).first()
    assert (one.doc_id, one.near_next) == (None, 1.0)

"""The mixing stage: token shares of the sampled rows against the targets, with skewed sources."""

import random

import corpus_pipeline as pipeline
from effort_analytics.llm import mixing


def test_sampled_shares_meet_targets(spark):
    rnd = random.Random(2)
    sources, langs = ["big"] * 920 + ["mid"] * 60 + ["small"] * 20, ["en"] * 90 + ["de"] * 8 + ["es"] * 2
    rows = [(i, " ".join(["word"] * rnd.randint(15, 25)) + rnd.choice(["", "", "", "", " licence", " a@b", " <x>"]), rnd.choice(langs), rnd.choice(sources), 0)
            for i in range(60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    before, after = (mixing.described(x).select("doc_id", "_source", "_lang", "_topic", "_tokens").collect() for x in (docs, pipeline.mixed(spark, docs, "")))
    assert abs(sum(r._tokens for r in after) / sum(r._tokens for r in before) / 0.9 - 1) < 0.01
    for name in ("_source", "_lang", "_topic"):
        old, new = {}, {}
        for rows_, sums in ((before, old), (after, new)):
            for r in rows_:
                sums[r[name]] = sums.get(r[name], 0) + r._tokens
        target = {k: v**0.9 for k, v in old.items()}
        for k, x in target.items():
            assert abs(new[k] / sum(new.values()) / (x / sum(target.values())) - 1) < 0.04, (name, k)

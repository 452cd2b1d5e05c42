"""Each stage of the pipeline against a small plain-Python version, on rows with NULL and shared ids,
repeated rows and skewed sources."""

import collections
import datetime
import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from effort_analytics.llm import mixing, pseudonyms, sentencepiece_codec, toxicity

from .test_near_dedup_nodes import LAST, SCHEMA, _groups, _sets
from .test_operators import _whole


def _fixture():
    rnd = random.Random(6)
    bases = [[f"b{i}w{rnd.randrange(1000)}q" for _ in range(40)] for i in range(60)]
    rows = []
    for n in range(400):
        words = list(bases[rnd.randrange(60)]) if n % 2 else [f"n{n}w{j}q" for j in range(rnd.randint(1, 30))]
        words[rnd.randrange(len(words))] += rnd.choice(["", "z"])
        tail = rnd.choice(["", " licence", " x <y>", " seen 2024-02-29 from 10.0.0.1", " ssn 123-45-6789"])
        d = rnd.choice([None, None, 7, n, n])
        rows.append((d, " ".join(words) + tail, rnd.choice(["en"] * 8 + ["de", None]), rnd.choice(["big"] * 18 + ["mid", "rare"]), 5))
    return rows + rows[:9] + [(None, None, "en", "big", 0), (3, "", None, "rare", 0), (3, "", None, "rare", 0), (None, "a", "en", "big", 1)]


ROWS = _fixture()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5)


def _counted(df):
    return collections.Counter(tuple(r) for r in df.select(*pipeline.COLUMNS).collect())


def test_toxicity(spark):
    sf = "/root/testdata/sf0.001"
    some = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select(*pipeline.COLUMNS).collect()]
    rows = some + some[:40] + [(None, *r[1:]) for r in some[:60]] + [(some[0][0], *some[5][1:]), (None, None, "en", "s", 0), (None, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).checkpoint()
    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"), F.lit(True))
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(sorted({r[1] or "" for r in rows}))], "doc_id long, text string")
    score = {r.own: r.score for r in model.score(texts.withColumn("own", F.col("text"))).collect()}
    assert _counted(pipeline.clean(spark, docs, sf)) == collections.Counter(r for r in rows if score[r[1] or ""] < 0.5)


def test_near_dedup(spark, docs):
    group = _groups(_sets({r[1] for r in ROWS}, 5))
    kept = _counted(pipeline.distinct(spark, docs, ""))
    assert set(kept) <= set(ROWS) and max(kept.values()) == 1
    assert collections.Counter(group[r[1]] for r in kept if r[1] in group) == collections.Counter(set(group.values()))
    for r in kept:
        if r[1] in group:
            assert (LAST if r[0] is None else r[0]) == min(LAST if o[0] is None else o[0] for o in ROWS if group.get(o[1]) == group[r[1]])
    assert {(r[0], r[1] or "") for r in kept if r[1] not in group} == {(r[0], r[1] or "") for r in ROWS if r[1] not in group}


def _feistel(value, a, b, kind):
    left, right = divmod(value, b)
    for i in range(pseudonyms.ROUNDS):
        x = int(hashlib.sha256(f"{pseudonyms.KEY}|{kind}|{i}|{left if i % 2 else right}".encode()).hexdigest()[:12], 16)
        left, right = (left, (right + x) % b) if i % 2 else ((left + x) % a, right)
    return left * b + right


def test_pii(spark, docs):
    first = datetime.date(1800, 1, 1)
    day = first + datetime.timedelta(_feistel((datetime.date(2024, 2, 29) - first).days, 189, 773, "date"))
    ip = _feistel(10 << 24 | 1, 65_536, 65_536, "ip")
    top, serial = divmod(_feistel(((123 - 1) * 99 + 45 - 1) * 9999 + 6789 - 1, 898 * 99, 9999, "ssn"), 9999)
    area = top // 99 + (2 if top // 99 >= 665 else 1)
    put = {"2024-02-29": day.isoformat(), "10.0.0.1": ".".join(str(ip >> s & 255) for s in (24, 16, 8, 0)), "123-45-6789": f"{area:03}-{top % 99 + 1:02}-{serial + 1:04}"}
    want = collections.Counter()
    for d, t, lang, source, n in ROWS:
        new = t
        for old, x in put.items():
            new = new and new.replace(old, x)
        want[d, new, lang, source, n if new == t else len(new)] += 1
    assert _counted(pipeline.private(spark, docs, "")) == want


def test_mixing(spark, docs):
    def cell(r):
        return r[3] or "", r[2] or "", next((name for name, p in mixing.TOPICS if re.search(p, r[1] or "")), "prose")
    tokens = collections.Counter()
    for r in ROWS:
        tokens[cell(r)] += len((r[1] or "").split())
    w, total, goals = dict(tokens), sum(tokens.values()), []
    for k in range(3):
        sums = collections.Counter()
        for c, n in tokens.items():
            sums[c[k]] += n
        all_ = sum(x**0.9 for x in sums.values())
        goals.append({v: x**0.9 / all_ * total for v, x in sums.items()})
    for _ in range(30):
        worst = 0
        for k in range(3):
            sums = collections.Counter()
            for c, x in w.items():
                sums[c[k]] += x
            worst = max([worst, *(abs(goals[k][c[k]] / sums[c[k]] - 1) for c in w if w[c] > 0)])
            w = {c: x * goals[k][c[k]] / sums[c[k]] if sums[c[k]] else 0 for c, x in w.items()}
        if worst < 1e-6:
            break
    own = {(r.doc_id, r.text): r._u for r in mixing.described(docs).collect()}
    want = collections.Counter()
    for r in ROWS:
        ratio = 0.9 * (w[cell(r)] / tokens[cell(r)] if tokens[cell(r)] else 1)
        want[r] += math.floor(ratio) + (own[r[0], r[1]] < ratio - math.floor(ratio))
    assert max(0.9 * w[c] / n for c, n in tokens.items() if n) > 1
    assert _counted(pipeline.mixed(spark, docs, "")) == +want


def test_sentencepiece(spark, docs):
    shared = sentencepiece_codec.load()
    v = sentencepiece_codec.Vocabulary(**shared)
    few = sorted(ROWS, key=repr)[::12] + ROWS[-4:] + ROWS[-4:]
    got = pipeline.encoded(spark, spark.createDataFrame(few, SCHEMA), "").collect()
    want = []
    for r in few:
        ids = _whole(r[1] or "", v, shared["pieces"])
        want.append((r[0], len(r[1] or ""), len(ids), ids, True))
    assert sorted(((r.doc_id, r.n_chars, r.n_tokens, list(r.ids), r.exact) for r in got), key=repr) == sorted(want, key=repr)

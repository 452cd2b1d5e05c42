"""Near-dedup of rows that share an id or have none, against brute force over the distinct sets."""

import random

import corpus_pipeline as pipeline
from effort_analytics.llm import minhash_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LAST = 2**63 - 1


def _sets(texts, k):
    out = {}
    for t in texts:
        w = (t or "").lower().split()
        out[t] = frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    return out


def _groups(sets):
    """Component number of each text with words."""
    nodes = sorted({s for s in sets.values() if s}, key=repr)
    of = {s: i for i, s in enumerate(nodes)}
    for a in nodes:
        for b in nodes:
            if of[a] != of[b] and 100 * len(a & b) >= 80 * len(a | b):
                old, new = of[a], of[b]
                of = {s: new if c == old else c for s, c in of.items()}
    return {t: of[s] for t, s in sets.items() if s}


def _near(rnd, words):
    copy = list(words)
    copy[rnd.randrange(len(copy))] += "x"
    return " ".join(copy)


def _rows():
    rnd = random.Random(3)
    bases = [[f"b{i}w{rnd.randrange(10**6)}" for _ in range(60)] for i in range(8)]
    rows = [(5, " ".join(bases[0])), (9, " ".join(bases[1]))]
    rows += [(None, _near(rnd, bases[0])), (None, _near(rnd, bases[1]))]  # each like one document with an id
    rows += [(None, _near(rnd, bases[2])) for _ in range(30)]  # alike, none with an id
    rows += [(None, " ".join(bases[3]))] * 20  # wholly repeated
    rows += [(7, " ".join(bases[4])), (7, " ".join(bases[5])), (7, _near(rnd, bases[5])), (8, _near(rnd, bases[4])), (2, _near(rnd, bases[5]))]
    rows += [(11, " ".join(bases[6])), (11, " ".join(bases[6]))]
    rows += [(None, ""), (None, ""), (None, None), (20, ""), (21, "  "), (None, "few words"), (22, "Few  words")]
    return rows


def test_rows_that_share_an_id(spark):
    rows = _rows()
    group = _groups(_sets({t for _, t in rows}, 5))
    least = {}
    for d, t in rows:
        if t in group:
            least[group[t]] = min(least.get(group[t], LAST), LAST if d is None else d)
    want = [(d, d if t not in group else None if least[group[t]] == LAST else least[group[t]]) for d, t in rows]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], SCHEMA)
    got = minhash_dedup.near_duplicates(docs, 5, row_keys=True).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=repr) == sorted(want, key=repr)
    assert len({r.g for r in got if r.kept and r.g is not None}) == len(set(group.values()))
    assert len({(r.g, r.d) for r in got if r.kept and r.g is not None}) == len(set(group.values()))


def test_stage_keeps_one_row_of_each_group(spark):
    rows = _rows()
    group = _groups(_sets({t for _, t in rows}, 5))
    docs = spark.createDataFrame([(d, t, "en", f"s{i % 3}", len(t or "")) for i, (d, t) in enumerate(rows)], SCHEMA)
    kept = [(r.doc_id, r.text) for r in pipeline.distinct(spark, docs, "").collect()]
    assert sorted(group[t] for _, t in kept if t in group) == sorted(set(group.values()))
    for d, t in kept:
        if t in group:
            assert (LAST if d is None else d) == min(LAST if e is None else e for e, u in rows if group.get(u) == group[t])
    assert sorted(((d, t or "") for d, t in kept if t not in group), key=repr) == sorted([(None, ""), (20, ""), (21, "  ")], key=repr)

"""Substring dedup of thousands of different texts under one NULL id, and of repeated rows without one."""

import hashlib
import random

import pytest

from effort_analytics.llm import substring_dedup, suffix_dedup


def _texts():
    """Short texts of which every fourth holds one of a few passages; all different."""
    rnd = random.Random(8)
    passages = [" ".join(f"p{i}x{j}" for j in range(14)) for i in range(5)]
    return [" ".join([f"u{n}v{j}" for j in range(rnd.randint(0, 12))] + ([rnd.choice(passages)] if n % 4 == 0 else []) + [f"t{n}"]) for n in range(4000)]


def _sha(b):
    return hashlib.sha256(b).hexdigest()


@pytest.mark.parametrize("ids", ["null", "one"])
def test_suffix_dedup_of_many_texts(spark, ids):
    length, seen = 40, {}
    rows = [(None if ids == "null" else 1, t) for t in _texts()]
    rows += rows[:1] + rows[1:3] * 2
    bytes_ = [t.encode() for _, t in (rows if ids == "null" else dict.fromkeys(rows))]
    for b in bytes_:
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] = seen.get(b[i:i + length], 0) + 1
    want = []
    for d, t in rows:
        b, off = t.encode(), set()
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                off.update(range(i, i + length))
        want.append((d, len(b), len(off), _sha(bytes(x for i, x in enumerate(b) if i not in off))))
    got = suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string"), length)
    assert sorted((tuple(r) for r in got.select("doc_id", "n_bytes", "n_removed", "kept_sha256").collect()), key=repr) == sorted(want, key=repr)


def test_substring_dedup_of_many_texts(spark):
    length = 10
    texts = _texts()
    rows = [(None, t) for t in texts + texts[:1] + texts[1:9] * 2]
    got = [r for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"), length).collect()]
    assert len(got) == len(rows)
    total = {}
    for _, t in rows:
        w = t.split()
        for i in range(len(w) - length + 1):
            total.setdefault(tuple(w[i:i + length]), 0)
    left = {}
    for r in got:
        w = r.kept.split()
        for i in range(len(w) - length + 1):
            left[tuple(w[i:i + length])] = left.get(tuple(w[i:i + length]), 0) + 1
        assert _sha(r.kept.encode()) == r.kept_sha256 and r.n_words - r.n_removed == len(w)
    assert max(left.values()) == 1  # no window stays twice
    assert {x for x in total if all(y[0] == "p" for y in x)} <= set(left)  # and of each passage one stays whole
    words = lambda ts: sorted(w for t in ts for w in t.split())
    assert {w for r in got for w in r.kept.split()} == set(words(texts))  # unique words all stay
    short = [t for t in texts[:9] if len(t.split()) < length]
    assert short and all(sum(r.kept == t for r in got) == sum(u == t for _, u in rows) for t in short)

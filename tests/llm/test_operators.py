"""The operators against brute force on small documents: NULLs, empty and repeated rows, clashing
columns, groups of copies, and hot groups made small by parameters."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from effort_analytics.llm import (fingerprints, license_scan, minhash_dedup, mixing, pseudonyms, sentencepiece_codec,
                                  substring_dedup, suffix_dedup, toxicity, voronoi_topk)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, d int, key string, u string, _q int"


def _corpus():
    rnd = random.Random(5)
    words = [f"w{i}é" if i % 7 == 0 else f"word{i}" for i in range(150)]
    passage = " ".join(rnd.choice(words) for _ in range(45))
    base = [rnd.choice(words) for _ in range(90)]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 80))) for _ in range(12)]
    for i in range(14):
        copy = list(base)
        for _ in range(rnd.randint(0, 9)):
            copy[rnd.randrange(90)] = rnd.choice(words)
        texts.append(" ".join(copy) + ("\n" if i % 2 else " ") + (passage if i % 3 == 0 else ""))
    texts += [passage, passage + " " + passage, "same " * 120, texts[12], texts[12], "a", "", "   \n ", None, "one two"]
    rows = [(i, t, "en", "s", 0, 1, "k", "u", 2) for i, t in enumerate(texts)]
    return rows + [rows[12], (None, passage, None, None, None, None, None, None, None), (3, texts[13], "en", "s", 0, 1, "k", "u", 2)]


ROWS = _corpus()


def _documents():
    """Distinct (doc_id, text) in the operators' order but for rows that share an id."""
    return sorted({(2**63 - 1 if r[0] is None else r[0], r[1] or "") for r in ROWS})


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def _rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 3, "task_rows": 5}, {"hot": 1}])
def test_suffix_dedup(docs, sizes):
    length, seen = 40, {}
    for d, t in _documents():
        b = t.encode()
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] = seen.get(b[i:i + length], 0) + 1
    want = {}
    for d, t in _documents():
        b = t.encode()
        off = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                off[i:i + length] = True
        spans = int((off & ~np.concatenate([[False], off[:-1]])).sum()) if len(b) else 0
        want[d, t] = (len(b), int(off.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~off])).hexdigest())
    got = suffix_dedup.suffix_dedup(docs, length, **sizes)
    ids = sorted(((None if r[0] is None else r[0]), *want[2**63 - 1 if r[0] is None else r[0], r[1] or ""]) for r in ROWS if r[0] is not None)
    assert [r for r in _rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") if r[0] is not None] == sorted(ids, key=repr)
    assert got.count() == len(ROWS)


@pytest.mark.parametrize("sizes", [{}, {"group_rows": 2, "task_rows": 3}, {"group_rows": 0}])
def test_substring_dedup(docs, sizes):
    length, seen, want = 10, set(), {}
    order = sorted({(2**63 - 1 if r[0] is None else r[0], r[1] or "") for r in ROWS if r[0] != 3})
    for d, t in order:
        w = t.split()
        off = [False] * len(w)
        for i in range(len(w) - length + 1):
            key = tuple(w[i:i + length])
            if key in seen:
                off[i:i + length] = [True] * length
            seen.add(key)
        want[d, t] = (len(w), sum(off), hashlib.sha256(" ".join(x for x, o in zip(w, off) if not o).encode()).hexdigest())
    got = substring_dedup.substring_dedup(docs.where("doc_id IS NULL OR doc_id <> 3"), length, **sizes)
    exp = [(r[0], *want[2**63 - 1 if r[0] is None else r[0], r[1] or ""]) for r in ROWS if r[0] != 3]
    assert _rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(exp, key=repr)


@pytest.mark.parametrize("block", [256, 4, 2])
def test_near_duplicates(docs, block, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK", block)
    own = docs.where("doc_id IS NOT NULL AND doc_id <> 3")
    sets = {}
    for d, t in _documents():
        w = t.lower().split()
        sets[d] = {tuple(w[i:i + 2]) for i in range(len(w) - 1)} if len(w) > 1 else {tuple(w)} if w else set()
    ids = sorted(d for d in sets if d != 3 and d != 2**63 - 1)
    group = {d: d for d in ids}
    for _ in ids:
        for a in ids:
            for b in ids:
                o = len(sets[a] & sets[b])
                if o and 100 * o >= 80 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(own, 2).collect()}
    assert got == {(d, len(sets[d]), group[d], group[d] == d) for d in ids}
    assert minhash_dedup.near_duplicates(docs).count() == len(ROWS)


def test_license_scan(spark, docs):
    texts = ["Licensed under the Apache License, Version 2.0.", "Under the MIT License! under the mit license", "SPDX-License-Identifier: GPL-3.0-or-later",
             "GNU Lesser General Public License version 3", "licensed under CC BY-NC 4.0", None, "", "mit der Lizenz"]
    rows = {r.doc_id: r for r in license_scan.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert rows[0].base_labels == "apache-2" and rows[0].labels == "apache-2" and (rows[0].n_base, rows[0].first_word, rows[0].n_words) == (1, 3, 8)
    assert (rows[1].n_base, rows[1].first_word, rows[1].last_word, rows[1].labels) == (2, 0, 4, "mit")
    assert rows[2].labels == "gpl-3" and rows[2].score == 1.0
    assert rows[3].labels == "lgpl-3"  # the title of the GPL within it is suppressed
    assert rows[4].base_labels == "cc-by-nc" and rows[4].labels == "cc-by-nc,cc-by-nc-4"
    assert all((rows[i].labels, rows[i].score, rows[i].n_base, rows[i].first_word) == ("", 0.0, 0, None) for i in (5, 6, 7))
    assert len(license_scan.RULES) > 300 and license_scan.license_scan(docs).count() == len(ROWS)


def test_prefilter_loses_nothing():
    rnd, titles = random.Random(1), ["MIT License", "new bsd license", "GPL v3", "gnu gpl", "Mozilla Public License 2.0", "cc by-sa 3.0", "CC0", "public domain", "in the public domain"]
    rules = license_scan.compiled()
    for _ in range(60):
        text = " ".join(rnd.choice(["licensed under the", "license:", "spdx-license-identifier:", "x", *titles]) for _ in range(6)).lower().encode()
        free = [(r, [], p) for r, _, p in rules]
        assert license_scan.detections(text, rules) == license_scan.detections(text, free)


def test_fingerprints(spark):
    texts = ["a b c\nd e f\ng h", "g h\na b c\nd e f", "x y\n" * 9 + "tail", "", None, "naïve ✓ text", "same\nsame"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for buckets in (1, 3, 16):
        rows = sorted(fingerprints.edited_fingerprints(df, buckets=buckets).collect())
        assert [r.doc_id for r in rows] == list(range(len(texts)))
        for i, r in enumerate(rows):
            t, then = texts[i] or "", texts[(i + 1) % len(texts)] or ""
            k = len(t) // 4
            edited = t[:len(t) - k] + then[:k]
            v = fingerprints.vectors([t.encode(), edited.encode()])
            assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
            assert (r.fingerprint, r.edited_fingerprint) == (v[0].tobytes().hex(), v[1].tobytes().hex())
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert rows[0].fingerprint == rows[1].fingerprint and rows[0].near_next == 1.0  # the order of paragraphs doesn't matter
    a, b, ab = fingerprints.vectors([b"one", b"two three", b"one\ntwo three"])
    assert (a + b == ab).all() and (ab - b == a).all()


def test_top_k(spark):
    rnd = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rnd.normal(size=6)], 0) for i in range(300)] + [(i, [0.5] * 6, 0) for i in range(300, 360)]
    rows += [(400, None, 0), (450, [1.0, None], 0), (500, [float("nan")] * 6, 0), (550, [float("inf")], 0), (None, [1.0] * 6, 0), (600, [9.0], 0), rows[0]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v int")
    ok = {i: np.pad(np.floor(256 * np.array(v)), (0, 6 - len(v))) for i, v, _ in rows if i is not None and i < 400 or i == 600}
    want = []
    for q in (i for i in ok if i % 50 == 0):
        best = sorted((-int(ok[q] @ v), i) for i, v in ok.items() if i != q)[:5]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    for sizes in ({}, {"pivots": 5, "block": 16, "home": 1}):
        assert _rows(voronoi_topk.top_k(df, F.col("vec_id") % 50 == 0, **sizes), "query_id", "rank", "vec_id", "score") == sorted(want, key=repr)
    assert voronoi_topk.top_k(df.where("false"), F.col("vec_id") % 50 == 0).count() == 0


@pytest.fixture(scope="module")
def vocabulary():
    shared = sentencepiece_codec.load()
    return sentencepiece_codec.Vocabulary(**shared), shared["pieces"]


def _whole(text, v, pieces):
    """Viterbi over a whole text at once; spaces are marks, literal marks are bytes."""
    full = " " + text
    known = {p: (i, s) for p, s, i in pieces}
    chars = full.replace("▁", "\0").replace(" ", "▁")
    score, back = [0.0] + [float("-inf")] * len(chars), [None] * (len(chars) + 1)
    for e in range(1, len(chars) + 1):
        for s in range(max(0, e - v.longest), e):
            hit = known.get(chars[s:e])
            if hit and score[s] + hit[1] > score[e]:
                score[e], back[e] = score[s] + hit[1], (s, [hit[0]])
        c = full[e - 1]
        if (t := score[e - 1] + v.low * len(c.encode())) > score[e]:
            score[e], back[e] = t, (e - 1, [v.bytes_[b] for b in c.encode()])
    out, e = [], len(chars)
    while e:
        e, ids = back[e]
        out = ids + out
    return out if text else []


def test_sentencepiece(spark, docs, vocabulary):
    v, pieces = vocabulary
    rnd = random.Random(4)
    texts = ["", "▁ a▁b", "  two  spaces\n\nlines\t", "日本語", *("".join(rnd.choice("abdeinorst,.é▁日 \n") for _ in range(rnd.randint(1, 90))) for _ in range(40))]
    for t in texts:
        ids = sentencepiece_codec.encode(t, v).tolist()
        assert ids == _whole(t, v, pieces) and sentencepiece_codec.decode(ids, v) == t
    long = "the" * 5000  # no place where all paths must meet
    coder = sentencepiece_codec.StreamingViterbi(v)
    ids = [i for k in range(0, len(long), 700) for i in coder.push(long[k:k + 700])] + coder.finish()
    assert b"".join(v.text[i] for i in ids).decode() == long and coder.widest < 200
    got = sentencepiece_codec.encode_documents(docs)
    assert got.count() == len(ROWS) and got.where("NOT exact").count() == 0


def test_pseudonyms(spark, docs):
    n = 189 * 773
    x = spark.range(n).select(pseudonyms.feistel(F.col("id"), 189, 773, "k", "date").alias("x"))
    assert x.distinct().count() == n and tuple(x.agg(F.min("x"), F.max("x")).first()) == (0, n - 1)
    text = "card 4111 1111 1111 1111, 4111111111111112; 2024-02-29 2023-02-30 tel +1 (414) 555-7134, a.b@x.org 10.0.0.1 999.1.1.1 ssn 123-45-6789"
    df = spark.createDataFrame([(1, text, 7), (2, "again 4111 1111 1111 1111", 7), (3, None, 7), (4, "", 7), (5, text, 7)], "doc_id long, text string, pii_found int")
    rows = {r.doc_id: r for r in pseudonyms.pseudonymise(df).collect()}
    one = rows[1].text
    assert rows[1].pii_found == 6 and rows[1].pii_kinds == "card,date,email,ip,phone,ssn" and rows[5].text == one
    for gone in ("4111 1111 1111 1111", "2024-02-29", "(414) 555-7134", "a.b@x.org", "10.0.0.1", "123-45-6789"):
        assert gone not in one
    for kept in ("4111111111111112", "2023-02-30", "999.1.1.1", "@x.org"):
        assert kept in one
    card = re.search(r"card (\d{4} \d{4} \d{4} \d{4})", one)[1]
    assert rows[2].text == "again " + card  # equal values stay linked
    digits = [int(c) for c in card.replace(" ", "")][::-1]
    assert sum(digits[::2]) + sum(sum(divmod(2 * c, 10)) for c in digits[1::2]) in range(0, 200, 10)
    assert (rows[3].text, rows[3].pii_found, rows[4].text) == (None, 0, "")
    assert pseudonyms.pseudonymise(docs).columns[:len(docs.columns)] == docs.columns


def test_mixing(spark):
    rnd = random.Random(9)
    rows = [(i, " ".join(["word"] * rnd.randint(1, 40)) + rnd.choice(["", " licence", " a@b"]), rnd.choice(["en", "de", None]), "big" if i % 3 else f"s{i % 4}") for i in range(400)]
    rows += [(400, None, "en", "big"), (401, "", "xx", "none"), rows[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.calibrated(df, keep=0.8, power=0.5)
    out = got.collect()
    assert len(out) == len(rows) and all(0 <= r._probability <= 1 <= r._weight for r in out)
    tokens = sum(r._tokens for r in out)
    for name in ("_source", "_lang", "_topic"):
        sums = {}
        for r in out:
            sums.setdefault(r[name], [0, 0.0])
            sums[r[name]][0] += r._tokens
            sums[r[name]][1] += r._tokens * r._probability * r._weight
        share = {k: s**0.5 for k, (s, _) in sums.items() if s}
        for k, x in share.items():
            assert abs(sums[k][1] / (0.8 * tokens) - x / sum(share.values())) < 1e-4
    again = mixing.calibrated(df, keep=0.8, power=0.5).collect()
    assert sorted((r.doc_id, r._kept) for r in again) == sorted((r.doc_id, r._kept) for r in out)
    assert mixing.calibrated(df.where("false")).count() == 0


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    extra = spark.createDataFrame([(None, None, "en", "s", 0), (10**9, "", "en", "s", 0)], docs.schema)
    out = toxicity.score_documents(docs.unionByName(extra), labels)
    assert out.count() == docs.count() + 2 and out.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    held = out.where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    right = sum(r.predicted == r.toxic for r in held) / len(held)
    assert right >= 0.95
    none = toxicity.score_documents(docs.limit(20), labels.where("false"))
    assert none.where("predicted = 1").count() == 0


def test_empty_tables(docs):
    none = docs.where("false")
    for f in (suffix_dedup.suffix_dedup, substring_dedup.substring_dedup, minhash_dedup.near_duplicates, license_scan.license_scan,
              fingerprints.edited_fingerprints, sentencepiece_codec.encode_documents, pseudonyms.pseudonymise):
        assert f(none).count() == 0

"""License scans against a plain version: every rule on every text, phrases word by word, suppression by
comparing all pairs; and texts of many lines or much white space in about linear time."""

import random
import re
import time

from effort_analytics.llm import license_scan as L

LINES = ["Licensed under the Apache License, Version 2.0", "under the MIT License", "SPDX-License-Identifier: GPL-3.0-or-later", "GNU Lesser General Public License version 2.1",
         "license: BSD-3-Clause", "GNU General Public License", "Affero General Public License v3", "cc by nc", "CC BY-NC-SA 4.0", "Mozilla Public\n License", "under the mit", "2", "3",
         "Apache License\tVersion 2", "Creative Commons Attribution 3.0", "released under the terms of the GPL v2", "LGPL 3", "all rights reserved", "naïve ✓", "plain words", "zlib\n\nlicense"]


def _plain(text):
    """n_words, n_base, first, last, base labels, labels, score of a text."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    base = [(i, label) for i in range(len(words)) for p, label in L.BASE.items() if tuple(words[i:i + len(p)]) == p]
    found = [(m.start(), m.end(), r) for r in L.RULES for m in re.finditer(r.pattern.encode(), low.encode())]
    found.sort(key=lambda x: (-x[2].priority, x[0] - x[1], x[0], x[2].label))
    kept = []
    for s, e, r in found:
        if not any(a <= s and e <= b for a, b, _ in kept):
            kept.append((s, e, r))
    own = {label for _, label in base}
    places = [i for i, _ in base]
    return (len(words), len(base), min(places, default=None), max(places, default=None), ",".join(sorted(own)), ",".join(sorted(own | {r.label for _, _, r in kept})),
            max([0.9 if base else 0.0, *(min(r.priority, 100) / 100 for _, _, r in kept)]), sorted((s, e, r.label, r.form) for s, e, r in kept))


def test_against_plain_version(spark):
    rnd = random.Random(6)
    texts = ["", None, " ", *(rnd.choice([" ", "\n", ", "]).join(rnd.choice(LINES) for _ in range(rnd.randint(1, 14))) for _ in range(150))]
    rows = list(enumerate(texts)) + [(None, texts[5]), (7, texts[7])]
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score, [tuple(s) for s in r.spans])
           for r in L.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    want = [(i, *_plain(t or "")) for i, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_possessive_white_space_loses_nothing():
    rnd = random.Random(7)
    for _ in range(150):
        text = rnd.choice([" ", "\n", "  "]).join(rnd.choice(LINES) for _ in range(8)).lower().encode()
        for r, _, pattern in L.compiled():
            assert [m.span() for m in re.finditer(r.pattern.encode(), text)] == [m.span() for m in pattern.finditer(text)], r


def _seconds(text):
    rules, start = L.compiled(), time.perf_counter()
    found = L.detections(text.encode(), rules)
    return time.perf_counter() - start, len(found)


def test_long_texts_in_linear_time():
    line = "licensed under the mit license\n"
    _seconds(line)
    (small, n), (large, m) = _seconds(line * 2_000), _seconds(line * 20_000)
    assert (n, m) == (2_000, 20_000) and large < 30 * small + 1
    for text in ("apache" + " " * 10**6 + "x", "license" + " " * 10**6 + "x", "licensed under " + " " * 10**6, "cc by " * 50_000, "gnu " * 100_000):
        assert _seconds(text)[0] < 20

"""Filter audit against documents led through every order one by one."""

import re
from itertools import permutations

from effort_analytics.llm import filter_audit

DOCS = "doc_id long, text string, source string, n int, part string, mask int, h string, d int"
LABELS = "doc_id long, quality int, toxic int, text string"
LONG = " ".join(f"w{i}" for i in range(210))


def _rows():
    texts = [LONG, LONG, LONG + " A&B", "A" * 60 + " " + LONG, "word " * 250, "word " * 250, "", None, "   \t\n", "a | b", "é " * 300, LONG.upper(), "one", "one"]
    rows = [(i, t, ["s", "t", None, ""][i % 4], 1, "p", 2, "h", 3) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (0, LONG, "t", 1, "p", 2, "h", 3), (0, "one", "s", 1, "p", 2, "h", 3), (None, LONG, "s", 1, "p", 2, "h", 3), (None, LONG, "s", 1, "p", 2, "h", 3),
             (None, "only here", "u", 1, "p", 2, "h", 3)]
    labels = [(0, 1, 0, "x"), (1, 1, 1, "x"), (1, 0, None, "x"), (3, None, 1, "x"), (4, 1, 0, "x"), (7, 0, 1, "x"), (None, 1, 1, "x"), (99, 1, 1, "x"), (12, 1, 1, "x"), (12, 1, 1, "x")]
    return rows, labels


def _brute(rows, labels):
    least = {}
    for r in rows:
        if r[0] is not None:
            least[r[1] or ""] = min(least.get(r[1] or "", r[0]), r[0])
    good = {x[0] for x in labels if x[1] == 1 and x[0] is not None}
    toxic = {x[0] for x in labels if x[2] == 1 and x[0] is not None}
    docs = []
    for r in rows:
        t = r[1] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 "D": any(c in t for c in "#$%&*|"), "E": r[0] is not None and r[0] > least[t]}
        docs.append((r[2] or "", {f for f in fails if fails[f]}, r[0] in good, r[0] in toxic))
    out, shapley = {}, {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for i, f in enumerate(order):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                failing = [d for d in own if f in d[1]]
                out[part, "".join(order), i + 1] = (len(left), len(gone), len(failing) - len(gone), sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone))
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
    return sorted((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def test_every_order_and_step(spark):
    rows, labels = _rows()
    got = filter_audit.audit(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(tuple(r) for r in got.collect()) == _brute(rows, labels)


def test_empty_tables(spark):
    rows, labels = _rows()
    none = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(spark.createDataFrame([], DOCS), spark.createDataFrame(labels, LABELS)).count() == 0
    got = filter_audit.audit(spark.createDataFrame(rows, DOCS), none)
    assert sorted(tuple(r) for r in got.collect()) == _brute(rows, [])


def test_very_long_text(spark):
    text = "word " * 400_000 + "A" * 100_000
    got = filter_audit.audit(spark.createDataFrame([(1, text, "s", 1, "p", 2, "h", 3)], DOCS), spark.createDataFrame([], LABELS))
    assert {r.removed for r in got.where("filter_order = 'ABCDE'").collect()} == {0, 1}


def test_potential_is_the_mean_over_orders(spark):
    """The potential's differences against the plain average of marginals, on a game of its own."""
    counts = spark.createDataFrame([("s", m, 0, 0, (m * 37) % 11) for m in range(32)], "part string, mask int, good int, toxic int, n long")
    row = filter_audit.potentials(filter_audit.games(counts)).first()
    n = {m: (m * 37) % 11 for m in range(32)}
    for i in range(5):
        total = 0
        for order in permutations(range(5)):
            before = sum(1 << j for j in order[:order.index(i)])
            total += sum(n[m] for m in n if m >> i & 1 and not m & before)
        assert row.p[31] - row.p[31 & ~(1 << i)] == total

"""Substring dedup (7): words of passages that stand earlier, from prefix-partitioned suffix trees.

The windows of ``length`` words that may repeat at all come from ``_repeats``: suffixes that can't
share ``length`` words with another never leave their task. The others are split by prefixes of
variable length: by the shortest of ``PREFIXES`` that no more than ``group_rows`` of them share.
Each group's subtree is built in one task: suffixes in order by prefix doubling, the common
prefixes of neighbours, and from these the internal nodes of depth ``length``. A node's leaves are
the places of one repeated window; all but the earliest are marked. Groups that even the longest
prefix can't make small are settled by window hashes in partial aggregates, exactly.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _repeats as P
from . import _rolling as R
from ._common import batch_of, byte_rows, keyed, staged, table
from .suffix_dedup import window_hashes

#: Words of the prefixes that split the suffixes, from the anchor on; equal windows share them all.
PREFIXES = (1, 2, 4, 6)
IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_MARKS = pa.schema([("d", pa.int64()), ("h", pa.int64()), ("s", pa.int32()), ("e", pa.int32())])


def _word_values(data: np.ndarray, at: np.ndarray):
    starts, ends, before = R.words(data, at, IS_WORD)
    return R.word_hashes(data, starts, ends), before


def word_windows(length: int) -> P.Windows:
    if not PREFIXES[-1] < length <= 100:
        raise ValueError("length must be 7 to 100 words")
    return P.Windows(length, length - PREFIXES[-1] + 1, PREFIXES[-1], _word_values)


def _cut(win: P.Windows):
    """Unsettled anchors with the hashed words of their windows and of their prefixes."""
    schema = pa.schema([("d", pa.int64()), ("h", pa.int64()), ("p", pa.int64()), *((f"p{k}", pa.int64()) for k in PREFIXES), ("words", pa.binary())])

    def run(batches):
        for batch in batches:
            d, h = batch.column("d").to_numpy(), batch.column("h").to_numpy()
            data, at = byte_rows(batch.column("text"))
            for r, ps in enumerate(batch.column("ps")):
                values, _ = win.units(data[at[r]:at[r + 1]], np.array([0, at[r + 1] - at[r]]))
                ps = ps.values.to_numpy()
                a, lo, hi = P.unpack(ps)
                roll = R.Rolling(values)
                cut = [values[s:e + win.length].tobytes() for s, e in zip(lo, hi, strict=True)]
                yield batch_of(schema, d=np.repeat(d[r], len(ps)), h=np.repeat(h[r], len(ps)), p=ps, words=pa.array(cut, pa.binary()),
                               **{f"p{k}": roll.hash(a, a + k).view(np.int64) for k in PREFIXES})
    return run


def partitioned(rows: DataFrame, group_rows: int) -> DataFrame:
    """``rows`` with ``g``: the hash of the shortest prefix that at most ``group_rows`` rows share,
    NULL where even the longest is shared by more. The tables of frequent prefixes are written
    first, so that Spark knows their sizes when it plans the joins."""
    out, g, left = rows, F.lit(None).cast("long"), rows.select(*(f"p{k}" for k in PREFIXES))
    for k in PREFIXES:
        often = staged(left.groupBy(f"p{k}").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group_rows)
                       .select(f"p{k}", F.lit(True).alias(f"often{k}")), "prefixes")
        out = out.join(often, f"p{k}", "left")
        g = F.when(g.isNotNull(), g) if k != PREFIXES[0] else g
        g = F.coalesce(g, F.when(F.col(f"often{k}").isNull(), F.xxhash64(F.lit(k), f"p{k}")))
        if often.isEmpty():
            break
        left = left.join(often, f"p{k}", "left_semi")
    return out.select("d", "h", "p", "words", g.alias("g"))


def suffix_order(values: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes of ``values`` at ``starts`` by their first ``length`` words (by prefix
    doubling), and the common prefix, in words, of each with the one before it in that order."""
    ranks = {1: np.unique(values, return_inverse=True)[1].astype(np.int64)}
    n, k = len(values), 1
    while 2 * k <= length:
        r = ranks[k]
        pair = np.zeros(n, np.int64)
        pair[:n - k] = (r[:n - k] << 32) | (r[k:] + 1)
        ranks[2 * k] = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        k *= 2
    whole, done = ranks[k][starts], k
    for k in sorted(ranks, reverse=True):
        if done + k <= length:
            whole = np.unique((whole << 32) | ranks[k][starts + done], return_inverse=True)[1].astype(np.int64)
            done += k
    order = np.argsort(whole, kind="stable")
    rows = ranks[1][starts[order][:, None] + np.arange(length)]
    differ = rows[1:] != rows[:-1]
    lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    return order, np.concatenate([[0], lcp]).astype(np.int64)


def deep_nodes(lcp: np.ndarray, depth: int) -> np.ndarray:
    """Which internal node of at least this depth each leaf hangs under (else one of its own)."""
    return np.cumsum(lcp < depth)


def _solve(win: P.Windows, task_rows: int):
    length = win.length

    def run(batches):
        for t in P.whole_groups(batches, "g", task_rows):
            d, h, p = (t.column(c).to_numpy() for c in "dhp")
            new = np.ones(len(d), bool)  # a repeated row is one document
            new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1]) | (p[1:] != p[:-1])
            data, at = byte_rows(t.column("words"))
            values = np.frombuffer(data[at[0]:at[-1]].tobytes(), np.uint64)
            _, lo, hi = P.unpack(p)
            base = (at[:-1] - at[0]) // 8
            r = np.repeat(np.arange(len(d)), np.where(new, hi - lo + 1, 0))
            off = np.arange(len(r)) - np.searchsorted(r, r)
            order, lcp = suffix_order(values, base[r] + off, length)
            node, r, i = deep_nodes(lcp, length), r[order], (lo[r] + off)[order]
            by = np.lexsort((i, h[r], d[r], node))
            node, r, i = node[by], r[by], i[by]
            later = np.flatnonzero(np.concatenate([[False], node[1:] == node[:-1]]))
            r, i = r[later], i[later]
            by = np.lexsort((i, r))
            row, s, e = P.ranges(r[by], i[by], length)
            if len(row):
                yield batch_of(_MARKS, d=d[row], h=h[row], s=s.astype(np.int32), e=e.astype(np.int32))
    return run


def later_spans(docs: DataFrame, length: int = 20, *, group_rows: int = 20_000, task_rows: int = 20_000) -> DataFrame:
    """(d, h, s, e): word ranges of windows of ``length`` words that also start earlier. ``docs`` is
    :func:`_common.keyed`. Ranges of one document may overlap."""
    win = word_windows(length)
    cand = P.candidates(docs, win)
    marks = P.settled(cand, win, "NOT first")
    kinds = ", ".join(f"p{k} long" for k in PREFIXES)
    rows = partitioned(staged(P.regions(cand, docs, _cut(win), f"d long, h long, p long, {kinds}, words binary"), "suffixes"), group_rows)
    marks = marks.unionByName(rows.where("g IS NOT NULL").repartition("g").sortWithinPartitions("g", "d", "h", "p")
                              .mapInArrow(_solve(win, task_rows), "d long, h long, s int, e int"))
    hot = rows.where("g IS NULL").select("d", "h", "p").distinct()
    if not hot.isEmpty():
        ps = hot.groupBy("d", "h").agg(F.collect_list("p").alias("ps"))
        each = docs.select("d", "h", "text").join(ps, ["d", "h"]).mapInArrow(window_hashes(win), "d long, h long, i int, x long, y long")
        later = P.windows_hash_marks(each, True)
        marks = marks.unionByName(later.select("d", "h", F.col("i").alias("s"), (F.col("i") + length).alias("e")))
    return marks


def _digest(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])
    for batch in batches:
        data, at = byte_rows(batch.column("text"))
        out = {f.name: [] for f in schema if f.name != "doc_id"}
        for r, (ss, es) in enumerate(zip(batch.column("ss"), batch.column("es"), strict=True)):
            words = data[at[r]:at[r + 1]].tobytes().split()
            n = len(words)
            if ss.is_valid:
                off = P.covered(n, ss.values.to_numpy(), es.values.to_numpy())
                words = [w for w, gone in zip(words, off.tolist(), strict=True) if not gone]
            kept = b" ".join(words)
            for k, v in (("n_words", n), ("n_removed", n - len(words)), ("kept_sha256", hashlib.sha256(kept).hexdigest()), ("kept", kept.decode())):
                out[k].append(v)
        yield batch_of(schema, doc_id=batch.column("doc_id"), **out)


def substring_dedup(docs: DataFrame, length: int = 20, *, id_col: str = "doc_id", text_col: str = "text", **sizes) -> DataFrame:
    """One row a document: doc_id, n_words, n_removed, kept_sha256 and ``kept``, the words left,
    joined by spaces. A word goes if a window of ``length`` words that covers it also starts
    earlier: in a document with a smaller id, or further left in the same one.

    NULL and empty texts have no words. A row that repeats id and text counts as the same document;
    of different texts with one id the order is that of their hashes. NULL ids come last, and each
    row without an id is a document of its own: of equal ones, one is the earliest. Other columns
    are left out.
    """
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    rows = keyed(docs, id_col, text_col)
    marks = P.gathered(later_spans(rows, length, **sizes))
    # Rows without an id as one row of each text, and the number of its copies.
    alone = rows.where("doc_id IS NULL").groupBy("d", "h").agg(F.min("text").alias("text"), F.count(F.lit(1)).alias("n"))
    own = rows.where("doc_id IS NOT NULL").unionByName(alone.select("d", "h", F.lit(None).cast("long").alias("doc_id"), "text"))
    words = F.regexp_count("text", F.lit(r"[^\x09-\x0D\x20]+"))
    whole = lambda x: F.when(words >= length, F.array(x.cast("int")))
    copies = alone.where("n > 1").select(F.col("n").alias("doc_id"), "text", whole(F.lit(0)).alias("ss"), whole(words).alias("es"))
    copies = copies.mapInArrow(_digest, schema).withColumn("doc_id", F.explode(F.sequence(F.lit(2).cast("long"), "doc_id")))
    return own.join(marks, ["d", "h"], "left").select("doc_id", "text", "ss", "es").mapInArrow(_digest, schema).unionByName(
        copies.withColumn("doc_id", F.lit(None).cast("long")))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).drop("kept")

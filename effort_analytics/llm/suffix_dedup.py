"""Suffix-array dedup (6): bytes of substrings that occur elsewhere, from merged shard BWTs.

Equal windows of ``length`` bytes pick the same anchor by their content (``_repeats``), so only
the surroundings of anchors with a common key need sorting, and they can be sorted aligned at the
anchor. A task holds the surroundings of whole keys as rows of equal width and cuts them in shards.

* Each shard's Burrows-Wheeler transform is built column by column: ``bwt[c]`` lists the symbols
  in column ``c`` in the order of the shard's suffixes that start one column later.
* The shards are merged from the transforms alone by interleave refinement: ``z`` says from which
  shard each suffix of the merged order comes; a column's symbols, dealt out by ``z``, refine it by
  one stable counting sort. No suffix is compared or sorted again.
* The common prefix of neighbours follows from the refinement: neighbours with equal new symbols
  keep the smallest extent of those that stood between them before, others end here.
* Where the extent of neighbours reaches ``length`` bytes, the windows are a repeated interval.

Anchors whose whole surroundings are equal were settled before by a count. Keys with more than
``hot`` different surroundings are settled by window hashes in partial aggregates instead, exactly.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _repeats as P
from . import _rolling as R
from ._common import batch_of, byte_rows, keyed, table

#: Stands left and right of a row's own bytes; no byte of UTF-8.
_PAD = 0xFF
_GRAM = 16
_MARKS = pa.schema([("d", pa.int64()), ("h", pa.int64()), ("s", pa.int32()), ("e", pa.int32())])


def byte_windows(length: int) -> P.Windows:
    if not 2 * _GRAM <= length <= 254:
        raise ValueError("length must be 32 to 254 bytes")
    return P.Windows(length, length // 2, _GRAM, lambda data, at: (R.BYTE_VALUES[data], at))


def shard_bwt(rows: np.ndarray) -> np.ndarray:
    """Column-wise Burrows-Wheeler transform of rows of equal width: ``out[c]`` has the symbols of
    column ``c`` in the order of the suffixes from column ``c + 1``."""
    m, width = rows.shape
    columns = np.ascontiguousarray(rows.T)
    out, order = np.empty((width, m), np.uint8), np.arange(m)
    for c in range(width - 1, -1, -1):
        out[c] = columns[c][order]
        order = order[np.argsort(out[c], kind="stable")]
    return out


def _refined(extent: np.ndarray, symbols: np.ndarray, c: int) -> tuple[np.ndarray, np.ndarray]:
    """One refinement: the stable order by the symbols of column ``c``, and the column at which
    each suffix of that order stops agreeing with the one before it."""
    order = np.argsort(symbols, kind="stable")
    sorted_ = symbols[order]
    same = np.flatnonzero(sorted_[1:] == sorted_[:-1])
    out = np.full(len(order), c, extent.dtype)
    if len(same):
        between = np.empty(2 * len(same), np.int64)
        between[0::2] = order[same] + 1
        between[1::2] = order[same + 1] + 1
        out[same + 1] = np.minimum.reduceat(np.append(extent, 0), between)[0::2]
    return order, out


def merged(shards: list[np.ndarray]):
    """Merge shard transforms; yields (column, rows in merged order, extents) from the last column
    to the first. Rows are numbered through the shards."""
    sizes = [s.shape[1] for s in shards]
    width, m = shards[0].shape[0], sum(sizes)
    z = np.repeat(np.arange(len(shards), dtype=np.uint16), sizes)
    ids, extent = np.arange(m), np.full(m, width, np.int16)
    symbols = np.empty(m, np.uint8)
    for c in range(width - 1, -1, -1):
        dealt = np.argsort(z, kind="stable") if len(shards) > 1 else slice(None)
        symbols[dealt] = np.concatenate([s[c] for s in shards]) if len(shards) > 1 else shards[0][c]
        order, extent = _refined(extent, symbols, c)
        z, ids = z[order], ids[order]
        yield c, ids, extent


def repeated(rows: np.ndarray, ok_from: np.ndarray, ok_to: np.ndarray, anchor: int, length: int,
             shard_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, offset) of the windows that start ``offset`` bytes before the anchor column, with
    ``ok_from <= offset <= ok_to`` of their row, and whose bytes also stand in another row."""
    shards = [shard_bwt(rows[i:i + shard_rows]) for i in range(0, len(rows), shard_rows)]
    found = []
    for c, ids, extent in merged(shards):
        if c > anchor:
            continue
        with_before = extent >= c + length
        hit = with_before.copy()
        hit[:-1] |= with_before[1:]
        r = ids[hit]
        o = anchor - c
        r = r[(ok_from[r] <= o) & (o <= ok_to[r])]
        if len(r):
            found.append((r, np.full(len(r), o)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _cut(win: P.Windows, hot: int):
    """Rows of the unsettled anchors: their bytes, or for hot keys the hashes of their windows."""
    region = pa.schema([("d", pa.int64()), ("h", pa.int64()), ("p", pa.int64()), ("key", pa.int64()), ("bytes", pa.binary())])

    def run(batches):
        for batch in batches:
            d, h = batch.column("d").to_numpy(), batch.column("h").to_numpy()
            data, at = byte_rows(batch.column("text"))
            for r, (ps, keys) in enumerate(zip(batch.column("ps"), batch.column("keys"), strict=True)):
                ps = np.asarray(ps.values.to_numpy())
                _, lo, hi = P.unpack(ps)
                base, view = at[r], data
                cut = [view[base + s:base + e + win.length].tobytes() for s, e in zip(lo, hi, strict=True)]
                yield batch_of(region, d=np.repeat(d[r], len(ps)), h=np.repeat(h[r], len(ps)), p=ps, key=keys.values, bytes=pa.array(cut, pa.binary()))
    return run


def _solve(win: P.Windows, shard_rows: int, task_rows: int):
    anchor, width = win.w - 1, win.w - 1 + win.length

    def run(batches):
        for t in P.whole_groups(batches, "key", task_rows):
            d, h, p = (t.column(c).to_numpy() for c in "dhp")
            new = np.ones(len(d), bool)  # a repeated row is one document
            new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1]) | (p[1:] != p[:-1])
            data, at = byte_rows(t.column("bytes"))
            a, lo, hi = P.unpack(p)
            rows = np.full((len(d), width), _PAD, np.uint8)
            size = np.diff(at)
            row = np.repeat(np.arange(len(d)), size)
            rows[row, np.arange(at[0], at[-1]) - np.repeat(at[:-1], size) + np.repeat(anchor - (a - lo), size)] = data[at[0]:at[-1]]
            keep = np.flatnonzero(new)
            r, o = repeated(rows[keep], (a - hi)[keep], (a - lo)[keep], anchor, win.length, shard_rows)
            r = keep[r]
            by = np.lexsort((-o, r))
            r, o = r[by], o[by]
            row, s, e = P.ranges(r, a[r] - o, win.length)
            if len(row):
                yield batch_of(_MARKS, d=d[row], h=h[row], s=s.astype(np.int32), e=e.astype(np.int32))
    return run


def window_hashes(win: P.Windows):
    """(d, h, i, x, y): two 64-bit hashes of each window of the regions."""
    schema = pa.schema([("d", pa.int64()), ("h", pa.int64()), ("i", pa.int32()), ("x", pa.int64()), ("y", pa.int64())])

    def run(batches):
        for batch in batches:
            d, h = batch.column("d").to_numpy(), batch.column("h").to_numpy()
            data, at = byte_rows(batch.column("text"))
            for r, ps in enumerate(batch.column("ps")):
                values, _ = win.units(data[at[r]:at[r + 1]], np.array([0, at[r + 1] - at[r]]))
                one, two = R.Rolling(values), R.Rolling(R.mix(values))
                _, lo, hi = P.unpack(ps.values.to_numpy())
                i = np.unique(np.concatenate([np.arange(s, e + 1) for s, e in zip(lo, hi, strict=True)]))
                yield batch_of(schema, d=np.repeat(d[r], len(i)), h=np.repeat(h[r], len(i)), i=i.astype(np.int32),
                               x=one.hash(i, i + win.length).view(np.int64), y=two.hash(i, i + win.length).view(np.int64))
    return run


def repeated_spans(docs: DataFrame, length: int = 200, *, shard_rows: int = 8192, task_rows: int = 32768,
                   hot: int = 100_000) -> DataFrame:
    """(d, h, s, e): byte ranges of windows of ``length`` bytes that start at more than one place.
    ``docs`` is :func:`_common.keyed`. Ranges of one document may overlap."""
    win = byte_windows(length)
    cand = P.candidates(docs, win)
    marks = P.settled(cand, win, "many")
    cut = P.regions(cand.where(F.col("kinds") <= hot), docs, _cut(win, hot), "d long, h long, p long, key long, bytes binary")
    marks = marks.unionByName(cut.repartition("key").sortWithinPartitions("key", "d", "h", "p")
                              .mapInArrow(_solve(win, shard_rows, task_rows), "d long, h long, s int, e int"))
    if not cand.where(F.col("kinds") > hot).isEmpty():
        each = P.regions(cand.where(F.col("kinds") > hot), docs, window_hashes(win), "d long, h long, i int, x long, y long")
        marks = marks.unionByName(P.windows_hash_marks(each, False).select("d", "h", F.col("i").alias("s"), (F.col("i") + length).alias("e")))
    return marks


def _digest(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("kept_sha256", pa.string()), ("kept", pa.binary())])
    for batch in batches:
        data, at = byte_rows(batch.column("text"))
        out = {f.name: [] for f in schema if f.name != "doc_id"}
        for r, (ss, es) in enumerate(zip(batch.column("ss"), batch.column("es"), strict=True)):
            own, gone, spans = data[at[r]:at[r + 1]], 0, 0
            if ss.is_valid:
                off = P.covered(len(own), ss.values.to_numpy(), es.values.to_numpy())
                gone, spans = int(off.sum()), int(off[0]) + int((off[1:] & ~off[:-1]).sum())
                kept = own[~off].tobytes()
            else:
                kept = own.tobytes()
            for k, v in (("n_bytes", len(own)), ("n_removed", gone), ("n_spans", spans), ("kept_sha256", hashlib.sha256(kept).hexdigest()), ("kept", kept)):
                out[k].append(v)
        yield batch_of(schema, doc_id=batch.column("doc_id"), **out)


def suffix_dedup(docs: DataFrame, length: int = 200, *, id_col: str = "doc_id", text_col: str = "text", **sizes) -> DataFrame:
    """One row a document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and ``kept``, the bytes
    left (not always UTF-8). A byte goes if any window of ``length`` bytes that covers it also
    starts elsewhere, in the same document or another.

    NULL and empty texts have no bytes. A row that repeats id and text counts as the same document,
    so it doesn't by itself make its text repeated; each row without an id is a document of its own.
    Other columns are left out.
    """
    rows = keyed(docs, id_col, text_col)
    alike = rows.where("doc_id IS NULL").groupBy("d", "h", F.octet_length("text").alias("e")).count().where((F.col("count") > 1) & (F.col("e") >= length))
    marks = P.gathered(repeated_spans(rows, length, **sizes).unionByName(alike.select("d", "h", F.lit(0).alias("s"), "e")))
    return rows.join(marks, ["d", "h"], "left").select("doc_id", "text", "ss", "es").mapInArrow(
        _digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents")).drop("kept")

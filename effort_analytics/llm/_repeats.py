"""Repeated windows, first part: which windows of which documents may repeat at all.

Every window of ``length`` units picks an anchor by its own content (``_rolling.anchors``), so two
equal windows have anchors with equal ``key`` and the same offset. The steps, all Spark shuffles:

1. anchors of all documents; keys that occur once leave (a semi join);
2. anchors with equal ``full`` have equal windows throughout: they are settled by a count and the
   earliest occurrence, with map-side partial aggregates, so a group of copies of any size costs no
   task more than its share;
3. only where one key has several different surroundings, the earliest occurrence of each goes on
   to the operator's own method, as a region of the text (``regions``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _rolling as R
from ._common import batch_of, slices, staged

_ANCHORS = pa.schema([("d", pa.int64()), ("h", pa.int64()), ("p", pa.int64()), ("key", pa.int64()), ("full", pa.int64())])


@dataclass(frozen=True)
class Windows:
    """``length``: units of a window; ``w``, ``gram``: of the anchors; ``units(data, at)``: the
    sequence of 64-bit values of a slice of texts and the documents' offsets in it."""
    length: int
    w: int
    gram: int
    units: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


# p packs the anchor and the two distances into one number that sorts by anchor.
def pack(a, lo, hi):
    return (a << 14) | ((a - lo) << 7) | (hi - lo)


def unpack(p):
    a = p >> 14
    lo = a - ((p >> 7) & 127)
    return a, lo, lo + (p & 127)


def _find(win: Windows):
    def run(batches):
        for batch in batches:
            d, h = batch.column("d").to_numpy(), batch.column("h").to_numpy()
            for i, _, data, at in slices(batch.column("text")):
                x = R.anchors(*win.units(data, at), win.length, win.w, win.gram)
                if len(x["doc"]):
                    row = x["doc"] + i
                    yield batch_of(_ANCHORS, d=d[row], h=h[row], p=pack(x["a"], x["lo"], x["hi"]), key=x["key"], full=x["full"])
    return run


def candidates(docs: DataFrame, win: Windows) -> DataFrame:
    """(d, h, p, key, first, many, kinds) of every anchor whose key occurs elsewhere: whether it is
    the earliest with its surroundings, whether these occur at another place, and the number of
    different surroundings of the key. ``docs`` is :func:`_common.keyed`. Staged."""
    found = docs.select("d", "h", "text").mapInArrow(_find(win), "d long, h long, p long, key long, full long")
    place = F.struct("d", "h", "p")
    # Tables to join with are written first: Spark can split a hot key in a join of two scans, but
    # not where one side is still being aggregated.
    shared = staged(found.groupBy("key").count().where("count > 1").select("key"), "keys")
    found = staged(found.join(shared, "key", "left_semi"), "anchors")
    same = found.groupBy("key", "full").agg(F.min(place).alias("x"), F.max(place).alias("y"))
    kinds = same.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"))
    same = staged(same.join(kinds, "key").select("key", "full", "x", (F.col("x") != F.col("y")).alias("many"), "kinds"), "surroundings")
    out = found.join(same, ["key", "full"]).select("d", "h", "p", "key", (place == F.col("x")).alias("first"), "many", "kinds")
    return staged(out, "candidates")


def settled(cand: DataFrame, win: Windows, which) -> DataFrame:
    """(d, h, s, e) unit ranges of the windows of the candidates ``which``."""
    a, lo = F.shiftright("p", 14), F.shiftright("p", 7).bitwiseAND(127)
    return cand.where(which).select("d", "h", (a - lo).cast("int").alias("s"),
                                    (a - lo + F.col("p").bitwiseAND(127) + win.length).cast("int").alias("e"))


def regions(cand: DataFrame, docs: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over the documents (d, h, text, ps, keys) with unsettled anchors."""
    todo = cand.where("first AND kinds > 1").groupBy("d", "h").agg(
        F.collect_set(F.struct("p", "key")).alias("x")).select("d", "h", F.col("x.p").alias("ps"), F.col("x.key").alias("keys"))
    return docs.select("d", "h", "text").join(todo, ["d", "h"]).mapInArrow(run, schema)


def windows_hash_marks(hot: DataFrame, earliest: bool) -> DataFrame:
    """(d, h, i) of the repeated windows among rows (d, h, i, x, y): start and 128-bit hash of each
    window. With ``earliest`` the first occurrence is left out. For keys with too many different
    surroundings for one task: partial aggregates and a join that Spark can split."""
    place = F.struct("d", "h", "i")
    same = hot.groupBy("x", "y").agg(F.min(place).alias("u"), F.max(place).alias("v")).where("u <> v")
    out = hot.join(same, ["x", "y"])
    return (out.where(place != F.col("u")) if earliest else out).select("d", "h", "i")


def whole_groups(batches, key: str, least: int):
    """Tables of at least ``least`` rows (but for the last) that hold whole groups of ``key``, from
    batches sorted by it."""
    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key).to_numpy()
        cut = int(np.searchsorted(k, k[-1], "left"))
        if rows + cut >= least and (cut or held[-1].column(key)[-1].as_py() != k[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held, rows = [], 0
            batch = batch.slice(cut)
        held.append(batch)
        rows += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


def gathered(marks: DataFrame) -> DataFrame:
    """(d, h, ss, es): all marked ranges of each document."""
    return marks.groupBy("d", "h").agg(F.collect_list(F.struct("s", "e")).alias("x")).select(
        "d", "h", F.col("x.s").alias("ss"), F.col("x.e").alias("es"))


def covered(n: int, s, e) -> np.ndarray:
    """Which of ``n`` units lie in one of the ranges."""
    x = np.zeros(n + 1, np.int64)
    np.add.at(x, s, 1)
    np.add.at(x, e, -1)
    return np.cumsum(x[:n]) > 0


def ranges(doc: np.ndarray, i: np.ndarray, length: int):
    """Window starts, sorted by (doc, i), as (doc, s, e) of runs of neighbouring starts."""
    if not len(i):
        return doc, i, i
    cut = np.ones(len(i), bool)
    cut[1:] = (doc[1:] != doc[:-1]) | (i[1:] > i[:-1] + 1)
    b = np.flatnonzero(cut)
    return doc[b], i[b], i[np.append(b[1:], len(i)) - 1] + length

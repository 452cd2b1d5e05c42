"""MinHash near-dedup (4): one-permutation hashing, optimal densification, star-shaped candidates.

* A document's set is that of its ``k``-word shingles, hashed to 64 bits. One permutation splits
  the hash range in ``bands * rows`` bins, each bin's smallest hash is its value, and an empty bin
  takes that of a bin it probes in a fixed pseudo-random order (optimal densification).
* A node is a distinct set, named by a 64-bit hash: rows with equal sets are one node, rows that
  share an id (or have none) are not. Each node goes to ``bands`` buckets.
* A bucket proposes the edges of a star: its smallest node against all others. The stars come from
  one pass over (bucket, node) in sorted order; a bucket that several tasks share is a star of each
  task's part and one of their centres. Links are confirmed on the full sets.
* A star can't see links between two nodes of which neither is like its centre. The buckets whose
  nodes aren't in one component after the stars are therefore solved exactly, of buckets with the same
  nodes one. First prefixes are compared: a set's shingles are ordered by how many of these nodes have
  them, and two alike sets share one of the first ``n - ceil(n * percent / 100) + 1``. Nodes that share none
  with a node of their bucket from another component leave it.
* The nodes that stay are dealt to pairs of blocks of ``BLOCK`` nodes at most, in which the sizes of all
  intersections come from a product of incidence matrices. A pair of blocks emits a spanning forest
  of the components that its links join, never pairs. So the links are those that the bands propose, in buckets of any size.
* Components come from star contraction on the confirmed links, and are then mapped to their first
  node by (smallest doc_id, hash).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _rolling as R
from ._common import NO_ID, batch_of, keyed, slices, staged, table
from ._components import components

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_U = np.uint64
#: Nodes of a block in the exact step.
BLOCK = 256


def shingle_sets(data: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document, one after another, and their offsets. With
    fewer than ``k`` words, but one at least, the whole sequence is the only shingle."""
    data = LOWER[data]
    starts, ends, before = R.words(data, at, IS_WORD)
    roll = R.Rolling(R.word_hashes(data, starts, ends))
    n = np.diff(before)
    counts = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), counts)
    s = np.arange(len(doc)) + np.repeat(before[:-1] - (np.cumsum(counts) - counts), counts)
    values = roll.hash(s, np.minimum(s + k, before[1:][doc]))
    order = np.lexsort((values, doc))
    doc, values = doc[order], values[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (values[1:] != values[:-1])
    doc, values = doc[new], values[new]
    return values, np.searchsorted(doc, np.arange(len(n) + 1))


def _probes(bins: int, attempt: int, bin_: np.ndarray) -> np.ndarray:
    x = R.mix(bin_.astype(np.uint64) * _U(0x9E3779B97F4A7C15) + _U(attempt))
    return ((x >> _U(32)) * _U(bins) >> _U(32)).astype(np.int64)


def one_permutation(values: np.ndarray, at: np.ndarray, bins: int) -> np.ndarray:
    """Densified signatures (documents x bins) of non-empty sorted sets; those of empty sets are 0."""
    n = len(at) - 1
    doc = np.repeat(np.arange(n), np.diff(at))
    cell = doc * bins + ((values >> _U(32)) * _U(bins) >> _U(32)).astype(np.int64)
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    sig = np.zeros(n * bins, np.uint64)
    full = np.zeros(n * bins, bool)
    sig[cell[first]], full[cell[first]] = values[first], True
    todo = np.flatnonzero(~full & np.repeat(np.diff(at) > 0, bins))
    attempt = 0
    while len(todo):  # a filled bin is found with probability 1/bins at least, each time
        attempt += 1
        donor = todo // bins * bins + _probes(bins, attempt, todo % bins)
        got = full[donor]
        sig[todo[got]] = sig[donor[got]]
        todo = todo[~got]
    return sig.reshape(n, bins)


_SIGNED = pa.schema([("d", pa.int64()), ("h", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("x", pa.int64()), ("y", pa.int64()), ("keys", pa.list_(pa.int64()))])


def _sign(k: int, bands: int, rows: int):
    def run(batches):
        for batch in batches:
            for i, j, data, at in slices(batch.column("text")):
                values, off = shingle_sets(data, at, k)
                sums = np.zeros((2, len(values) + 1), np.uint64)
                np.cumsum(R.mix(values), out=sums[0, 1:])
                np.cumsum(R.mix(values ^ _U(0xD1B54A32D192ED03)), out=sums[1, 1:])
                x, y = (R.mix(t[off[1:]] - t[off[:-1]]) for t in sums)
                sig = one_permutation(values, off, bands * rows).reshape(j - i, bands, rows)
                keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (j - i, bands))
                for c in range(rows):
                    keys = R.mix(keys * _U(0x9E3779B97F4A7C15) + sig[:, :, c])
                n = np.diff(off)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * bands), pa.array(keys.ravel().view(np.int64)))
                part = batch.slice(i, j - i)
                yield batch_of(_SIGNED, d=part.column("d"), h=part.column("h"), doc_id=part.column("doc_id"), n=n, x=x.view(np.int64), y=y.view(np.int64), keys=lists)
    return run


def _confirm(k: int, percent: int):
    """Confirmed (u, v) of rows (u, salt, centre, v, text), sorted; one set is held at a time."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches):
        held: list[np.ndarray] = []
        of, fresh = None, False
        for batch in batches:
            who = list(zip(*(batch.column(c).to_numpy(zero_copy_only=False).tolist() for c in ("u", "salt", "centre", "v")), strict=True))
            out = []
            for i, j, data, at in slices(batch.column("text")):
                values, off = shingle_sets(data, at, k)
                for r in range(i, j):
                    u, salt, centre, v = who[r]
                    own = values[off[r - i]:off[r - i + 1]]
                    if centre:
                        held = [*held, own] if of == (u, salt) and fresh else [own]
                        of, fresh = (u, salt), True
                        continue
                    fresh = False
                    for other in held:
                        both = len(np.intersect1d(own, other, assume_unique=True))
                        if 100 * both >= percent * (len(own) + len(other) - both):
                            out.append((u, v))
                            break
            if out:
                yield batch_of(schema, u=[x[0] for x in out], v=[x[1] for x in out])
    return run


_STAR = pa.schema([("key", pa.int64()), ("d", pa.int64()), ("u", pa.int64()), ("n", pa.int64()), ("m", pa.int64())])


def _stars(batches):
    """(key, d, u, n, m) of rows (key, d, n) sorted by key and d: each node but the first of its run, with
    the run's first node u and that one's size m. The first and the last run of a task may be parts of
    one that other tasks share: their centres are given too, with u NULL."""
    at, u, m, runs = None, 0, 0, 0
    for batch in batches:
        key, d, n = (batch.column(c).to_numpy() for c in ("key", "d", "n"))
        if not len(key):
            continue
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        opening = at is None
        new[0] = opening or key[0] != at
        run = np.cumsum(new) - 1  # -1: the run of the batch before
        starts = np.flatnonzero(new)
        centre, size = np.concatenate([[u], d[starts]]), np.concatenate([[m], n[starts]])
        out = np.flatnonzero(~new)
        rows = [key[out], d[out], centre[run[out] + 1], n[out], size[run[out] + 1]]
        mask = np.zeros(len(out), bool)
        if opening:
            rows = [np.concatenate([[a], b]) for a, b in zip((key[0], d[0], 0, n[0], 0), rows, strict=True)]
            mask = np.concatenate([[True], mask])
        at, u, m, runs = key[-1], centre[-1], size[-1], runs + len(starts)
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64), mask=mask if f.name in ("u", "m") else None) for c, f in zip(rows, _STAR, strict=True)], schema=_STAR)
    if runs > 1:
        yield pa.RecordBatch.from_pydict({"key": [at], "d": [u], "u": [None], "n": [m], "m": [None]}, schema=_STAR)


def stars(left: DataFrame) -> DataFrame:
    """(key, d, u, n, m) of the nodes (key, d, n) of buckets with two nodes at least. ``u`` is the centre that
    ``d`` is compared with, ``m`` its size. A bucket's own centre is left out, as all others are
    compared with it; in one that several tasks share it is listed with u = d."""
    rows = left.repartitionByRange("key", "d").sortWithinPartitions("key", "d")
    rows = staged(rows.mapInArrow(_stars, "key long, d long, u long, n long, m long"), "stars")
    first = rows.where("u IS NULL").select("key", "d", "n")  # two rows a task at most
    own = first.groupBy("key").agg(F.min(F.struct("d", "n")).alias("c"), F.count(F.lit(1)).alias("tasks"))
    joint = first.join(F.broadcast(own.where("tasks > 1").select("key", "c")), "key").select("key", "d", F.col("c.d").alias("u"), "n", F.col("c.n").alias("m"))
    return rows.where("u IS NOT NULL").unionByName(joint)


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int, per_centre: int = 500) -> DataFrame:
    """The pairs (u, v) whose texts (d, text) are alike. The members of a centre are dealt to as
    many tasks as they need, each with a copy of the centre's text."""
    # A key more than the aggregate's own, so that its rows are dealt out for the joins and Spark can split a hot centre.
    zero = F.pmod(F.xxhash64("u"), F.lit(1)).alias("z")
    sized = pairs.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / per_centre).alias("salts")).select("u", zero, "salts")
    centres = (texts.join(sized.hint("merge"), texts.d == sized.u).select("u", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"),
                                                            F.lit(True).alias("centre"), F.lit(0).cast("long").alias("v"), "text"))
    members = (pairs.select("u", "v", zero).join(sized, ["u", "z"]).select("u", F.pmod(F.xxhash64("v"), F.col("salts")).alias("salt"), "v")
               .join(texts.hint("merge"), F.col("v") == F.col("d")).select("u", "salt", F.lit(False).alias("centre"), "v", "text"))
    rows = centres.unionByName(members).repartition("u", "salt").sortWithinPartitions("u", "salt", F.desc("centre"), "v")
    return rows.mapInArrow(_confirm(k, percent), "u long, v long")


def overlaps(sets: list[np.ndarray], others: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all sets with all others, by products of 0/1 matrices of so
    many columns at a time."""
    both = [*sets, *others]
    row = np.repeat(np.arange(len(both)), [len(x) for x in both])
    _, column, count = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    column = (np.cumsum(count > 1) - 1)[column[shared]]
    row = row[shared]
    by = np.argsort(column, kind="stable")
    row, column = row[by], column[by]
    out = np.zeros((len(sets), len(others)), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        s, e = np.searchsorted(column, (start, start + columns))
        m = np.zeros((len(both), columns), np.float32)
        m[row[s:e], column[s:e] - start] = 1
        out += m[:len(sets)] @ m[len(sets):].T
    return out.astype(np.int64)


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges (i, j) of a spanning forest of a symmetric 0/1 matrix."""
    todo, edges = np.ones(len(linked), bool), []
    for root in range(len(linked)):
        if not todo[root]:
            continue
        todo[root], queue = False, [root]
        while queue:
            i = queue.pop()
            for j in np.flatnonzero(linked[i] & todo).tolist():
                todo[j] = False
                edges.append((i, j))
                queue.append(j)
    return edges


def _solve_blocks(k: int, percent: int):
    """Links that join components c within and between the two blocks of rows (g, i, j, d, c, b, text), sorted
    by (g, i, j): a spanning forest of the components, each named by its c."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def solve(nodes):
        sets = [s for _, _, s in nodes]
        names, of = np.unique(np.array([c for c, _, _ in nodes], np.int64), return_inverse=True)
        block = np.array([b for _, b, _ in nodes])
        same = block.min() == block.max()
        one = np.flatnonzero(block == block.min())
        two = one if same else np.flatnonzero(block != block.min())
        n = np.array([len(s) for s in sets])
        o = overlaps([sets[x] for x in one], [sets[x] for x in two])
        x, y = np.nonzero(100 * o >= percent * (n[one][:, None] + n[two][None, :] - o))
        linked = np.zeros((len(names), len(names)), bool)
        linked[of[one[x]], of[two[y]]] = True
        edges = forest(linked | linked.T)
        return batch_of(schema, u=[names[i] for i, _ in edges], v=[names[j] for _, j in edges])

    def run(batches):
        at, nodes = None, []
        for batch in batches:
            who = list(zip(*(batch.column(c).to_pylist() for c in ("g", "i", "j", "c", "b")), strict=True))
            for i, j, data, off in slices(batch.column("text")):
                values, cut = shingle_sets(data, off, k)
                for r in range(i, j):
                    if who[r][:3] != at:
                        if len(nodes) > 1:
                            yield solve(nodes)
                        at, nodes = who[r][:3], []
                    nodes.append((who[r][3], who[r][4], values[cut[r - i]:cut[r - i + 1]]))
        if len(nodes) > 1:
            yield solve(nodes)
    return run


def _tokens(k: int):
    """(d, n, key) of each shingle of the set of rows (d, text)."""
    schema = pa.schema([("d", pa.int64()), ("n", pa.int64()), ("key", pa.int64())])

    def run(batches):
        for batch in batches:
            d = batch.column("d").to_numpy()
            for i, j, data, at in slices(batch.column("text")):
                values, off = shingle_sets(data, at, k)
                n = np.diff(off)
                yield batch_of(schema, d=np.repeat(d[i:j], n), n=np.repeat(n, n), key=values.view(np.int64))
    return run


def prefixes(texts: DataFrame, k: int, percent: int) -> DataFrame:
    """(d, t) of the shingles t in the prefixes of the nodes (d, text). Shingles of one node only
    come first in its order and are left out: they take places of the prefix, but join nothing."""
    tokens = staged(texts.mapInArrow(_tokens(k), "d long, n long, key long"), "shingles")
    shared = staged(tokens.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "shared")
    sets = tokens.join(shared, "key").groupBy("d", "n").agg(F.sort_array(F.collect_list(F.struct("m", "key"))).alias("s"))
    length = F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 1
    places = F.greatest(length - (F.col("n") - F.size("s")), F.lit(0)).cast("int")
    return sets.select("d", F.explode(F.slice("s", F.lit(1), places)).alias("t")).select("d", F.col("t.key").alias("t"))


def unsettled(left: DataFrame, texts: DataFrame, label: DataFrame, k: int, percent: int) -> DataFrame:
    """(key, d) of the nodes of buckets (key, d) that may be like a node of another component (d, c) in
    their bucket: those that share a shingle of their prefixes with one."""
    own = staged(prefixes(texts, k, percent).join(label, "d", "left").select("d", "t", F.coalesce("c", "d").alias("c")), "prefixes")
    rows = staged(left.join(own, "d").select("key", "t", "d", "c"), "places")
    live = staged(rows.groupBy("key", "t").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x <> y").select("key", "t"), "live")
    return rows.join(live, ["key", "t"], "left_semi").select("key", "d").distinct()


def _exact(left: DataFrame, texts: DataFrame, label: DataFrame, k: int, percent: int) -> DataFrame:
    """Links that join components (d, c) of nodes in the same bucket (key, d), from component to component."""
    left = staged(unsettled(left, texts, label, k, percent), "unsettled")
    sizes = staged(left.groupBy("key").agg(F.count(F.lit(1)).alias("m")), "sizes")
    blocks = F.ceil(F.col("m") / BLOCK)
    nodes = left.join(sizes, "key").join(label, "d", "left").withColumn("c", F.coalesce("c", "d")).withColumn("b", F.pmod(F.xxhash64("d"), blocks))
    nodes = nodes.select(F.col("key").alias("g"), "d", "c", "b", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("x"))
    nodes = nodes.select("g", F.least("b", "x").alias("i"), F.greatest("b", "x").alias("j"), "b", "d", "c")
    rows = nodes.join(texts, "d").repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "d")
    return rows.mapInArrow(_solve_blocks(k, percent), "u long, v long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, *, bands: int = 32, rows: int = 5,
                    id_col: str = "doc_id", text_col: str = "text", row_keys: bool = False) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (the smallest id that confirmed links
    reach, its own included), kept (whether that is its own, and of several sets with that id in the
    component its set is the first by hash).

    Links: ``100 * intersection >= percent * union`` of the shingle sets. NULL, empty and blank
    texts have an empty set and no links. Rows are told apart by their sets, not their ids, so rows
    that share an id are linked only if they are alike. A NULL id sorts last: the component of rows
    that all have none is NULL, and its first set is kept. Rows with the same id and set are kept or
    not together. Other columns are left out; ``row_keys`` adds the internal identity (d, h) of each
    row and ``g``, that of its component (NULL for an empty set).
    """
    docs = keyed(docs, id_col, text_col)
    signed = staged(docs.mapInArrow(_sign(k, bands, rows), "d long, h long, doc_id long, n long, x long, y long, keys array<long>"), "signed")
    # One row a node: its first row, its keys (equal sets have equal ones).
    nodes = staged(signed.where("n > 0").groupBy("x", "y", "n").agg(F.min(F.struct("d", "h", "keys")).alias("rep"))
                   .select("x", "y", "n", "rep.d", "rep.h", "rep.keys", F.xxhash64("x", "y", "n").alias("node")), "sets")
    sets = nodes.drop("keys")
    left = staged(stars(nodes.select(F.explode("keys").alias("key"), F.col("node").alias("d"), "n")), "buckets")
    # One text a node, however many rows repeat it. Texts are always joined by a shuffle: what they
    # are joined to grows with them, so small inputs shall not go another way than large ones.
    some = left.select(F.col("d").alias("node")).unionByName(left.select(F.col("u").alias("node"))).distinct()
    reps = staged(sets.join(some, "node", "left_semi").select("d", "h", "node"), "reps")
    texts = staged(docs.select("d", "h", "text").join(reps.hint("merge"), ["d", "h"]).groupBy("d", "h", "node").agg(F.min("text").alias("text"))
                   .select(F.col("node").alias("d"), "text"), "texts")
    like = F.lit(percent) * F.greatest("n", "m") <= 100 * F.least("n", "m")
    pairs = left.where("d <> u").where(like).select("u", F.col("d").alias("v")).distinct()
    links = staged(confirmed(staged(pairs, "pairs"), texts, k, percent), "links")
    label = components(links)
    left = left.select("key", "d").join(label, "d", "left").select("key", "d", F.coalesce("c", "d").alias("c"))
    mixed = left.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y"), F.min("d").alias("u"), F.count(F.lit(1)).alias("m"),
                                    F.bit_xor(F.xxhash64("d")).alias("all")).where("x <> y")
    mixed = staged(mixed.groupBy("u", "m", "all").agg(F.min("key").alias("key")).select("key"), "mixed")
    left = staged(left.join(mixed, "key", "left_semi").select("key", "d").distinct(), "open")
    if not left.isEmpty():
        some = staged(texts.join(left.select("d").distinct().hint("merge"), "d", "left_semi"), "open-texts")
        links = staged(links.unionByName(_exact(left, some, label, k, percent)), "links")
        label = components(links)
    # Tables to join with are written first, so that Spark can split a hot component.
    own = staged(sets.select("x", "y", "n", F.col("d").alias("least"), F.col("node").alias("d")).join(label, "d", "left")
                 .withColumn("c", F.coalesce("c", "d")), "nodes")
    first = staged(own.groupBy("c").agg(F.min(F.struct("least", "d")).alias("r")).select("c", F.col("r.least").alias("first_id"), F.col("r.d").alias("g")), "first")
    own = staged(own.join(first, "c").select("x", "y", "n", "first_id", "g", (F.col("d") == F.col("g")).alias("leads")), "components")
    out = signed.join(own, ["x", "y", "n"], "left")
    c = F.coalesce("first_id", "d")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(c != NO_ID, c).alias("component_id"),
                      ((F.col("d") == c) & F.coalesce("leads", F.lit(True))).alias("kept"), *(["d", "h", "g"] if row_keys else []))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=2)

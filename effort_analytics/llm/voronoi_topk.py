"""Exact top-k search (9): Voronoi kNN join by pivots, for the inner product.

1. Vectors become integers, floor(scale * x). Equal vectors are one point; of its ids only the
   ``k + 1`` smallest can be in a result.
2. Pivots are the means that k-means finds on a sample of points of a fixed size: about the square
   root of the number of points, 1,024 at most. Each point belongs to the cell of its nearest
   pivot. A cell's summary is its largest distance from the pivot and its largest norm.
3. Cells that lie near each other are packed into groups of about ``block`` points, a cell of more
   is split into several; a group is what one task solves at a time.
4. Queries are solved in the groups of the ``home`` cells they are closest to. The k-th best score
   there is a lower bound of the query's result.
5. No point of a cell scores above ``reach``: the least of |q| max|x|, q.p + |q| r and
   (|q|^2 + max|x|^2 - max(0, |q - p| - r)^2) / 2. A query is copied, once, to each other group with
   a cell that reaches its bound; there, only cells that some query of the batch reaches are
   multiplied. The best k of all groups are the result.

Scores are exact integers: by double arithmetic where |q| |x| is below 2**53, else by Python's
integers. How much the bounds prune depends on the data: on vectors without clusters, nothing.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import staged, table

_NONE = -(2**63 - 1)  # no bound yet, and the least score


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, v: integers as double array) of the rows that take part."""
    v = F.transform(F.col(f"`{vec_col}`"), lambda x: F.floor(x.cast("double") * scale).cast("double"))
    inf = float("inf")
    ok = (F.col(f"`{vec_col}`").isNotNull() & F.col(f"`{id_col}`").isNotNull()
          & F.forall(F.col(f"`{vec_col}`"), lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(inf)), F.lit(False))))
    return vectors.where(ok).select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v"))


def _matrix(col, width: int) -> np.ndarray:
    """Rows of a list<double> or binary column, filled up with zeros to ``width``."""
    if pa.types.is_binary(col.type):
        rows = [np.frombuffer(x.as_py()) for x in col]
    else:
        off, flat = col.offsets.to_numpy(), col.values.to_numpy(zero_copy_only=False)
        rows = [flat[s:e] for s, e in zip(off[:-1], off[1:], strict=True)]
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def _centres(sample: np.ndarray, n: int, rounds: int = 5) -> np.ndarray:
    """``n`` means of the sample by k-means, begun with its first rows."""
    centres = sample[:n].copy()
    for _ in range(rounds):
        cell = (sample @ centres.T - (centres * centres).sum(axis=1) / 2).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, sample)
        many = np.bincount(cell, minlength=n)
        centres[many > 0] = sums[many > 0] / many[many > 0, None]
    return centres


def _assign(pivots: np.ndarray):
    """Cell, distance from its pivot and norm of each point."""
    width = pivots.shape[1]
    half = (pivots * pivots).sum(axis=1) / 2
    schema = pa.schema([("cell", pa.int32()), ("v", pa.binary()), ("ids", pa.list_(pa.int64())), ("r", pa.float64()), ("norm", pa.float64()), ("hash", pa.int64())])

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                part = batch.slice(i, 4096)
                x = _matrix(part.column("v"), width)
                cell = (x @ pivots.T - half).argmax(axis=1)
                r = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array([row.tobytes() for row in x], pa.binary()), part.column("ids"),
                                                  pa.array(r), pa.array(np.sqrt((x * x).sum(axis=1))), part.column("hash")], schema=schema)
    return run


def reach(queries: np.ndarray, pivots: np.ndarray, radius: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """The most that a point of each cell can score with each query, rounded up."""
    dot = queries @ pivots.T
    q2 = (queries * queries).sum(axis=1)[:, None]
    q = np.sqrt(q2)
    apart = np.sqrt(np.maximum(q2 - 2 * dot + (pivots * pivots).sum(axis=1), 0))
    gap = np.maximum(apart * (1 - 1e-6) - radius, 0)
    best = np.minimum(np.minimum(dot + q * radius, q * norm), (q2 + norm * norm - gap * gap) / 2)
    return best + 1e-6 * (q * (norm + radius) + q2 + norm * norm) + 1e-3


def _groups(pivots: np.ndarray, counts: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First group and number of groups of each cell, and the number of groups: cells are taken in a
    chain of near neighbours."""
    base, parts = np.zeros(len(pivots), np.int64), np.ones(len(pivots), np.int64)
    left, at, group, filled = np.ones(len(pivots), bool), 0, 0, 0
    for _ in range(len(pivots)):
        left[at] = False
        if filled and filled + counts[at] > block:
            group, filled = group + 1, 0
        base[at], parts[at] = group, max(1, -(-int(counts[at]) // block))
        if parts[at] > 1:
            group, filled = group + int(parts[at]), 0
        else:
            filled += int(counts[at])
        if left.any():
            rest = np.flatnonzero(left)
            at = int(rest[((pivots[rest] - pivots[at]) ** 2).sum(axis=1).argmin()])
    return base, parts, group + (filled > 0)


_HITS = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of integer vectors, exact, held within +-(2**63 - 1)."""
    qn, xn = (np.sqrt((m * m).sum(axis=1)) for m in (q, x))
    with np.errstate(invalid="ignore"):
        out = np.where(np.multiply.outer(qn, xn) < 2**52, q @ x.T, 0).astype(np.int64)
    rows = np.flatnonzero(qn * xn.max(initial=0) >= 2**52)
    cols = np.flatnonzero(xn * qn.max(initial=0) >= 2**52)
    for i in range(0, len(rows) if len(cols) else 0, 64):
        big = [[int(v) for v in row] for row in q[rows[i:i + 64]].tolist()]
        for j in range(0, len(cols), 256):
            own = cols[j:j + 256]
            exact = np.array(big, object) @ np.array([[int(v) for v in row] for row in x[own].tolist()], object).T
            out[np.ix_(rows[i:i + 64], own)] = np.clip(exact, _NONE, -_NONE).astype(np.int64)
    return out


def _best(scores: np.ndarray, ids: list, query: int, k: int, bound: int) -> list[tuple[int, int]]:
    """The k best (score, id) of a query among points with these scores, its own id left out."""
    cut = bound
    if len(scores) > k + 1:  # its own point may be one of them
        cut = max(cut, int(np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]))
    found = sorted((-int(scores[j]), i) for j in np.flatnonzero(scores >= cut) for i in ids[j] if i != query)
    return [(-s, i) for s, i in found[:k]]


def _solve(k: int, pivots: np.ndarray, radius: np.ndarray, norm: np.ndarray, chunk: int = 256):
    """Best k of each query of a group: rows (grp, kind, cell, v, ids, bound), points (kind 0) by cell,
    then queries by the cell they are closest to; a group's points and ``chunk`` queries are held."""
    def scored(points, ids, cells, queries):
        q = np.stack([v for v, _, _ in queries])
        bound = np.array([b for _, _, b in queries], np.int64)
        there = np.unique(cells)
        near = (reach(q, pivots[there], radius[there], norm[there]) >= bound[:, None].astype(float)) | (bound == _NONE)[:, None]
        some = np.flatnonzero(np.isin(cells, there[near.any(axis=0)]))
        if not len(some):
            return
        own = [ids[j] for j in some]
        s = _scores(q, points[some])
        out = [(qid, i, sc) for row, (_, qid, b) in zip(s, queries, strict=True) for sc, i in _best(row, own, qid, k, b)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=_HITS)

    def run(batches):
        at, points, ids, cells, queries, whole = None, [], [], [], [], None
        for batch in batches:
            for grp, kind, cell, v, own, bound in zip(*(batch.column(c).to_pylist() for c in ("grp", "kind", "cell", "v", "ids", "bound")), strict=True):
                if grp != at or len(queries) >= chunk:
                    if queries and whole is not None:
                        yield from scored(*whole, queries)
                    queries = []
                    if grp != at:
                        at, points, ids, cells, whole = grp, [], [], [], None
                if kind == 0:
                    points.append(np.frombuffer(v))
                    ids.append(own)
                    cells.append(cell)
                else:
                    if points:
                        whole, points = (np.stack(points), ids, np.array(cells)), []
                    queries.append((np.frombuffer(v), own[0], bound))
        if queries and whole is not None:
            yield from scored(*whole, queries)
    return run


_ROUTED = "grp long, kind int, cell int, v binary, ids array<long>, bound long"


def _route(pivots: np.ndarray, radius: np.ndarray, norm: np.ndarray, base: np.ndarray, parts: np.ndarray, home: int):
    """A row for each group a query must see: with no bound yet those of the ``home`` cells it is closest
    to, else all others that hold a cell which reaches the bound."""
    schema = pa.schema([("grp", pa.int64()), ("kind", pa.int32()), ("cell", pa.int32()), ("v", pa.binary()), ("ids", pa.list_(pa.int64())), ("bound", pa.int64())])

    def groups(cells):
        return {g for c in cells for g in range(base[c], base[c] + parts[c])}

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                vs, qids, bounds = (part.column(c).to_pylist() for c in ("v", "id", "bound"))
                q = np.stack([np.frombuffer(v) for v in vs])
                near = np.argsort(-(q @ pivots.T), axis=1, kind="stable")[:, :home]
                most = reach(q, pivots, radius, norm)
                out = []
                for v, qid, bound, cells, up in zip(vs, qids, bounds, near, most, strict=True):
                    first = {int(base[c]) for c in cells}  # of a split cell, its first group
                    go = first if bound is None else groups(range(len(up)) if bound == _NONE else np.flatnonzero(up >= bound)) - first
                    out.extend((int(g), 1, int(cells[0]), v, [qid], _NONE if bound is None else bound) for g in sorted(go))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
    return run


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, *, scale: int = 256, pivots: int = 1024, sample: int = 16_384, block: int = 8192, home: int = 2,
          id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the highest inner product with each query
    row, itself left out, ties to the smaller id.

    Vectors that are NULL or hold NULL, NaN or infinite components take no part, nor do rows with a
    NULL id. Of vectors of unequal length the shorter is filled with zeros. Repeated rows are one.
    A component beyond the range of a long is held at its end, and so is a score. Other columns are
    left out. The driver holds the sample, the pivots (``pivots`` at most) and a summary of each cell.
    """
    source = vectors.select(F.col(f"`{id_col}`"), F.col(f"`{vec_col}`"), is_query.alias("_q"))
    rows = integer_vectors(source, id_col, vec_col, scale)
    place = Window.partitionBy("v").orderBy("id")
    points = (rows.distinct().withColumn("i", F.row_number().over(place)).where(F.col("i") <= k + 1)
              .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("hash", F.xxhash64("v")))
    points = staged(points, "points")
    shape = points.agg(F.max(F.size("v")), F.count(F.lit(1))).first()
    spark = vectors.sparkSession
    if not shape[1]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = max(shape[0], 1)
    drawn = _matrix(points.orderBy("hash", "v").limit(sample).select("v").toArrow().column("v").combine_chunks(), width)
    centre = _centres(drawn, min(pivots, math.isqrt(shape[1] - 1) + 1, len(drawn)))
    cells = staged(points.mapInArrow(_assign(centre), "cell int, v binary, ids array<long>, r double, norm double, hash long"), "cells")
    found = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("r").alias("r"), F.max("norm").alias("norm")).orderBy("cell").collect()  # ``pivots`` rows at most
    centre = centre[[c.cell for c in found]]  # cells without points go
    radius, norm = np.array([c.r for c in found]), np.array([c.norm for c in found])
    base, parts, groups = _groups(centre, np.array([c.n for c in found]), block)
    where = spark.createDataFrame([(c.cell, i, int(base[i]), int(parts[i])) for i, c in enumerate(found)], "cell int, no int, base long, parts long")
    data = cells.join(F.broadcast(where), "cell").select((F.col("base") + F.pmod("hash", "parts")).alias("grp"), F.lit(0).alias("kind"), F.col("no").alias("cell"), "v", "ids",
                                                         F.lit(_NONE).cast("long").alias("bound"))
    asked = integer_vectors(source.where("_q"), id_col, vec_col, scale).distinct().mapInArrow(_packed(width), "id long, v binary")
    tasks = min(groups, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def hits(queries):
        routed = queries.mapInArrow(_route(centre, radius, norm, base, parts, home), _ROUTED)
        dealt = data.unionByName(routed).repartitionById(tasks, F.pmod("grp", F.lit(tasks)).cast("int"))
        return dealt.sortWithinPartitions("grp", "kind", "cell").mapInArrow(_solve(k, centre, radius, norm), "query_id long, id long, score long")

    asked = staged(asked, "asked")
    first = staged(_ranked(hits(asked.withColumn("bound", F.lit(None).cast("long"))), k), "first")
    bound = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(_NONE)).alias("bound"))
    asked = asked.join(bound, asked.id == bound.query_id, "left").select("id", "v", F.coalesce("bound", F.lit(_NONE)).alias("bound"))
    out = _ranked(first.select("query_id", "id", "score").unionByName(hits(asked)), k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")


def _packed(width: int):
    schema = pa.schema([("id", pa.int64()), ("v", pa.binary())])

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("v"), width)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([r.tobytes() for r in x], pa.binary())], schema=schema)
    return run


def op9_voronoi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE = """
WITH v AS (
  SELECT DISTINCT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

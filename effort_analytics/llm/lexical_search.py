"""Ranked lexical search (11): dense blocked matrix products of item and document tiles.

1. Items are dealt by hash to blocks of about ``block_terms`` terms. A block's vocabulary, its items'
   distinct terms, is all that the tasks hold of them; work on a block is one pass over documents.
2. A pass reads every whole text once and writes, for each document with a term, its length and the
   counts of the vocabulary's terms (exact look-up of the words' bytes). From it come the numbers
   N, L and df, hence the integer weights.
3. Tiles of items are given a compact vocabulary of their own, split in tiles of columns. A tile of
   weights (items x terms) times a tile of impacts (terms x documents) is a float64 BLAS product.
   Columns are limited such that a weight's sum times the largest impact stays below 2**53: no partial
   sum, in whatever order, is rounded. Tiles of columns are added as 64-bit integers.
4. From each tile, all documents that reach an item's k-th best score are merged with the task's best
   k; ties go to the smaller id, so no tile edge can change the result. Tasks' results are ranked in
   two steps, by (item, salt) and by item.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import _rolling as R
from ._common import batch_of, slices, staged, table
from .minhash_dedup import LOWER

IS_TERM = np.zeros(256, bool)
IS_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: The largest impact: (10**9 * tf) div (1000 * tf + 8 * m) is below 10**6 for a positive m.
MAX_IMPACT = 10**6
EXACT = 2**53
SALTS = 32


def terms(data: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased terms of a slice of texts as a binary array, and the number of terms before each."""
    starts, ends, before = R.words(data, at, IS_TERM)
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    body = np.ascontiguousarray(LOWER[data[IS_TERM[data]]])
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)]), before


_ITEM = pa.schema([("item_id", pa.int64()), ("item", pa.int64()), ("terms", pa.list_(pa.large_binary()))])


def _item_terms(batches):
    for batch in batches:
        for i, j, data, at in slices(batch.column("text")):
            words, before = terms(data, at)
            lists = [pc.unique(words.slice(before[r], before[r + 1] - before[r])) for r in range(j - i)]
            off = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
            part = batch.slice(i, j - i)
            yield batch_of(_ITEM, item_id=part.column("item_id"), item=part.column("item"), terms=pa.ListArray.from_arrays(pa.array(off), pa.concat_arrays(lists)))


_POST = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("t", pa.list_(pa.int32())), ("f", pa.list_(pa.int32()))])


def _counted(vocabulary: pa.Array):
    """Documents with a term: length, and number and count of each term of the vocabulary in it."""
    size = len(vocabulary)

    def run(batches):
        for batch in batches:
            for i, j, data, at in slices(batch.column("text")):
                words, before = terms(data, at)
                n = np.diff(before)
                number = pc.index_in(words, value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                doc = np.repeat(np.arange(j - i), n)
                key, tf = np.unique((doc * size + number)[number >= 0], return_counts=True)
                own = np.flatnonzero(n > 0)
                off = np.searchsorted(key // max(size, 1), np.concatenate([own, [j - i]])).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(off), pa.array(x.astype(np.int32))) for x in (key % max(size, 1), tf)]
                yield batch_of(_POST, doc_id=batch.column("doc_id").slice(i, j - i).take(pa.array(own)), n=n[own], t=lists[0], f=lists[1])
    return run


def _frequencies(size: int):
    """(t, df) of a task's documents, one row a term."""
    schema = pa.schema([("t", pa.int32()), ("df", pa.int64())])

    def run(batches):
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(batch.column("t").flatten().to_numpy(), minlength=size)
        t = np.flatnonzero(df)
        yield batch_of(schema, t=t.astype(np.int32), df=df[t])
    return run


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    """floor(1000 * ln((2N+2) / (2df+1))) of each term; 0 for one that no document holds."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) if x else 0 for x in df], np.int64)


def tiles(items: list[np.ndarray], weight: np.ndarray, item_tile: int, column_tile: int) -> list[tuple[int, list[tuple[np.ndarray, np.ndarray]]]]:
    """(first item, [(term numbers, weights: items x terms)]) of each tile of items, whose compact
    vocabulary is split so that the exactness bound holds in every tile of columns."""
    out = []
    for i in range(0, len(items), item_tile):
        own = items[i:i + item_tile]
        vocabulary = np.unique(np.concatenate(own)) if own else np.zeros(0, np.int64)
        vocabulary = vocabulary[weight[vocabulary] > 0]
        columns, parts = min(column_tile, (EXACT - 1) // (MAX_IMPACT * max(int(weight[vocabulary].max(initial=0)), 1))), []
        for c in range(0, len(vocabulary), columns):
            t = vocabulary[c:c + columns]
            w = np.zeros((len(own), len(t)))
            for r, x in enumerate(own):
                w[r, np.flatnonzero(np.isin(t, x))] = weight[t[np.isin(t, x)]]
            parts.append((t, w))
        out.append((i, parts))
    return out


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """(10**9 * tf) div (1000 * tf + 8 * m), with m = 10 + (90 * n * N) div L."""
    if len(n) and int(n.max()) * 90 * n_docs >= 2**63:  # beyond 64 bits only in the product
        m = np.array([10 + 90 * int(x) * n_docs // n_terms for x in n], np.int64)
    else:
        m = 10 + 90 * n * n_docs // n_terms
    return 10**9 * tf // (1000 * tf + 8 * m)


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores above 0, equal ones by ascending id."""
    at = np.flatnonzero(score > 0)
    if len(at) > k:
        kth = np.partition(score[at], len(at) - k)[len(at) - k]
        at = at[score[at] >= kth]
    return at[np.lexsort((ids[at], -score[at]))][:k]


def _scored(item_tiles, n_items: int, size: int, n_docs: int, n_terms: int, k: int, doc_tile: int):
    """(item, doc_id, score) of a task's k best documents for each item."""
    schema = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])
    none = 2**63 - 1  # a NULL id sorts last

    def run(batches):
        top_s = [np.zeros(0, np.int64)] * n_items
        top_d = [np.zeros(0, np.int64)] * n_items
        place = np.full(size, -1, np.int64)
        for whole in batches:
            for i in range(0, whole.num_rows, doc_tile):
                batch = whole.slice(i, doc_tile)
                ids = batch.column("doc_id").fill_null(none).to_numpy()
                n = batch.column("n").to_numpy()
                t, tf = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("t", "f"))
                doc = np.repeat(np.arange(len(ids)), pc.list_value_length(batch.column("t")).to_numpy())
                x = impacts(tf, n[doc], n_docs, n_terms)
                for first, parts in item_tiles:
                    total = None
                    for columns, w in parts:
                        place[columns] = np.arange(len(columns))
                        at = place[t]
                        use = at >= 0
                        m = np.zeros((len(columns), len(ids)))
                        m[at[use], doc[use]] = x[use]
                        place[columns] = -1
                        part = (w @ m).astype(np.int64)
                        total = part if total is None else total + part
                    for r, score in enumerate(total if total is not None else ()):
                        item = first + r
                        if len(top_s[item]) == k and score.max() < top_s[item][-1]:
                            continue
                        new = best(score, ids, k)
                        s, d = np.concatenate([top_s[item], score[new]]), np.concatenate([top_d[item], ids[new]])
                        keep = best(s, d, k)
                        top_s[item], top_d[item] = s[keep], d[keep]
        item = np.repeat(np.arange(n_items, dtype=np.int32), [len(x) for x in top_s])
        if len(item):
            d = np.concatenate(top_d)
            yield batch_of(schema, item=item, doc_id=pa.array(d, pa.int64(), mask=d == none), score=np.concatenate(top_s))
    return run


def _block(docs: DataFrame, block: list, k: int, item_tile: int, column_tile: int, doc_tile: int) -> DataFrame | None:
    """The ranked documents of one block of items (rows item_id, terms)."""
    spark = docs.sparkSession
    vocabulary = pc.unique(pa.array([t for r in block for t in r.terms], pa.large_binary()))
    number = {t: i for i, t in enumerate(vocabulary.to_pylist())}
    items = [np.array([number[bytes(t)] for t in r.terms], np.int64) for r in block]
    posts = staged(docs.mapInArrow(_counted(vocabulary), "doc_id long, n long, t array<int>, f array<int>"), "postings")
    n_docs, n_terms = posts.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        return None
    df = np.zeros(len(vocabulary), np.int64)
    for r in posts.select("t").mapInArrow(_frequencies(len(df)), "t int, df long").groupBy("t").agg(F.sum("df").alias("df")).collect():  # a row a term of the block
        df[r.t] = r.df
    parts = tiles(items, weights(df, n_docs), item_tile, column_tile)
    hits = posts.mapInArrow(_scored(parts, len(items), len(df), n_docs, n_terms, k, doc_tile), "item int, doc_id long, score long")
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    few = hits.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    few = few.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= k)
    few = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(block)], "item int, item_id long")
    return few.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # a row an item of the block


def search(docs: DataFrame, items: DataFrame, k: int = 10, *, block_terms: int = 100_000, item_tile: int = 256, column_tile: int = 4096, doc_tile: int = 512,
           id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents with the highest score above 0 for each item.

    Every row of ``docs`` is a document: repeated rows are ranked one after another, a NULL id comes
    after all others of its score, and texts that are NULL or have no terms take no part. Repeated
    items are one; items that share an id but not the text, or have none, are ranked each for itself;
    items without a term found anywhere have no rows. Other columns are left out. Weights, tiles and
    the best k of each item are all that a task holds beside a tile of ``doc_tile`` documents.
    """
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    asked = items.select(F.col(f"`{item_col}`").cast("long").alias("item_id"), F.coalesce(F.col(f"`{item_text_col}`").cast("string"), F.lit("")).alias("text")).distinct()
    asked = asked.withColumn("item", F.xxhash64("item_id", "text"))
    asked = staged(asked.mapInArrow(_item_terms, "item_id long, item long, terms array<binary>").where(F.size("terms") > 0), "items")
    blocks = -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // block_terms)
    out = None
    for b in range(blocks):  # a block is of bounded size, whatever the number of items
        rows = asked.where(F.pmod("item", F.lit(blocks)) == b).orderBy("item_id", "item").collect()
        ranked = _block(docs, rows, k, item_tile, column_tile, doc_tile) if rows else None
        if ranked is not None:
            ranked = ranked if blocks == 1 else staged(ranked, "ranked")
            out = ranked if out is None else out.unionByName(ranked)
    return out if out is not None else docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
n AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS n_terms FROM d WHERE len(ws) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM d) GROUP BY r, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
i AS (
  SELECT DISTINCT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (
  SELECT i.item_id, i.text, d.r, d.doc_id, CAST(sum(
    CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(ws) * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM i JOIN tf USING (term) JOIN df USING (term) JOIN d ON d.r = tf.r, n GROUP BY i.item_id, i.text, d.r, d.doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10
"""

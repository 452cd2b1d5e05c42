"""Filter interaction audit (13): Hart-Mas-Colell potential of the removal game.

The players are five filters; a coalition removes the documents that fail any of its filters. What a
document does in every coalition follows from the set of filters it fails, so documents are counted
once per part and failure set (32 sets at most), and the games of all 32 coalitions come from these
counts, whatever the number of documents.

* ``v(S)``: the documents that a failure set meeting S removes.
* Potential: P({}) = 0, and the marginals P(S) - P(S without i) over the filters i of S add up to
  v(S), so P(S) = (v(S) + sum of P(S without i)) / |S|. It is worked out coalition by coalition from
  the smaller ones, times 120 so that every division leaves no remainder.
* Shapley value of i: P(all) - P(all without i); times 120 it is the sum over all orders.
* Steps of an order: the documents that a filter removes after those before it are
  v(before with it) - v(before).

Documents with one text are failed by filter E but for the smallest id. They are counted by (text
hash, part, labels) before anything is compared, so a text that a third of all rows share is a few
rows by then.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import staged, table

FILTERS = "ABCDE"
GRAND = 2 ** len(FILTERS) - 1
#: 5!: the number of orders, and the multiple at which all potentials are whole numbers.
SCALE = 120
_SPACE = r"[\x20\x09-\x0D]+"


def text_failures(text: Column, *, min_words: int = 200, min_distinct: int = 50, max_capitals: int = 2, signs: str = "#$%&*|") -> Column:
    """Failure set of the filters that see one text only, as bits: A (1), too few words; B (2), too
    few of the words distinct (percent); C (4), too many capitals (percent of code points); D (8),
    any of the signs."""
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    sizes = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("k")))[0]
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    sign = F.length(F.translate(text, signs, "")) < F.length(text)
    a, b = sizes["n"] < min_words, 100 * sizes["k"].cast("long") < min_distinct * sizes["n"].cast("long")
    c = 100 * capitals.cast("long") > max_capitals * F.length(text).cast("long")
    return sum((F.when(x, 2**i).otherwise(0) for i, x in enumerate((b, c, sign), 1)), F.when(a, 1).otherwise(0))


def failure_sets(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): documents by source, failure set and labels."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("d"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text, 256)).alias("h"), text_failures(text).alias("mask"))
    # Copies of a row are one row with their number, so a repeated row is never a hot key of the join.
    rows = staged(rows.groupBy("d", "part", "h", "mask").agg(F.count(F.lit(1)).alias("n")), "failures")
    marks = (labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("d"))
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic")))
    # Rows without an id have no labels; they don't take part in the join, where they were one key.
    known = rows.where("d IS NOT NULL").join(marks, "d", "left").select("d", "part", "h", "mask", "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    none = rows.where("d IS NULL").select("d", "part", "h", "mask", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    every = known.unionByName(none)
    same = every.groupBy("h", "part", "good", "toxic", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("d").isNull(), F.col("n")).otherwise(0)).alias("free"), F.min(F.when(F.col("d").isNotNull(), F.struct("d", "n"))).alias("least"))
    first = F.min("least.d").over(Window.partitionBy("h"))
    same = same.withColumn("spared", F.col("free") + F.when(F.col("least.d") == first, F.col("least.n")).otherwise(0))
    out = same.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), F.col("spared").alias("n")),
        F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("spared")).alias("n")))).alias("x"))
    return out.groupBy("part", "x.mask", "good", "toxic").agg(F.sum("x.n").alias("n")).where("n > 0")


def _set(s) -> int:
    return sum(1 << FILTERS.index(x) for x in s)


def games(counts: DataFrame) -> DataFrame:
    """One row a part: the number of documents, and arrays over the coalitions (as bits): ``v`` (all
    documents), ``good`` and ``bad`` (labelled ones)."""
    def game(of: Column) -> Column:
        return F.array(*(F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, of).otherwise(F.lit(0))) for s in range(GRAND + 1)))
    n = F.col("n")
    return counts.groupBy("part").agg(F.sum("n").alias("total"), game(n).alias("v"), game(n * F.col("good")).alias("good"), game(n * F.col("toxic")).alias("bad"))


def potentials(games_: DataFrame) -> DataFrame:
    """``games_`` with the array ``p``: 120 times the potential of each coalition."""
    p: dict[int, str] = {0: "_p0"}
    out = games_.withColumn("_p0", F.lit(0).cast("long"))
    for size in range(1, len(FILTERS) + 1):  # the potentials of one size need those of the size below only
        new = {}
        for s in (s for s in range(GRAND + 1) if s.bit_count() == size):
            below = sum((F.col(p[s & ~(1 << i)]) for i in range(len(FILTERS)) if s >> i & 1), SCALE * F.col("v")[s])
            new[f"_p{s}"] = F.call_function("div", below, F.lit(size))
            p[s] = f"_p{s}"
        out = out.withColumns(new)
    return out.withColumn("p", F.array(*(F.col(p[s]) for s in range(GRAND + 1)))).drop(*p.values())


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part (source), order of the five filters and step: part, filter_order, step,
    and long document counts: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A NULL text is an empty one and a NULL source the part ''. A NULL id is smaller than none and
    has no label: its row neither fails E nor makes others fail. Rows that repeat the smallest id
    and its text don't fail E. Of repeated labels of an id any 1 counts; other columns are left out.
    Empty documents give no rows.
    """
    have = potentials(games(failure_sets(docs, labels)))
    steps = []
    for order in permutations(FILTERS):
        for i, f in enumerate(order):
            steps.append(("".join(order), i + 1, _set(order[:i]), _set(order[:i + 1]), _set(f), GRAND & ~_set(f)))
    names = ("filter_order", "step", "before", "after", "own", "others")
    plan = F.array(*(F.struct(*(F.lit(x).alias(c) for c, x in zip(names, s, strict=True))) for s in steps))
    rows = have.select("*", F.explode(plan).alias("s"))

    def at(game: str, s: str) -> Column:
        return F.element_at(game, F.col(f"s.{s}") + 1)
    removed = at("v", "after") - at("v", "before")
    return rows.select(
        "part", F.col("s.filter_order").alias("filter_order"), F.col("s.step").alias("step"),
        (F.col("total") - at("v", "after")).alias("kept"), removed.alias("removed"), (at("v", "own") - removed).alias("redundant"),
        (F.col("v")[GRAND] - at("v", "others")).alias("unique_fails"), (at("good", "after") - at("good", "before")).alias("good_lost"),
        (at("bad", "after") - at("bad", "before")).alias("toxic_lost"), (F.col("p")[GRAND] - at("p", "others")).alias("shapley"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Every document is led through every order, step by step.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
m AS (SELECT t, min(doc_id) AS least FROM w GROUP BY t),
d AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad, map {
    'A': len(ws) < 200, 'B': 100 * len(list_distinct(ws)) < 50 * len(ws),
    'C': 100 * length(regexp_replace(w.t, '[^A-Z]', '', 'g')) > 2 * length(w.t),
    'D': regexp_matches(w.t, '[#$%&*|]'), 'E': coalesce(w.doc_id > least, false)} AS fails
  FROM w JOIN m ON w.t = m.t LEFT JOIN l ON w.doc_id = l.doc_id),
f AS (
  SELECT part, good, bad, fails, count(*) AS n, list_sum([CASE WHEN fails[x] THEN 1 ELSE 0 END FOR x IN ['A', 'B', 'C', 'D', 'E']]) AS k FROM d GROUP BY part, good, bad, fails),
o(filter_order) AS (
  SELECT '' UNION ALL SELECT filter_order || x FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE NOT contains(filter_order, x)),
s AS (
  SELECT filter_order, CAST(i AS INTEGER) AS step, filter_order[i] AS x, filter_order[1:i - 1] AS earlier
  FROM o, (SELECT unnest(range(1, 6)) AS i) WHERE length(filter_order) = 5),
g AS (
  SELECT f.*, s.*, f.fails[s.x] AS own, list_bool_or(list_concat([false], [f.fails[s.filter_order[j]] FOR j IN range(1, s.step)])) AS gone FROM f, s),
r AS (
  SELECT part, filter_order, step, x,
    CAST(coalesce(sum(n) FILTER (NOT own AND NOT gone), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (own AND NOT gone), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (own AND gone), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (own AND k = 1), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(n * good) FILTER (own AND NOT gone), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(n * bad) FILTER (own AND NOT gone), 0) AS BIGINT) AS toxic_lost
  FROM g GROUP BY part, filter_order, step, x)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM r
"""

"""Mixing sources to target weights (8): iterative proportional fitting, in Spark SQL throughout.

1. Every document falls in a cell (source, language, topic); cells hold token sums, made by partial
   aggregates, so a source with a third of all rows costs no task more than its share.
2. The cells' weights are raked: scaled so that each source's sum meets its target, then each
   language's, each topic's, and again, until no margin is off by more than ``tolerance`` or
   ``rounds`` have passed. The cell table is written to the shared folder after each round; only
   the largest error reaches the driver. A margin is a window over cells, of which there are as
   many as combinations of source, language and topic, however many rows there are.
3. A document is kept with the probability ``keep * weight / tokens`` of its cell, 1 at most, by a
   hash of its id and text: the sample is the same in every run and needs no shuffle. What a
   probability above 1 would have added is the document's ``weight``, so weighted token sums meet
   the margins in expectation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import fresh, staged, table

#: Topics by the first pattern that a text matches; the rest is "prose".
TOPICS = [("legal", r"(?i)licen[cs]e|copyright|all rights reserved"), ("technical", r"[{}<>;=\\|]|\$\$|&&"), ("contact", r"@|\+\d|\d{4}")]
DIMENSIONS = ("source", "lang", "topic")


def topic(text: Column, topics=TOPICS) -> Column:
    out = F.lit("prose")
    for name, pattern in reversed(topics):
        out = F.when(text.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def described(docs: DataFrame, text_col: str = "text", seed: int = 0) -> DataFrame:
    """``docs`` with the columns _source, _lang, _topic (never NULL), _tokens (words) and _u, the
    document's own number in [0, 1)."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.withColumns({
        "_source": F.coalesce(F.col("source").cast("string"), F.lit("")), "_lang": F.coalesce(F.col("lang").cast("string"), F.lit("")),
        "_topic": topic(text), "_tokens": F.regexp_count(text, F.lit(r"\S+")).cast("long"),
        "_u": F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", text), 11) / float(1 << 53)})


def tempered(cells: DataFrame, name: str, power: float) -> DataFrame:
    """(name, target) with the tokens' shares raised to ``power``, as shares of 1."""
    sums = cells.groupBy(name).agg(F.sum("tokens").alias("t")).withColumn("t", F.pow(F.col("t").cast("double"), F.lit(power)))
    total = sums.agg(F.sum("t").alias("all"))
    return sums.join(F.broadcast(total), F.lit(True)).select(name, (F.col("t") / F.col("all")).alias("target"))  # one row


def rake(cells: DataFrame, targets: dict[str, DataFrame], *, rounds: int = 30, tolerance: float = 1e-6) -> DataFrame:
    """``cells`` with ``w``: weights of the same total as ``tokens``, whose sums over each dimension
    are the targets' shares. ``targets``: for each column a table (column, target). Values without
    a target get weight 0; targets that no cell can meet are shared out among the others."""
    now = cells.withColumn("w", F.col("tokens").cast("double"))
    for name, goal in targets.items():
        met = cells.where("tokens > 0").select(name).distinct().join(goal, name).where("target > 0")
        total = met.agg(F.sum("target").alias("all"))
        goal = staged(met.join(F.broadcast(total), F.lit(True)).select(name, (F.col("target") / F.col("all")).alias(f"goal{name}")), f"target{name}")
        now = now.join(goal, name, "left")
    n = cells.agg(F.sum("tokens")).first()[0] or 0
    now = staged(now.withColumn("n", F.lit(float(n))), "cells")
    for _ in range(rounds if n else 0):
        now = now.withColumn("e", F.lit(0.0))
        for name in targets:
            sums = F.sum("w").over(Window.partitionBy(name))
            now = now.withColumn("f", F.when(sums > 0, F.coalesce(f"goal{name}", F.lit(0.0)) * F.col("n") / sums).otherwise(0.0))
            now = now.withColumn("e", F.when(F.col("w") > 0, F.greatest("e", F.abs(F.col("f") - 1))).otherwise(F.col("e"))).withColumn("w", F.col("w") * F.col("f"))
        now = staged(now.drop("f"), "cells")
        worst = now.agg(F.max("e")).first()[0]
        if worst is None or worst < tolerance:
            break
    return now.select(*cells.columns, "w")


def calibrated(docs: DataFrame, *, keep: float = 0.9, power: float = 0.9, targets: dict[str, DataFrame] | None = None,
               seed: int = 0, text_col: str = "text") -> DataFrame:
    """``docs`` with _source, _lang, _topic, _tokens, _u and: ``_probability`` (0 to 1), ``_weight``
    (1, or more where the probability would have passed 1), ``_kept``.

    Targets that aren't given are the tokens' own shares raised to ``power``: below 1, small
    sources, languages and topics gain. NULL sources and languages are one value. NULL and empty
    texts have no tokens and take the probability of their cell; in a cell without tokens it is
    ``keep``. Repeated rows are kept or not together, and count in the margins each. A table
    without rows gives none. Columns of the eight new names are replaced; others stay, whatever
    their names.
    """
    p = fresh("_p", docs)
    rows = described(docs, text_col, seed)
    cells = staged(rows.groupBy("_source", "_lang", "_topic").agg(F.sum("_tokens").alias("tokens")), "sums")
    goals = {f"_{d}": None for d in DIMENSIONS}
    for name in goals:
        given = (targets or {}).get(name[1:])
        goals[name] = tempered(cells, name, power) if given is None else given.withColumnRenamed(name[1:], name)
    ratio = F.when(F.col("tokens") > 0, F.col("w") / F.col("tokens")).otherwise(1.0)
    fitted = staged(rake(cells, goals).select("_source", "_lang", "_topic", (keep * ratio).alias(p)), "fitted")
    return (rows.join(fitted, ["_source", "_lang", "_topic"]).withColumn("_probability", F.least(F.col(p), F.lit(1.0)))
            .withColumn("_weight", F.greatest(F.col(p), F.lit(1.0))).withColumn("_kept", F.col("_u") < F.col("_probability")).drop(p))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return calibrated(docs).select("doc_id", "source", "lang", F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"),
                                   F.col("_probability").alias("probability"), F.col("_weight").alias("weight"), F.col("_kept").alias("kept"))

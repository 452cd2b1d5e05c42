"""Corpus preparation: stages over ``documents``, each written as Parquet and read again.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from effort_analytics.llm import minhash_dedup, mixing, pseudonyms, sentencepiece_codec, toxicity
from effort_analytics.llm._common import doc_key, staged, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    return df.select(*COLUMNS)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5. All labelled rows may be learnt from. A NULL
    text is scored as an empty one and stays NULL."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    rows = _documents(docs).withColumn("_own", F.col("text"))
    kept = model.score(rows).where("score < 0.5")
    return _documents(kept.withColumnRenamed("_own", "text"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exactly one row of each group of near duplicates: of those with the smallest id (NULL last)
    and the first set and text by hash, the smallest by its other columns. NULL and blank texts are
    like no other; of wholly repeated ones, and of those without an id, one row of each text stays."""
    groups = minhash_dedup.near_duplicates(docs, k=5, percent=80, row_keys=True).where("kept")
    one = groups.groupBy(F.coalesce("g", F.xxhash64("d", "h"))).agg(F.min(F.struct("d", "h")).alias("x"))
    one = staged(one.select("x.d", "x.h"), "kept")
    d, h = doc_key(F.col("doc_id"), F.coalesce("text", F.lit("")))
    rows = _documents(docs).groupBy(d, h).agg(F.min(F.struct(*COLUMNS)).alias("row"))  # one of each repeated row
    return _documents(rows.join(one, ["d", "h"], "left_semi").select("row.*"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates and names replaced by pseudonyms; n_chars follows the text."""
    out = pseudonyms.pseudonymise(_documents(docs))
    return _documents(out.withColumn("n_chars", F.when(F.col("pii_found") > 0, F.length("text")).otherwise(F.col("n_chars"))))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by their calibrated ratios, so that expected token sums meet the target
    shares: a ratio of 2.4 lets a document stand twice, and a third time with probability 0.4."""
    ratio = F.col("_probability") * F.col("_weight")  # one of them is 1
    times = F.floor(ratio) + (F.col("_u") < ratio - F.floor(ratio)).cast("long")
    rows = mixing.calibrated(_documents(docs)).withColumn("_times", times).where("_times > 0")
    return _documents(rows.withColumn("_time", F.explode(F.sequence(F.lit(1).cast("long"), "_times"))))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_chars, n_tokens, ids, and whether the ids decode to the text."""
    return sentencepiece_codec.encode_documents(docs).select("doc_id", "n_chars", "n_tokens", "ids", "exact")


STAGES = [("toxicity", clean), ("near_dedup", distinct), ("pii", private), ("mixing", mixed), ("sentencepiece", encoded)]
#: SQL can't express a fitted classifier or Viterbi decoding; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

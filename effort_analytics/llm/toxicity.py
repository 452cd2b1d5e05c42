"""Toxicity (10): gradient-boosted trees over dense features, with isotonic calibration.

1. Two lexicons are learnt, each from one half of the rows to fit to: words, and beginnings of words
   of 4, 5 and 6 bytes, that stand in toxic texts far more often than in others, with their log odds.
2. Features of a whole text: densities and strengths of lexicon words, their nearness to words of
   the second person, rates of capitals, of words in capitals, of punctuation, exclamation marks and
   obfuscated words (digits or signs amid letters), and its length.
3. Boosted trees (Spark ML) are fitted to both halves, each with the features that the other half's
   lexicon gives; the isotonic map from their output to a probability is fitted to yet other rows, and
   the lexicon in use comes from both halves.

Labels, language, source and id are no features. Everything that is fitted comes from at most
``sample`` labelled rows, picked by a hash of the id; every document is scored, in one pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _rolling as R
from ._common import batch_of, slices, staged, table
from .minhash_dedup import LOWER

#: Labelled rows that may be used to fit, at most about.
SAMPLE = 24_000
#: Lexicon entries, at most; the least log odds and document count of an entry.
ENTRIES, LEAST_ODDS, LEAST_COUNT = 5_000, 2.5, 3
#: Words that are entries whatever the labels say, and their log odds.
SEED = "idiot idiots stupid moron morons imbecile dumb loser losers trash garbage scum clown pathetic worthless disgusting jerk fool bastard".split()
SEED_ODDS = 4.0
BEGINNINGS = (4, 5, 6)
STEP = 0.02
SECOND_PERSON = ("you your yours yourself u ur thou du dich dir dein deine deinen ihr euch sie ihnen tu te toi ton ta tes vous votre vos "
                 "usted ustedes ti tus vosotros tuyo").split()
NAMES = ["hits", "density", "strength", "strongest", "kinds", "near_you", "you_rate", "capitals", "all_caps", "punctuation", "exclamation", "obfuscated", "log_words"]
_U = np.uint64

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_WORD = _LETTER.copy()
_WORD[[*range(0x30, 0x3A), 0x24, 0x40, 0x2A, 0x27, 0x5F]] = True  # digits $ @ * ' _
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_SIGN = np.zeros(256, bool)
_SIGN[[*range(0x30, 0x3A), 0x24, 0x40, 0x2A]] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def _tokens(data: np.ndarray, at: np.ndarray):
    """Words of a slice, the hash of each, and for each kind of lexicon entry (whole words, then
    beginnings) the hash of each word's entry (0 if too short)."""
    starts, ends, before = R.words(data, at, _WORD)
    low = LOWER[data]
    roll = R.Rolling(R.BYTE_VALUES[low])
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return starts, ends, before, none, [none] * (1 + len(BEGINNINGS))
    whole = roll.hash(starts, ends)
    size = ends - starts
    kinds = [np.where(size >= 3, whole, _U(0))]
    for k in BEGINNINGS:
        kinds.append(np.where(size > k, R.mix(roll.hash(starts, np.minimum(starts + k, ends)) ^ _U(k * 0x51ED270B)), _U(0)))
    return starts, ends, before, whole, kinds


def _entries(batches):
    """(entry, toxic) once for each document and entry."""
    schema = pa.schema([("entry", pa.int64()), ("toxic", pa.int32())])
    for batch in batches:
        toxic = batch.column("toxic").to_numpy()
        for i, _, data, at in slices(batch.column("text")):
            _, _, before, _, kinds = _tokens(data, at)
            doc = np.repeat(np.arange(len(at) - 1), np.diff(before))
            d, h = np.tile(doc, len(kinds)), np.concatenate(kinds)
            d, h = d[h != 0], h[h != 0]
            by = np.lexsort((h, d))
            d, h = d[by], h[by]
            new = np.ones(len(d), bool)
            new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
            yield batch_of(schema, entry=h[new].view(np.int64), toxic=toxic[i + d[new]].astype(np.int32))


def learn_lexicon(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted entries and their log odds, from rows (text, toxic)."""
    n = rows.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    toxic, clean = (n[0] or 0), (n[1] or 0) - (n[0] or 0)
    seen = rows.mapInArrow(_entries, "entry long, toxic int").groupBy("entry").agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n"))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("n") - F.col("t") + 0.5) / (clean + 1.0))
    top = (seen.where(F.col("t") >= LEAST_COUNT).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
           .orderBy(F.desc(F.col("odds") * F.sqrt("t")), "entry").limit(ENTRIES).select("entry", "odds").collect())
    entry = np.array([r.entry for r in top], np.int64).view(np.uint64)
    seed = np.setdiff1d(_words_hash(SEED), entry)
    odds = np.concatenate([np.array([r.odds for r in top], float), np.full(len(seed), SEED_ODDS)])
    entry = np.concatenate([entry, seed])
    order = np.argsort(entry)
    return entry[order], odds[order]


def _words_hash(words: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(w.encode()) for w in words])])
    return np.unique(R.word_hashes(data, at[:-1], at[1:]))


def feature_matrix(data: np.ndarray, at: np.ndarray, entry: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """Features of each text of a slice, in the order of ``NAMES``."""
    n = len(at) - 1
    starts, ends, before, whole, kinds = _tokens(data, at)
    words = np.diff(before)
    doc = np.repeat(np.arange(n), words)
    weight = np.zeros(len(starts))
    which = np.full(len(starts), -1)
    if len(entry) and len(starts):
        for h in kinds:
            i = np.minimum(np.searchsorted(entry, h), len(entry) - 1)
            w = np.where(entry[i] == h, odds[i], 0.0)
            which = np.where(w > weight, i, which)
            weight = np.maximum(weight, w)
    out = np.zeros((n, len(NAMES)))
    per = np.maximum(words, 1)
    total = lambda x: np.bincount(doc, weights=x, minlength=n)
    hit = weight > 0
    out[:, 0] = total(hit)
    out[:, 1] = out[:, 0] / per
    out[:, 2] = total(weight) / np.sqrt(per)
    np.maximum.at(out[:, 3], doc, weight)
    pair = np.unique(doc[hit] * (len(entry) + 1) + which[hit])
    out[:, 4] = np.bincount(pair // (len(entry) + 1), minlength=n)[:n] if len(pair) else 0
    you = np.flatnonzero(np.isin(whole, _words_hash(SECOND_PERSON)))
    out[:, 6] = np.bincount(doc[you], minlength=n) / per
    hits = np.flatnonzero(hit)
    if len(you) and len(hits):
        j = np.searchsorted(you, hits)
        near = np.full(len(hits), 1e9)
        for k in (np.maximum(j - 1, 0), np.minimum(j, len(you) - 1)):
            near = np.minimum(near, np.where(doc[you[k]] == doc[hits], np.abs(you[k] - hits), 1e9))
        np.maximum.at(out[:, 5], doc[hits], 1 / (1 + near))
    sums = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[at])
    letters = np.maximum(sums(_LETTER[data]), 1)
    size = np.maximum(np.diff(at), 1)
    out[:, 7] = sums(_UPPER[data]) / letters
    in_word = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[np.stack([starts, ends])], axis=0)[0] if len(starts) else np.zeros(0)
    upper, letter, sign = in_word(_UPPER[data]), in_word(_LETTER[data]), in_word(_SIGN[data])
    out[:, 8] = total((upper >= 2) & (upper == ends - starts)) / per
    out[:, 9] = sums(_PUNCT[data]) / size
    out[:, 10] = sums(data == 0x21) / size
    out[:, 11] = total((letter >= 2) & (sign >= 1)) / per
    out[:, 12] = np.log1p(words)
    return out


def with_features(docs: DataFrame, lexicon: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``docs`` (with a ``text`` without NULLs, as last column) with the column ``x``, the features
    of the whole text as array<float>, in place of the text."""
    entry, odds = lexicon
    rest = [f for f in docs.schema.fields if f.name != "text"]
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), "x array<float>"])
    names = [f.name for f in rest]

    def run(batches):
        for batch in batches:
            for i, j, data, at in slices(batch.column("text")):
                m = feature_matrix(data, at, entry, odds).astype(np.float32)
                x = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * m.shape[1]), pa.array(m.ravel()))
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), x], names=[*names, "x"])
    return docs.mapInArrow(run, ddl)


class Model:
    """Lexicon, trees and calibration; ``score`` adds the column ``score`` (0 to 1) to documents."""

    def __init__(self, lexicon, trees, calibration, base: float):
        self.lexicon, self.trees, self.calibration, self.base = lexicon, trees, calibration, base

    def score(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """``docs`` with ``score`` in place of the text. NULL texts count as empty."""
        rest = [c for c in docs.columns if c != text_col]
        rows = docs.select(*(F.col(f"`{c}`") for c in rest), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
        rows = with_features(rows, self.lexicon)
        if self.trees is None:  # labels of one kind only, or none
            return rows.drop("x").withColumn("score", F.lit(self.base))
        return _calibrated(_raw(rows, self.trees), self.calibration).select(*(F.col(f"`{c}`") for c in rest), "score")


def _vector(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[f"_{n}" for n in NAMES], outputCol="_v").transform(
        rows.select("*", *(F.col("x")[i].cast("double").alias(f"_{n}") for i, n in enumerate(NAMES)))).drop(*(f"_{n}" for n in NAMES))


def _raw(rows: DataFrame, trees) -> DataFrame:
    return trees.transform(_vector(rows)).withColumn("_raw", vector_to_array("probability")[1])


def _calibrated(rows: DataFrame, calibration) -> DataFrame:
    """``score``: the isotonic map's value (the trees' own without one). Within a step of the map,
    which is flat, documents keep the trees' order: their output moves the score by half of ``STEP`` at most."""
    if calibration is None:
        return rows.withColumn("score", F.col("_raw"))
    score = F.col("_score") + STEP * (F.col("_raw") - 0.5)
    return calibration.transform(rows).withColumn("score", F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)))


def fit(docs: DataFrame, labels: DataFrame, train: Column, *, sample: int = SAMPLE, rounds: int = 20, depth: int = 3,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit to the labelled rows with ``train`` (an expression over ``doc_id``).

    Rows without id or label are left out. Of repeated labels of an id the largest counts.
    """
    marked = (labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("toxic"))
              .where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(train).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    marked = staged(marked, "marked")
    n, toxic = marked.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not toxic or toxic == n:
        return Model((np.zeros(0, np.uint64), np.zeros(0)), None, None, float(toxic / n) if n and toxic else 0.0)
    part = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    picked = marked.where(part < min(1.0, sample / n)).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(10)))
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    rows = staged(texts.join(picked, "doc_id").select("toxic", "part", "text"), "labelled")
    # Ids without a document, or few of them, may leave nothing to learn from.
    kinds = rows.agg(*(F.countDistinct(F.when(F.expr(part), F.col("toxic"))) for part in ("part < 4", "part >= 4 AND part < 8", "part >= 8"))).first()
    if kinds[0] < 2 or kinds[1] < 2:
        return Model((np.zeros(0, np.uint64), np.zeros(0)), None, None, float(toxic / n))
    half, other, rest = (rows.where(part) for part in ("part < 4", "part >= 4 AND part < 8", "part >= 8"))
    # Each half's features come from the other half's lexicon, so the trees see as many hits as in new texts.
    crossed = with_features(half, learn_lexicon(other.select("toxic", "text"))).unionByName(with_features(other, learn_lexicon(half.select("toxic", "text"))))
    trees = GBTClassifier(featuresCol="_v", labelCol="toxic", maxIter=rounds, maxDepth=depth, stepSize=0.2, seed=11, maxMemoryInMB=64).fit(
        _vector(staged(crossed, "features")).select("_v", F.col("toxic").cast("double")))
    lexicon = learn_lexicon(rows.where("part < 8").select("toxic", "text"))
    calibration = None
    if kinds[2] == 2:
        raw = _raw(staged(with_features(rest, lexicon), "features"), trees).select("_raw", F.col("toxic").cast("double").alias("toxic"))
        calibration = IsotonicRegression(featuresCol="_raw", labelCol="toxic", predictionCol="_score").fit(raw)
    return Model(lexicon, trees, calibration, float(toxic / n))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted. ``held_out``: crc32 of the id as text
    is divisible by 5; only other rows' labels are learnt. A NULL id is not held out. NULL and
    empty texts are scored as texts without words. Repeated rows are each scored. Other columns are
    left out."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = fit(docs, labels, ~held)
    out = model.score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

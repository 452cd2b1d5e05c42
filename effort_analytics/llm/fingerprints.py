"""Document fingerprints (2): a homomorphic multiset hash of a text's paragraphs.

Each non-empty paragraph is hashed to a wide vector, and a document's fingerprint is their sum,
lane by lane, modulo 2**16. So it doesn't depend on the paragraphs' order, and inserting or
deleting a paragraph adds or subtracts its vector. The first lanes come from an extendable-output
hash (SHAKE-128) of the paragraph: equal sums mean equal multisets. The other lanes are a signed
sketch of its word pairs; sums of these are close where texts share most of their paragraphs, and
their cosine estimates how much (an error of about 1/16).
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _rolling as R
from ._common import batch_of, keyed, table

HASH_LANES, SKETCH_LANES = 128, 256
_NOT_SPACE = np.ones(256, bool)
_NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
_U = np.uint64


def vectors(texts: list[bytes]) -> np.ndarray:
    """The fingerprint (uint16 lanes) of each text: the sum of its paragraphs' vectors."""
    parts = [[p for p in t.split(b"\n") if p] for t in texts]
    sizes = np.array([len(p) for p in parts], np.int64)
    flat = [p for ps in parts for p in ps]
    out = np.zeros((len(texts), HASH_LANES + SKETCH_LANES), np.uint16)
    if not flat:
        return out
    wide = np.frombuffer(b"".join(hashlib.shake_128(p).digest(2 * HASH_LANES) for p in flat), np.uint16).reshape(-1, HASH_LANES)
    some = np.flatnonzero(sizes)
    first = (np.cumsum(sizes) - sizes)[some]
    out[some, :HASH_LANES] = np.add.reduceat(wide, first, axis=0, dtype=np.uint16)
    data = np.frombuffer(b"".join(flat), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(p) for p in flat])])
    starts, ends, before = R.words(data, at, _NOT_SPACE)
    roll = R.Rolling(R.word_hashes(data, starts, ends))
    n = np.diff(before)
    pairs = np.maximum(n - 1, np.minimum(n, 1))  # a lone word counts as a pair
    par = np.repeat(np.arange(len(n)), pairs)
    s = np.arange(len(par)) + np.repeat(before[:-1] - (np.cumsum(pairs) - pairs), pairs)
    x = roll.hash(s, np.minimum(s + 2, before[1:][par]))
    doc = np.repeat(np.arange(len(texts)), sizes)[par]
    lane = (x >> _U(32)) % _U(SKETCH_LANES)
    sums = np.bincount(doc * SKETCH_LANES + lane.astype(np.int64), weights=np.where(x & _U(1), 1.0, -1.0), minlength=len(texts) * SKETCH_LANES)
    out[:, HASH_LANES:] = sums.astype(np.int64).astype(np.uint16).reshape(len(texts), -1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 for equal fingerprints, else the cosine of the sketches, 0 at least and less than 1."""
    x, y = (v[:, HASH_LANES:].view(np.int16).astype(float) for v in (a, b))
    size = np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
    cos = np.divide((x * y).sum(axis=1), size, out=np.zeros(len(x)), where=size > 0)
    return np.where((a == b).all(axis=1), 1.0, np.clip(cos, 0.0, 1 - 1e-9))


def _hex(v: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in v]


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(rows: list[tuple[int | None, str]], following: str) -> dict:
    """Digest columns of consecutive documents; ``following`` is the text after the last."""
    heads, olds, news, digests, sizes = [], [], [], [], []
    for i, (_, text) in enumerate(rows):
        then = rows[i + 1][1] if i + 1 < len(rows) else following
        n = len(text)
        keep, k = n - n // 4, n // 4
        edited = text[:keep] + then[:k]
        cut = text.rfind("\n", 0, keep) + 1  # paragraphs before stay as they are
        heads.append(text[:cut].encode())
        olds.append(text[cut:].encode())
        news.append(edited[cut:].encode())
        digests.append(hashlib.sha256(edited.encode()).hexdigest())
        sizes.append(n)
    old = vectors([*olds, following.encode()])
    own = vectors(heads) + old[:-1]
    edited = own - old[:-1] + vectors(news)  # deletion and insertion
    then = np.concatenate([own[1:], old[-1:]])
    return {"n_chars": sizes, "edited_sha256": digests, "fingerprint": _hex(own), "edited_fingerprint": _hex(edited),
            "near_edited": likeness(own, edited), "near_next": likeness(own, then)}


def _walk(batches):
    """Each document with the one after it: rows (b, d, doc_id, text, own), sorted; those of other
    buckets (own false) only close their bucket."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    held: list[tuple[int | None, str]] = []
    size, bucket, closed = 0, None, True
    for batch in batches:
        for b, doc_id, text, own in zip(*(batch.column(c).to_pylist() for c in ("b", "doc_id", "text", "own")), strict=True):
            if b != bucket:
                bucket, closed = b, False
            if held and not closed and (size > 1 << 20 or not own):
                yield batch_of(schema, doc_id=pa.array([h[0] for h in held], pa.int64()), **_compare(held, text))
                held, size = [], 0
            closed = closed or not own
            if own:
                held.append((doc_id, text))
                size += len(text)


def edited_fingerprints(docs: DataFrame, *, buckets: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_chars, the digest of its edited text (the last quarter of its
    code points replaced by the first as many of the next document), the fingerprints of both, and
    how like its fingerprint is to the edited text's and to the next document's.

    Documents go to ``buckets`` ranges of (id, text hash), a task each (default: the shuffle
    partitions), with one shuffle of the texts; the first document of each range also goes to the
    range before, as its end. An id that fills several ranges (NULL, or one that many rows share) is
    split evenly by the texts' hashes; only rows that repeat both id and text stay together, and they
    are streamed. The order is by id, then text hash; NULL ids come last; repeated rows follow one
    another. NULL and empty texts have no paragraphs and the zero vector. A lone document is its own
    next. Other columns are left out.
    """
    spark = docs.sparkSession
    rows = keyed(docs, id_col, text_col)
    buckets = max(buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    cuts = []
    if buckets > 1:
        cuts = rows.agg(F.percentile_approx("d", F.array(*(F.lit(i / buckets) for i in range(1, buckets))), 10_000)).first()[0] or []
    cuts = sorted(cuts)
    times = {d: n for d, n in Counter(cuts).items() if n > 1}
    below = F.size(F.filter(F.array(*(F.lit(c) for c in cuts)), lambda c: c < F.col("d"))) if cuts else F.lit(0)
    split, part = F.lit(None).cast("long"), F.lit(0)
    if times:
        many = F.element_at(F.create_map(*(F.lit(x) for pair in times.items() for x in pair)), F.col("d"))
        share = F.shiftrightunsigned(F.col("h").bitwiseXOR(F.lit(-(2**63))), 33)  # 31 bits, in the hashes' order
        split, part = F.when(many.isNotNull(), F.col("h")), F.coalesce(F.shiftright(share * many, 31).cast("int"), F.lit(0))
    rows = rows.withColumn("b", below + part)
    firsts = rows.groupBy("b").agg(F.min(F.struct("d", split.alias("h"))).alias("first")).orderBy("b").collect()  # ``buckets`` rows at most
    if not firsts:
        return spark.createDataFrame([], _OUT)
    ends = [(firsts[i].first.d, firsts[i].first.h, firsts[i - 1].b) for i in range(len(firsts))]
    ends = spark.createDataFrame(ends, "end_d long, end_h long, close int")
    rows = rows.join(F.broadcast(ends), (F.col("d") == F.col("end_d")) & F.coalesce(F.col("h") == F.col("end_h"), F.lit(True)), "left")
    both = F.array(F.struct("b", F.lit(True).alias("own")), F.struct(F.col("close").alias("b"), F.lit(False).alias("own")))
    rows = rows.select("d", "h", "doc_id", "text", F.inline(F.filter(both, lambda x: x.b.isNotNull())))
    return (rows.repartitionById(buckets, "b").sortWithinPartitions("b", F.desc("own"), "d", "h").select("b", "doc_id", "text", "own").mapInArrow(_walk, _OUT))


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))

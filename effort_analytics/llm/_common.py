"""Helpers shared by the operators: table access, staged tables, text columns of Arrow batches."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a NULL doc_id inside the operators; it sorts after every other id.
NO_ID = 2**63 - 1
#: Texts are worked on in slices of whole documents of about this many bytes.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where that is unset, a session whose only executor is
    this process (``local[..]``, as in tests) gets a fresh one; on a cluster it raises."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = found.get() if found.isDefined() else None
    if not path and spark.sparkContext.master.partition("[")[0] != "local":
        raise RuntimeError("spark.checkpoint.dir is not set; configure a folder that all executors share")
    if not path:
        path = tempfile.mkdtemp(prefix="llm-stage-")
        spark.sparkContext.setCheckpointDir(path)  # the setting itself can't be changed in a running session
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there, and a lost
    executor costs no recomputation of what came before."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(name: str, df: DataFrame) -> str:
    """``name``, or the next like it that is no column of ``df``."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = f"_{name}"
    return name


def doc_key(doc_id: Column, text: Column) -> list[Column]:
    """Internal identity of a document row: the id (NULL: ``NO_ID``) and the text's 64-bit hash, so
    that rows that share an id but not the text are kept apart; rows that repeat id and text share it. It
    sorts as the unsigned hash."""
    return [F.coalesce(doc_id.cast("long"), F.lit(NO_ID)).alias("d"),
            F.xxhash64(text).bitwiseXOR(F.lit(-(2**63))).alias("h")]


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(d, h, doc_id, text) of every row; a NULL text is empty. Other columns are left out."""
    t = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                    F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return t.select(*doc_key(F.col("doc_id"), F.col("text")), "doc_id", "text")


def byte_rows(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary Arrow column without NULLs, and the rows' offsets in them."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    col = col.cast(pa.large_binary())
    at = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), at


def slices(col, limit: int = SLICE_BYTES):
    """(first row, end row, bytes, offsets from 0) of runs of whole rows of about ``limit`` bytes."""
    data, at = byte_rows(col)
    n, i = len(at) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield i, j, data[at[i]:at[j]], at[i:j + 1] - at[i]
        i = j


def batch_of(schema: pa.Schema, **cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) if not isinstance(cols[f.name], pa.Array)
                                       else cols[f.name] for f in schema], schema=schema)

"""Spark session and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of this library wants. AQE re-plans joins from
# runtime sizes (broadcast when a side turns out small, split skewed
# partitions), coalesces tiny shuffle partitions, and keeps ANSI on.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # PySpark 4 records the Python call site of every API call for error
    # messages (several JVM round trips each); plans here are built from
    # hundreds of calls, so keep plan construction cheap.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "effort_analytics", extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    On a cluster leave ``master`` unset so spark-submit decides; tests pass
    ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors for checkpoints and staged tables, as
    ``spark.checkpoint.dir`` or the context names it. Where neither does, a session
    whose only executor is this process (``local[..]``, as in tests) gets a folder of
    its own; on a cluster it raises."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = jdir.get() if jdir.isDefined() else None
    if path:
        return path
    if spark.sparkContext.master.partition("[")[0] == "local":
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ea-shared-"))
        return spark.sparkContext._jsc.sc().getCheckpointDir().get()
    raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: it is worked out once, however
    often the result is used, and a lost executor costs no more than reading it."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

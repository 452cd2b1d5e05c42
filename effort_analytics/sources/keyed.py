"""Tables kept by key bucket and published in one step.

An upsert reads the buckets that its source touches, writes their merged rows to a folder of its own
(``part=..``) and then makes a version (:mod:`.versions`) that takes those buckets from the new
folder and the others from where they were. Nothing that a version names is ever overwritten: a
write that fails, at whatever bucket, leaves the table as it was, and readers never see half of one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import versions
from .sinks import with_key_bucket


def _layout(spark: SparkSession, path: str, layout: dict) -> tuple[int, dict]:
    found = versions.current(spark, path)
    if found is None:
        return 0, {"layout": layout, "schema": None, "parts": {}, "streams": {}}
    if found[1]["layout"] != layout:
        raise ValueError(f"{path} is stored with {found[1]['layout']}, not {layout}")
    return found


def _read(spark: SparkSession, path: str, content: dict, buckets=None, with_bucket: bool = False) -> DataFrame:
    column = content["layout"]["column"]
    schema = StructType.fromJson(content["schema"])
    wanted = None if buckets is None else set(buckets)
    paths = [f"{path.rstrip('/')}/{part}/{column}={b}" for part, own in content["parts"].items()
             for b in own["buckets"] if wanted is None or b in wanted]
    names = schema.fieldNames() + ([column] if with_bucket else [])
    if not paths:
        return spark.createDataFrame([], schema).withColumn(column, F.lit(0)).select(*names)
    # one scan of the named folders; columns that older files lack are NULL in them
    return spark.read.schema(schema).format(content["layout"]["fmt"]).option("basePath", path).load(paths).select(*names)


def read_keyed(spark: SparkSession, path: str, buckets=None) -> DataFrame:
    """The current rows of the table, or those of the named buckets."""
    found = versions.current(spark, path)
    if found is None:
        raise FileNotFoundError(f"no version of a table at {path}")
    return _read(spark, path, found[1], buckets)


def upsert_keyed(source: DataFrame, path: str, keys, *, buckets: int = 256, column: str = "key_bucket",
                 fmt: str = "parquet", files_per_bucket: int = 1, stream: tuple[str, int] | None = None) -> int | None:
    """Upsert ``source`` by ``keys``; the number of the version made, None where nothing changed.

    A non-NULL key held by two source rows raises, as a merge would. Columns that the table lacks
    are added to it. Keys, bucket count and format are part of the table; others raise. Of two
    upserts at a time one raises :class:`versions.ConcurrentWrite` and can be run again.
    ``stream`` (name, batch id) is kept in the version: a batch that is in the table already changes
    nothing. The source, read several times, is checkpointed to ``spark.checkpoint.dir`` first.
    """
    from ..operators.tables import require_unique_keys, row_hash, upsert
    from ..session import shared_dir
    spark = source.sparkSession
    shared_dir(spark)
    keys = [keys] if isinstance(keys, str) else list(keys)
    number, content = _layout(spark, path, {"keys": keys, "buckets": buckets, "column": column, "fmt": fmt})
    if stream is not None and content["streams"].get(stream[0], -1) >= stream[1]:
        return None
    src = with_key_bucket(source, keys, buckets, column).checkpoint(eager=True)
    require_unique_keys(src, keys)
    touched = sorted(r[0] for r in src.select(column).distinct().collect())  # at most ``buckets`` numbers
    if not touched and number and stream is None:
        return None
    merged = src
    if content["schema"] and touched:
        stored = _read(spark, path, content, touched, with_bucket=True)
        added = {n: F.lit(None).cast(t) for n, t in src.dtypes if n not in stored.columns}
        merged = upsert(stored.withColumns(added), src, keys)
    schema = merged.drop(column).schema
    parts = {name: {"buckets": [b for b in own["buckets"] if b not in set(touched)]} for name, own in content["parts"].items()}
    if touched:
        part = f"part={uuid.uuid4().hex}"
        spread = F.pmod(row_hash(merged), F.lit(files_per_bucket)).alias("_spread")
        out = merged.select("*", spread).repartition(F.col(column), F.col("_spread")).drop("_spread")
        out.write.mode("errorifexists").format(fmt).partitionBy(column).save(f"{path.rstrip('/')}/{part}")
        parts[part] = {"buckets": touched}
    new = {"layout": content["layout"], "schema": (schema if touched or not content["schema"] else StructType.fromJson(content["schema"])).jsonValue(),
           "parts": {k: v for k, v in parts.items() if v["buckets"]}, "streams": content["streams"] | ({stream[0]: stream[1]} if stream else {})}
    return versions.commit(spark, path, new, number)


def register_keyed(spark: SparkSession, database: str, table: str, path: str) -> None:
    """Make the table's current version a view ``database.table``, in one step where it exists."""
    found = versions.current(spark, path)
    if found is None:
        raise FileNotFoundError(f"no version of a table at {path}")
    content = found[1]
    layout, schema = content["layout"], StructType.fromJson(content["schema"])
    selects = []
    for part, own in content["parts"].items():
        folder = f"{path.rstrip('/')}/{part}"
        have = set(spark.read.format(layout["fmt"]).load(folder).columns)
        columns = ", ".join(f"`{f.name}`" if f.name in have else f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
        numbers = ", ".join(str(b) for b in own["buckets"])
        selects.append(f"SELECT {columns} FROM {layout['fmt']}.`{folder}` WHERE {layout['column']} IN ({numbers})")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    name = f"`{database}`.`{table}`"
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        raise ValueError(f"{name} is a table, not a view of {path}; it is left alone")
    body = " UNION ALL ".join(selects) or "SELECT " + ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema) + " WHERE false"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {body}")

"""Writers and catalogue maintenance.

Plain Parquet folders plus catalogue entries (no table-format jar is needed).
Rewrites never overwrite the folder the plan reads: a new version folder is
written, then the table is pointed at it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from . import versions


def write_table(df: DataFrame, path: str, *, mode: str = "overwrite", fmt: str = "parquet",
                partition_by=None, table: str | None = None) -> None:
    """Write ``df`` to ``path`` (overwrite / append); optionally register it as an
    external catalogue table ``table`` at that path."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if table:
        w.option("path", path).saveAsTable(table)
    else:
        w.save(path)


def append_load(df: DataFrame, path: str, load_id: str, *, fmt: str = "parquet",
                column: str = "load_id") -> None:
    """Idempotent append: rows carry ``load_id`` as a partition and a rerun of the
    same load replaces only its own partition (dynamic partition overwrite), so a
    rerun never doubles the hours."""
    from pyspark.sql import functions as F
    (df.withColumn(column, F.lit(load_id)).write.mode("overwrite").format(fmt)
     .option("partitionOverwriteMode", "dynamic").partitionBy(column).save(path))


def read_evolving(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a folder whose appends added columns over time (schema merge)."""
    return spark.read.option("mergeSchema", True).format(fmt).load(path)


def register_table(spark: SparkSession, database: str, table: str, path: str, fmt: str = "parquet") -> None:
    """Create the database if needed, register an external table over ``path``, and refresh its
    cached metadata. A table that is registered at another location is switched to this one."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    name = f"`{database}`.`{table}`"
    _recreate_if_changed(spark, name, spark.read.option("mergeSchema", True).format(fmt).load(path), path)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} OPTIONS (mergeSchema 'true') LOCATION '{path}'")
    if spark.sql(f"DESCRIBE TABLE {name}").where("col_name = '# Partition Information'").count():
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.sql(f"REFRESH TABLE {name}")


def _qualified(spark: SparkSession, path: str) -> str:
    """The path as the catalogue stores it: with scheme and authority, no slash at the end."""
    fs, p = versions.hadoop(spark, path)
    return fs.makeQualified(p).toUri().toString().rstrip("/").replace(":///", ":/")


def _recreate_if_changed(spark: SparkSession, name: str, stored: DataFrame, path: str) -> None:
    """Bring the entry of an external table up to the data at ``path``. Another location is
    switched to in one step; where the columns are others too, or the table has partitions (whose
    entries name places of their own), the entry is dropped, for the caller to create again. The
    data of either location stay."""
    if not spark.catalog.tableExists(name):
        return
    told = [(r["col_name"], r["data_type"]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()]
    kind = dict(told)
    if kind.get("Type") != "EXTERNAL":
        raise ValueError(f"{name} is not an external table; it is left alone")
    moved = _qualified(spark, kind["Location"]) != _qualified(spark, path)
    if dict(spark.table(name).dtypes) != dict(stored.dtypes) or (moved and ("# Partition Information", "") in told):
        spark.sql(f"DROP TABLE {name}")
    elif moved:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")


def create_table(spark: SparkSession, name: str, ddl_columns: str, path: str, fmt: str = "parquet") -> None:
    """``CREATE TABLE IF NOT EXISTS name (cols) USING fmt LOCATION path``."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl_columns}) USING {fmt} LOCATION '{path}'")


def insert_into(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """Insert by position into an existing table."""
    df.write.insertInto(table, overwrite=overwrite)


def replace_table(df: DataFrame, base_path: str, table: str | None = None, *, fmt: str = "parquet") -> str:
    """Write ``df`` to a fresh version folder under ``base_path`` and return it.

    The folder becomes the current version (:func:`versions.read_current`), and
    with ``table`` the catalogue entry is switched to it (and created when
    missing). Because the old folder is untouched, ``df`` may read the table it
    replaces (upsert), and a failed write leaves the table as it was. The
    written folder also cuts the plan's lineage. :func:`versions.clean` deletes
    versions that are no longer wanted.
    """
    spark = df.sparkSession
    found = versions.current(spark, base_path)
    folder = f"v={uuid.uuid4().hex}"
    version = f"{base_path.rstrip('/')}/{folder}"
    df.write.mode("errorifexists").format(fmt).save(version)
    versions.commit(spark, base_path, {"folder": folder}, found[0] if found else 0)
    if table:
        if "." in table:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{table.split('.')[0]}`")
        _recreate_if_changed(spark, table, spark.read.format(fmt).load(version), version)
        if spark.catalog.tableExists(table):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
            spark.sql(f"REFRESH TABLE {table}")
        else:
            spark.sql(f"CREATE TABLE {table} USING {fmt} LOCATION '{version}'")
    return version


def export_single_csv(df: DataFrame, file_path: str, *, header: bool = True) -> str:
    """Write ``df`` as exactly one CSV file at ``file_path``.

    For small results only (a report): all rows pass through one task. The part
    file is written to a staging folder next to the target and moved with the
    Hadoop file system API, which works on any cluster file system. A file that
    is there is moved aside first and deleted last; if the new one can't be
    moved in, the old one is moved back.
    """
    spark = df.sparkSession
    staging = file_path.rstrip("/") + "_staging_" + uuid.uuid4().hex
    df.coalesce(1).write.mode("errorifexists").option("header", header).csv(staging)
    fs, folder = versions.hadoop(spark, staging)
    parts = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".csv")]
    if not parts:  # no rows: the header only
        versions.write_text(spark, f"{staging}/part.csv", ",".join(df.columns) + "\n" if header else "")
        parts = [versions.hadoop(spark, f"{staging}/part.csv")[1]]
    try:
        _move_in(fs, parts[0], versions.hadoop(spark, file_path)[1], versions.hadoop(spark, f"{staging}/old.csv")[1])
    finally:
        fs.delete(folder, True)
    return file_path


def _move_in(fs, new, target, aside) -> None:
    """Put the file ``new`` in the place of ``target``, which is kept at ``aside`` until then."""
    had = fs.exists(target)
    if had and not fs.rename(target, aside):
        raise OSError(f"{target} can't be moved aside")
    try:
        done = fs.rename(new, target)
    except Exception:
        done = False
        raise
    finally:
        if had and not done:
            fs.rename(aside, target)
    if not done:
        raise OSError(f"{new} can't be moved to {target}")


def with_key_bucket(df: DataFrame, keys, buckets: int, column: str = "key_bucket") -> DataFrame:
    """Add the storage bucket of each row's key: ``pmod(xxhash64(keys), buckets)``. A row with a
    NULL key, which matches no other, goes by a hash of the whole row, so that such rows share no bucket."""
    from pyspark.sql import functions as F
    from ..operators.tables import _has_null, row_hash
    keys = [keys] if isinstance(keys, str) else list(keys)
    by_key = F.xxhash64(*[F.col(k) for k in keys])
    by = F.when(_has_null(keys), row_hash(df)).otherwise(by_key)
    return df.withColumn(column, F.pmod(by, F.lit(buckets)).cast("int"))


LAYOUT_FILE = "_key_layout.json"  # the leading underscore hides it from readers of the folder


def _check_layout(spark: SparkSession, path: str, layout: dict) -> bool:
    """True if a table of this layout is at ``path``; False (and the layout is written) if there is
    none. Another layout, or data without one, raises: rows would be looked for in wrong buckets."""
    fs, file = versions.hadoop(spark, f"{path.rstrip('/')}/{LAYOUT_FILE}")
    _, root = versions.hadoop(spark, path)
    loaded = fs.exists(root) and any(s.isDirectory() and "=" in s.getPath().getName() for s in fs.listStatus(root))
    if not fs.exists(file):
        if loaded:
            raise ValueError(f"{path} holds data but no {LAYOUT_FILE}; its bucket count is unknown")
        out = fs.create(file, True)
        out.write(bytearray(json.dumps(layout), "utf-8"))
        out.close()
        return False
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(file)))
    stored = json.loads(reader.readLine())
    reader.close()
    if stored != layout:
        raise ValueError(f"{path} is stored with {stored}, not {layout}")
    return loaded


def read_key_buckets(spark: SparkSession, path: str, touched: list[int], *, column: str = "key_bucket",
                     fmt: str = "parquet") -> DataFrame:
    """The rows of the named buckets: a filter on the partition column by values, so that other
    buckets are not listed into tasks."""
    from pyspark.sql import functions as F
    return spark.read.option("mergeSchema", True).format(fmt).load(path).where(F.col(column).isin(touched))


def upsert_partitions(source: DataFrame, path: str, keys, *, buckets: int = 256, column: str = "key_bucket",
                      fmt: str = "parquet", files_per_bucket: int = 1) -> None:
    """Keyed upsert into a table stored partitioned by key bucket, reading and
    rewriting only the buckets the source touches.

    1. the layout (keys, bucket count) is stored with the table; another one raises;
    2. the source rows get their bucket and are checkpointed, since they are read
       several times; a non-NULL key held twice raises, as a merge would;
    3. the touched buckets, ``buckets`` numbers at most, become a filter on the
       partition column (:func:`read_key_buckets`); their rows are merged with the
       source (:func:`operators.upsert`);
    4. the merge is checkpointed to ``spark.checkpoint.dir`` (reliable, cuts the
       lineage to the partitions it replaces), dealt out by bucket and one of
       ``files_per_bucket`` parts, then written with dynamic partition overwrite.

    The first load (no table at ``path`` yet) writes every bucket. An empty source
    changes nothing. ``spark.checkpoint.dir`` must be set.
    """
    from pyspark.sql import functions as F
    from ..operators.tables import require_unique_keys, row_hash, upsert
    from ..session import shared_dir
    spark = source.sparkSession
    shared_dir(spark)
    keys = [keys] if isinstance(keys, str) else list(keys)
    exists = _check_layout(spark, path, {"keys": keys, "buckets": buckets, "column": column})
    src = with_key_bucket(source, keys, buckets, column).checkpoint(eager=True)
    require_unique_keys(src, keys)
    merged = src
    if exists:
        touched = sorted(r[0] for r in src.select(column).distinct().collect())  # at most ``buckets`` numbers
        if not touched:
            return
        stored = read_key_buckets(spark, path, touched, column=column, fmt=fmt)
        added = {n: F.lit(None).cast(t) for n, t in src.dtypes if n not in stored.columns}
        merged = upsert(stored.withColumns(added), src, keys).checkpoint(eager=True)
    part = F.pmod(row_hash(merged), F.lit(files_per_bucket)).alias("_part")
    out = merged.select("*", part).repartition(F.col(column), F.col("_part")).drop("_part")
    (out.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic")
     .partitionBy(column).save(path))

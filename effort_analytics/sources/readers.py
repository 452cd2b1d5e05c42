"""Readers: JSON, CSV (tagged with file name), workbooks, catalogue tables.

Every reader is one distributed scan; file lists never go through the driver
and the plan size does not depend on the number of files.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from . import versions, xlsx


def string_schema(columns) -> StructType:
    """All-text schema for raw sources (typing happens in the refine step)."""
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON (lines or multi-line) folder. Pass a schema in production: inference
    costs an extra pass over the files."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def parse_json_column(df: DataFrame, column: str, schema: StructType | str) -> DataFrame:
    """Parse a JSON text column into top-level columns (``from_json``); a malformed
    document gives NULLs, not an error."""
    parsed = F.from_json(F.col(column), schema, {"mode": "PERMISSIVE"})
    return df.select("*", parsed.alias("_j")).select(*df.columns, "_j.*")


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None, header: bool = True,
             **options) -> DataFrame:
    r = spark.read.option("header", header)
    for k, v in options.items():
        r = r.option(k, v)
    if schema is not None:
        r = r.schema(schema)
    elif "inferSchema" not in options:
        r = r.option("inferSchema", False)
    return r.csv(path)


def read_csv_tagged(spark: SparkSession, path: str, schema: StructType | None = None,
                    file_column: str = "FileName", header: bool = True) -> DataFrame:
    """Every CSV file under ``path`` in one scan, each row tagged with its file
    name (the per-file read + union loop, without the loop)."""
    df = read_csv(spark, path, schema, header)
    return df.withColumn(file_column, F.col("_metadata.file_name"))


def read_workbooks(spark: SparkSession, path: str, sheet: str, columns, *,
                   glob: str = "*.xlsx", file_column: str | None = None,
                   recursive: bool = True, batch_rows: int = 4096) -> DataFrame:
    """The named sheet of every ``.xlsx`` workbook under ``path``.

    A Spark job: ``binaryFile`` lists and reads the files on the executors and
    ``mapInArrow`` parses each workbook inside its task (standard-library zip +
    XML), row by row: beside the files of the task's partition (at most
    ``spark.sql.files.maxPartitionBytes``, or one file) it holds one sheet's
    shared texts and ``batch_rows`` rows. The first row is the header; cells are
    returned as text under the given ``columns`` (missing headers give NULL,
    extra ones are ignored). Date-formatted cells come out as ISO ``yyyy-MM-dd``
    text, in either date system (1900, 1904).
    """
    columns = list(columns)
    schema = string_schema(columns + ([file_column] if file_column else []))
    # ship the parser with the task closure, so executors need no install of this package
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(xlsx)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", str(recursive).lower()).load(path)
             .select("path", "content"))
    return files.mapInArrow(workbook_rows(sheet, columns, file_column, batch_rows), schema)


def workbook_rows(sheet: str, columns: list[str], file_column: str | None, batch_rows: int):
    """Batches (path, content) -> batches of ``batch_rows`` rows at most of the named sheet."""
    def parse(batches):
        import pyarrow as pa
        names = columns + ([file_column] if file_column else [])
        schema = pa.schema([(n, pa.string()) for n in names])

        def packed(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], schema=schema)

        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column("path")[i].as_py().rsplit("/", 1)[-1]
                rows = []
                for rec in xlsx.sheet_records(batch.column("content")[i].as_buffer(), sheet):
                    rows.append([rec.get(c) for c in columns] + ([name] if file_column else []))
                    if len(rows) == batch_rows:
                        yield packed(rows)
                        rows = []
                if rows:
                    yield packed(rows)
    return parse


def _value(name: str) -> tuple[int, int, str]:
    """Order of folder names: whole numbers by value, before them all others, as text."""
    value = name.split("=", 1)[-1]
    return (1, int(value), "") if value.isdigit() else (0, 0, value)


def newest_partitions(spark: SparkSession, path: str, levels=("y", "m", "d", "hm"), by=()) -> list[dict[str, str]]:
    """The newest ``level=value`` folder under ``path``, for each group of the levels ``by`` (the
    outer folders): a list of {level: value}.

    Folder names are all that is read, and only those on the way: the children of ``path``, of
    each group, and of the newest folder at each level below. Values compare as whole numbers where
    they are such; empty folders and those of other names are passed over.
    """
    fs, root = versions.hadoop(spark, path)

    def children(folder, level):
        return [(s.getPath(), s.getPath().getName()) for s in fs.listStatus(folder)
                if s.isDirectory() and s.getPath().getName().startswith(f"{level}=")]

    def newest(folder, left):
        if not left:
            return {} if any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(folder)) else None
        for p, name in sorted(children(folder, left[0]), key=lambda x: _value(x[1]), reverse=True):
            below = newest(p, left[1:])
            if below is not None:
                return {left[0]: name.split("=", 1)[1], **below}
        return None

    groups = [(root, {})]
    for level in by:
        groups = [(p, {**of, level: name.split("=", 1)[1]}) for folder, of in groups for p, name in sorted(children(folder, level), key=lambda x: x[1])]
    found = [(of, newest(folder, list(levels))) for folder, of in groups]
    return [{**of, **last} for of, last in found if last is not None]


def read_newest(spark: SparkSession, path: str, levels=("y", "m", "d", "hm"), by=(), fmt: str = "parquet", schema: StructType | str | None = None) -> DataFrame:
    """The rows of the newest snapshot of a partitioned table, per group ``by``: one scan, whose
    partition filter is the folders that :func:`newest_partitions` names."""
    r = spark.read.format(fmt)
    df = (r.schema(schema) if schema is not None else r).load(path)
    wanted = F.lit(False)
    for folder in newest_partitions(spark, path, levels, by):
        this = F.lit(True)
        for level, value in folder.items():
            null = value == "__HIVE_DEFAULT_PARTITION__"
            this = this & (F.col(level).isNull() if null else F.col(level) == F.lit(unquote(value)).cast(df.schema[level].dataType))
        wanted = wanted | this
    return df.where(wanted)


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A catalogue table by name, or a folder by path."""
    if "/" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)

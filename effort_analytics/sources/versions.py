"""Versions of a folder: data are written aside and become current in one step.

``base/_versions/<number>.json`` says what makes up each version of the table at ``base``; the
highest number is the current one. A writer puts its data in folders that no version names yet, and
then adds the next file by a rename, which either happens or doesn't: readers see the old version or
the new one whole. Where two writers start from the same version, the second one's rename fails.
(The file system's rename must refuse an existing name, as HDFS and local ones do.)
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

FOLDER = "_versions"  # the leading underscore hides it from readers of the folder


class ConcurrentWrite(RuntimeError):
    """Another writer has made a version since the one that this write started from."""


def hadoop(spark: SparkSession, path: str):
    """(file system, path object) of a path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def read_text(spark: SparkSession, path: str) -> str:
    fs, file = hadoop(spark, path)
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(file), "UTF-8"))
    try:
        lines = []
        while (line := reader.readLine()) is not None:
            lines.append(line)
        return "\n".join(lines)
    finally:
        reader.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, file = hadoop(spark, path)
    out = fs.create(file, True)
    out.write(bytearray(text, "utf-8"))
    out.close()


def numbers(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the versions, ascending."""
    fs, folder = hadoop(spark, f"{base.rstrip('/')}/{FOLDER}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _file(base: str, number: int) -> str:
    return f"{base.rstrip('/')}/{FOLDER}/{number:012d}.json"


def current(spark: SparkSession, base: str) -> tuple[int, dict] | None:
    """Number and content of the current version, if there is one."""
    have = numbers(spark, base)
    return (have[-1], json.loads(read_text(spark, _file(base, have[-1])))) if have else None


def commit(spark: SparkSession, base: str, content: dict, after: int) -> int:
    """Make ``content`` the version after number ``after`` (0: the first one)."""
    jvm = spark.sparkContext._jvm
    new = f"{base.rstrip('/')}/{FOLDER}/.{uuid.uuid4().hex}"
    write_text(spark, new, json.dumps(content))
    options = jvm.java.lang.reflect.Array.newInstance(jvm.org.apache.hadoop.fs.Options.Rename.NONE.getClass(), 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    fs, source = hadoop(spark, new)
    _, target = hadoop(spark, _file(base, after + 1))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(source, target, options)
    except Exception as e:
        fs.delete(source, False)
        if after + 1 in numbers(spark, base):
            raise ConcurrentWrite(f"version {after + 1} of {base} was written meanwhile") from e
        raise
    return after + 1


def read_current(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame | None:
    """The current version of a table that is rewritten whole (``sinks.replace_table``), if any."""
    found = current(spark, base)
    return None if found is None else spark.read.format(fmt).load(f"{base.rstrip('/')}/{found[1]['folder']}")


def folders(content: dict) -> set[str]:
    """Data folders that a version is made of."""
    return {content["folder"]} if "folder" in content else set(content["parts"])


def clean(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Delete the versions before the last ``keep``, and the data folders (``v=..``, ``part=..``)
    that were made up by them alone; the folders' names are returned. Folders of no version at all
    may belong to a write under way and stay. A reader that started on a deleted version fails, so
    ``keep`` should cover the longest one."""
    if keep < 1:
        raise ValueError("the current version can't be deleted")
    have = numbers(spark, base)
    old, kept = have[:-keep], have[-keep:]
    content = {n: json.loads(read_text(spark, _file(base, n))) for n in have}
    used = set().union(*(folders(content[n]) for n in kept)) if kept else set()
    gone = sorted(set().union(*(folders(content[n]) for n in old)) - used) if old else []
    for n in old:  # first the versions, so that none names a folder that is gone
        fs, file = hadoop(spark, _file(base, n))
        fs.delete(file, False)
    for name in gone:
        fs, folder = hadoop(spark, f"{base.rstrip('/')}/{name}")
        fs.delete(folder, True)
    return gone

"""Lookup tables of measured size: broadcast where they are small enough, left to Spark where not."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A lookup of more bytes than this (the texts of its rows, and some 40 bytes a row) is not broadcast.
BROADCAST_BYTES = 32 << 20


@dataclass(frozen=True)
class Lookup:
    """A table, its key columns, its measured size, and whether each key has one row."""

    df: DataFrame
    keys: tuple[str, ...]
    rows: int
    bytes: int
    unique: bool

    def fits(self, limit: int = BROADCAST_BYTES) -> bool:
        return self.bytes <= limit


def measure_lookups(**tables: tuple[DataFrame, str]) -> dict[str, Lookup]:
    """Measure lookups (name = (table, key column)) in one job: rows, bytes, and whether a key is held
    twice. Rows with a NULL key match nothing and are left out. Only the figures reach the driver."""
    every, out = None, {}
    for name, (df, key) in tables.items():
        df = df.where(F.col(f"`{key}`").isNotNull())
        size = F.lit(40 + 8 * len(df.columns)).cast("long")
        for column, kind in df.dtypes:
            if kind == "string":
                size = size + F.coalesce(F.octet_length(f"`{column}`"), F.lit(0))
        rows = df.select(F.lit(name).alias("name"), F.col(f"`{key}`").cast("string").alias("key"), size.alias("size"))
        every = rows if every is None else every.unionByName(rows)
        out[name] = Lookup(df, (key,), 0, 0, True)
    found = (every.groupBy("name", "key").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b"))
             .groupBy("name").agg(F.sum("n").alias("n"), F.sum("b").alias("b"), F.max("n").alias("most")).collect())  # a row a lookup
    return out | {r["name"]: Lookup(out[r["name"]].df, out[r["name"]].keys, r["n"], r["b"], r["most"] == 1) for r in found}


def join_lookup(big: DataFrame, lookup: Lookup, on, how: str = "left", *, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``big`` joined to the lookup's columns, whose keys equal the columns or expressions ``on`` of
    ``big``; the key columns are left out. Within the limit the lookup is broadcast, so that ``big``
    stays where it is; beyond it Spark chooses from the sizes at run time."""
    on = [on] if isinstance(on, (str, Column)) else list(on)
    names = {k: f"_lookup_{i}" for i, k in enumerate(lookup.keys)}
    small = lookup.df.withColumnsRenamed(names)
    if lookup.fits(limit):
        small = F.broadcast(small)
    cond = F.lit(True)
    for have, key in zip(on, lookup.keys, strict=True):
        cond = cond & ((F.col(have) if isinstance(have, str) else have) == F.col(names[key]))
    joined = big.join(small, cond, how)
    return joined if how == "left_semi" else joined.drop(*names.values())

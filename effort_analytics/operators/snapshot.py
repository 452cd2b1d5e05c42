"""Latest snapshot of a ``year/month/day/hourmin`` folder tree.

The notebooks list folders on the driver and take the *string* maximum at each
level (so ``9`` beats ``10`` unless zero-padded). Here the levels are columns
(from ``_metadata.file_path`` or partition columns), compared as integers when
numeric, and the maximum is an aggregate joined back -- no driver listing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import DEFAULT_BROADCAST_ROWS


def _level_value(c: Column, numeric: bool) -> Column:
    # numeric: compare as integers (a non-numeric name sorts lowest); else as text
    return c.try_cast("bigint") if numeric else c


def latest_snapshot(df: DataFrame, levels=("y", "m", "d", "hm"), by=(), numeric: bool = True,
                    sources_bound: int | None = None, limit: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Rows of the newest snapshot, per group ``by`` (e.g. per source).

    The level-wise maximum of a folder tree equals the maximum of the tuple of
    levels, so it is one ``max(struct(...))`` aggregate (partial, map-side) and
    a join back on the levels. Without ``by`` the other side is one row and is
    broadcast, so the rows stay where they are. With ``by`` it has a row a source;
    ``sources_bound`` says how many sources there can be, and broadcasts it too.
    Unbounded, the newest rows of one source share a join key, which adaptive
    execution splits.
    """
    by = list(by)
    levels = list(levels)
    key = F.struct(*[_level_value(F.col(c), numeric).alias(c) for c in levels])
    newest = df.groupBy(*by).agg(F.max(key).alias("_k"))
    newest = newest.select(*by, *[F.col("_k")[c].alias(f"_max_{c}") for c in levels])
    if not by or (sources_bound is not None and sources_bound <= limit):
        newest = F.broadcast(newest)
    cond = [F.col(f"_d.{c}") == F.col(f"_n.{c}") for c in by]
    cond += [_level_value(F.col(f"_d.{c}"), numeric) == F.col(f"_n._max_{c}") for c in levels]
    return df.alias("_d").join(newest.alias("_n"), cond, "left_semi").select(*df.columns)


def latest_path_string_max(paths: DataFrame, levels=("y", "m", "d", "hm")) -> DataFrame:
    """The notebooks' rule for comparison: string maximum per level, level by level."""
    out = paths
    for c in levels:
        out = out.join(out.agg(F.max(c).alias(c)), c, "left_semi")
    return out


def load_order(column: Column | str) -> Column:
    """Sort key of a load id: its runs of digits compare as numbers, what is between them as text, so
    that load 10 comes after load 9 and 2024-10-2 before 2024-10-14. NULL for a NULL id."""
    c = F.col(column) if isinstance(column, str) else column
    runs = F.regexp_extract_all(c.cast("string"), F.lit("[0-9]+|[^0-9]+"), F.lit(0))

    def one(run):
        digits = F.regexp_replace(run, "^0+(?=.)", "")
        return F.when(run.rlike("^[0-9]"), F.concat(F.lit("0"), F.lpad(F.length(digits).cast("string"), 4, "0"), digits)).otherwise(run)
    return F.transform(runs, one)


def newest_load(df: DataFrame, column: str = "load_id") -> DataFrame:
    """Rows of the newest load of a table that keeps every load, without ``column``.

    For loads that are whole snapshots, each superseding the earlier ones, so that adding
    them up would count a row once a day (:func:`newest_entries` is for others). Loads
    compare by :func:`load_order`. The other side of the join is one row, and prunes the
    partitions of the older loads. A table without the column has one load only and is
    returned as it is.
    """
    if column not in df.columns:
        return df
    newest = df.agg(F.max_by(column, load_order(column)).alias(column))
    return df.join(F.broadcast(newest), column, "left_semi").drop(column)


def newest_entries(df: DataFrame, keys, column: str = "load_id") -> DataFrame:
    """Of each entry, the rows of the newest load that has it, without ``column``.

    An entry is named by ``keys`` (NULL is a value like others). A load may hold part of the
    entries only: those it holds replace the ones of earlier loads, however many rows each
    has there, and the others stay. So loading one again, or a snapshot after another,
    neither doubles nor hides anything; what a later load leaves out isn't taken back.

    The newest load of each entry is a partial aggregate over narrow rows (keys, load), and
    the rows are joined to it. Its side of the join is dealt out anew, so that adaptive
    execution can split the rows of a hot entry.
    """
    if column not in df.columns:
        return df
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = load_order(column)
    newest = df.groupBy(*keys).agg(F.max(order).alias("_order"))
    # always 0, but computed: one more join key than the aggregate's, so its rows are dealt out for the join
    apart = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(1))
    newest = newest.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col("_order").alias("_newest"), apart.alias("_key"))
    rows = df.withColumn("_order", order).withColumn("_apart", apart)
    same = (F.col("_order") == F.col("_newest")) & (F.col("_apart") == F.col("_key"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    return rows.join(newest, same, "left_semi").drop(column, "_order", "_apart")

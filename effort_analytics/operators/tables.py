"""Table-level operators: keyed upsert, dedup, schema-evolving union, empty clone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _has_null(keys) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | F.col(k).isNull()
    return out


def row_hash(df: DataFrame) -> Column:
    """Hash of a whole row (columns that hold maps left out: they can't be hashed)."""
    return F.xxhash64(*[F.col(f"`{n}`") for n, t in df.dtypes if "map<" not in t])


def dedup_latest(df: DataFrame, keys, order: Sequence[str], *, keep_null_keys: bool = False) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple (descending,
    NULLs lowest), ties broken by the remaining columns so the pick is total.

    Expressed as ``max(struct(order..., rest...))`` per key: an aggregate with
    a map-side partial step, so a hot key (even a third of all rows) is
    reduced inside every map task before the shuffle, unlike a window that
    would pull the whole key into one task. Rows with a NULL key form one
    group, like ``GROUP BY``; with ``keep_null_keys`` they are all passed
    through instead (what an upsert needs: a NULL key never matches), in the
    same pass: such a row is a group of its own.
    """
    keys = _names(keys)
    order = list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest]).alias("_best")
    groups = list(keys)
    if keep_null_keys:
        df = df.withColumn("_own", F.when(_has_null(keys), F.monotonically_increasing_id()))
        groups.append("_own")
    best = df.groupBy(*groups).agg(F.max(packed).alias("_best"))
    df = df.drop("_own")
    return best.select(*keys, *[F.col("_best")[c].alias(c) for c in order + rest]).select(*df.columns)


def dedup_latest_window(df: DataFrame, keys, order: Sequence[Column]) -> DataFrame:
    """Window form (``row_number() = 1``) for orderings a struct max cannot
    express (mixed ascending/descending). ``order`` must be total."""
    from pyspark.sql import Window
    w = Window.partitionBy(*_names(keys)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def upsert(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """``MERGE ... WHEN MATCHED UPDATE SET * WHEN NOT MATCHED INSERT *`` as a plan.

    Target rows whose key appears in ``source`` are replaced by the source
    row; other source rows are inserted. A NULL key never matches, so a NULL-key
    target row stays and a NULL-key source row is inserted (each run); NULL-key
    target rows are spread over the join's tasks by a hash of the row. The source
    must hold one row per non-NULL key (see :func:`dedup_latest`;
    :func:`require_unique_keys` raises where it doesn't).

    The result reads ``target``; write it to a *new* location and switch the
    table to it (see ``sinks.replace_table``) -- never overwrite a path the plan
    is reading.
    """
    keys = _names(keys)
    src = source.select(*target.columns) if set(target.columns) <= set(source.columns) else source
    spread = F.when(_has_null(keys), row_hash(target)).otherwise(0)
    # always 0, but computed: a literal would be folded away and spread nothing
    found = src.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(1)).alias("_spread"))
    kept = target.withColumn("_spread", spread).join(found, [*keys, "_spread"], "left_anti").select(*target.columns)
    return kept.unionByName(src, allowMissingColumns=True)


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys held by more than one row (empty when the key is unique)."""
    keys = _names(keys)
    return df.groupBy(*keys).count().where(F.col("count") > 1)


def require_unique_keys(df: DataFrame, keys) -> None:
    """Raise ``ValueError`` if a non-NULL key is held by more than one row (a job
    over ``df``; a merge refuses a row matched twice)."""
    keys = _names(keys)
    twice = duplicate_keys(df.where(~_has_null(keys)), keys).first()
    if twice is not None:
        raise ValueError(f"{twice['count']} source rows for key {[twice[k] for k in keys]}; dedup the source first")


def union_by_name_evolve(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name; a column missing on one side becomes NULL there
    (schema evolution of an append)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def empty_like(df: DataFrame) -> DataFrame:
    """Same schema, no rows (``SELECT * INTO #T FROM t WHERE 1 = 2``).

    Kept as a plan with a false filter, so the optimizer knows it is empty and
    prunes joins against it."""
    return df.where(F.lit(False))

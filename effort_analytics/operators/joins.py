"""Join helpers: broadcast only behind a size bound known on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows under which a side with a *proven* bound is broadcast explicitly (a calendar of
# 500 years; narrow rows, so some tens of MB at most). Above it (or with no bound) the plan is left to AQE, which converts to a broadcast
# join only from measured runtime sizes and otherwise keeps sort-merge.
DEFAULT_BROADCAST_ROWS = 200_000


def join_bounded(big: DataFrame, small: DataFrame, on, *, small_rows_bound: int | None,
                 how: str = "inner", limit: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``big.join(small, on, how)``, broadcasting ``small`` when its row bound is
    known and within ``limit``."""
    if small_rows_bound is not None and small_rows_bound <= limit and how in (
            "inner", "left", "left_outer", "left_semi", "left_anti", "leftsemi", "leftanti"):
        small = F.broadcast(small)
    return big.join(small, on, how)


def semi_existing(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows of ``df`` whose key exists in ``keys`` (``EXISTS``)."""
    return df.join(keys, on, "left_semi")


def anti_missing(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``keys`` (``NOT EXISTS``)."""
    return df.join(keys, on, "left_anti")

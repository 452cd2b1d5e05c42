"""Projection helpers: rename/drop, constant and audit columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C


def rename_drop(df: DataFrame, rename: dict | None = None, drop=(),
                constants: dict | None = None) -> DataFrame:
    """Rename columns, drop columns (absent names are ignored), add constants."""
    out = df.withColumnsRenamed(rename or {})
    out = out.drop(*[c for c in drop if c in out.columns])
    if constants:
        out = out.withColumns({k: F.lit(v) for k, v in constants.items()})
    return out


def with_audit(df: DataFrame, uploader: str = C.UPLOADER, at: dt.datetime | None = None,
               first: bool = True) -> DataFrame:
    """Add ``UploadDate`` (run timestamp, a parameter so results are repeatable)
    and ``UploadBy``; by default as the leading columns."""
    # text literal: read in the session time zone, so it shows back unchanged
    ts = F.current_timestamp() if at is None else F.lit(at.isoformat(sep=" ")).cast("timestamp")
    audit = [ts.alias("UploadDate"), F.lit(uploader).alias("UploadBy")]
    rest = [F.col(c) for c in df.columns if c not in ("UploadDate", "UploadBy")]
    return df.select(*(audit + rest if first else rest + audit))

"""Source-operator queries over the driver tables (JSON text, snapshot folders)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.snapshot import latest_snapshot
from ..plans import analogues as A
from ..sources.readers import parse_json_column
from .registry import query


@query("src_json_props", "event_id:bigint, event_type:string, k:bigint", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""", covers="S1")
def src_json_props(spark, sf_dir):
    ev = A.Tables(spark, sf_dir).events
    return parse_json_column(ev, "props", "k BIGINT").select("event_id", "event_type", "k")


def snapshot_levels(events):
    """The folder levels a snapshot tree would have for each event: year, month
    and day *unpadded* (so a text maximum would pick 9 over 10), hour-minute."""
    ts = F.col("ts")
    return events.select(
        "event_id", "event_type",
        F.year(ts).cast("string").alias("y"), F.month(ts).cast("string").alias("m"),
        F.dayofmonth(ts).cast("string").alias("d"),
        F.concat(F.lpad(F.hour(ts).cast("string"), 2, "0"), F.lpad(F.minute(ts).cast("string"), 2, "0")).alias("hm"))


@query("src_latest_snapshot", "event_type:string, event_id:bigint, y:string, m:string, d:string, hm:string", """
SELECT event_type, event_id, y, m, d, hm FROM (
  SELECT *, rank() OVER (PARTITION BY event_type ORDER BY CAST(y AS BIGINT) DESC, CAST(m AS BIGINT) DESC,
                         CAST(d AS BIGINT) DESC, CAST(hm AS BIGINT) DESC) AS rk
  FROM (SELECT event_id, event_type, CAST(year(ts) AS VARCHAR) AS y, CAST(month(ts) AS VARCHAR) AS m,
               CAST(day(ts) AS VARCHAR) AS d,
               lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || lpad(CAST(minute(ts) AS VARCHAR), 2, '0') AS hm
        FROM events) s) r
WHERE rk = 1""", covers="S5 D5")
def src_latest_snapshot(spark, sf_dir):
    ev = snapshot_levels(A.Tables(spark, sf_dir).events)
    return latest_snapshot(ev, by=["event_type"])

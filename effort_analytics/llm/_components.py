"""Connected components of a distributed edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import staged


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(d, c) of every node that an edge (u, v) joins to a smaller one: the smallest node of its
    component. Nodes without edges, and the smallest nodes themselves, are not listed. Each round
    is written to the shared folder; only a count and a checksum reach the driver."""
    # A join key more than the aggregates' own: always 0, but computed, so that their rows are dealt
    # out for the join and Spark can split a hot node.
    zero = F.pmod(F.xxhash64("u"), F.lit(1)).alias("z")
    edges = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", zero, F.least("u", "m").alias("m"))
        large = both.select("u", "v", zero).join(least, ["u", "z"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).select("u", zero, "m")
        small = large.select("u", "v", zero).join(least, ["u", "z"])
        small = small.select("u", F.col("m").alias("v")).unionByName(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        edges = staged(small, "edges")
        now = _state(edges)
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("d"), F.col("v").alias("c"))

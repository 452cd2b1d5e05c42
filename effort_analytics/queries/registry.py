"""Query registry: each entry pairs a Spark plan with its oracle SQL.

An entry declares its output columns with a type from ``{bigint, double,
string, date}``; both the Spark result and the SQL result are projected and
cast to exactly that list, so names and types line up across the two engines
(decimals go out as DOUBLE, integers as BIGINT).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sql import with_ctes

_SQL_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    columns: tuple[tuple[str, str], ...]
    sql: str | None
    covers: str = ""

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(spark, sf_dir)
        return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in self.columns])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        cols = ", ".join(f'CAST(q."{c}" AS {_SQL_TYPES[t]}) AS "{c}"' for c, t in self.columns)
        body = self.sql.strip().rstrip(";")
        return with_ctes(f"SELECT {cols} FROM ({body}) q")


REGISTRY: dict[str, Query] = {}


def query(name: str, columns: str, sql: str | None, covers: str = ""):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``columns`` is ``"a:bigint, b:string, ..."``; ``sql`` is the DuckDB body
    (CTEs from ``queries.sql`` are pulled in automatically); ``covers`` names the
    operator ids of the blueprint the query exercises.
    """
    cols = tuple(tuple(p.strip() for p in c.rsplit(":", 1)) for c in columns.split(","))

    def deco(fn):
        REGISTRY[name] = Query(name, fn, cols, sql, covers)
        return fn

    return deco

"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import math

import duckdb
import pytest

from .conftest import SF0001

TABLES = "region nation customer supplier part orders lineitem events".split()


def _norm(rows):
    def n(v):
        return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(n(v) for v in r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF0001}/{t}.parquet'")
    return con


def test_all_queries_match_oracle(spark, duck):
    import __spark_entry__ as E
    from effort_analytics.queries import REGISTRY
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(REGISTRY) <= set(sqls) <= set(qs)
    bad = []
    for name in sorted(REGISTRY):
        df = qs[name](spark, SF0001)
        rel = duck.sql(sqls[name])
        if df.columns != rel.columns or _norm(df.collect()) != _norm(rel.fetchall()):
            bad.append(name)
    assert bad == []


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns[:2] == ["DateYearMonthKey", "DateYear"]
    assert df.count() > 0

"""K6 and K10: a table of fixed schema, filled by position."""

import uuid

from effort_analytics.sources.sinks import create_table, insert_into


def test_create_and_insert(spark, tmpdir_path):
    name = f"fixed_{uuid.uuid4().hex[:8]}"
    create_table(spark, name, "a INT, b STRING", f"{tmpdir_path}/{name}")
    create_table(spark, name, "a INT, b STRING", f"{tmpdir_path}/{name}")  # again: no change
    assert spark.table(name).dtypes == [("a", "int"), ("b", "string")] and spark.table(name).count() == 0
    insert_into(spark.createDataFrame([(1, "x"), (2, None)], "k INT, v STRING"), name)
    insert_into(spark.createDataFrame([(3, "z")], "k INT, v STRING"), name)
    assert sorted(r.a for r in spark.table(name).collect()) == [1, 2, 3]
    insert_into(spark.createDataFrame([(4, "w")], "k INT, v STRING"), name, overwrite=True)
    assert [tuple(r) for r in spark.table(name).collect()] == [(4, "w")]
    spark.sql(f"DROP TABLE {name}")

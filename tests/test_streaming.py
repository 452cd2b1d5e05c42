"""The foreachBatch adaptor: each micro-batch is deduplicated and upserted; a
replayed batch leaves the table unchanged."""

import os

from effort_analytics.sources import replace_table
from effort_analytics.streaming import upsert_each_batch


def test_upsert_each_batch_is_replay_safe(spark, tmpdir_path):
    base = os.path.join(tmpdir_path, "tasks")
    state = {"path": replace_table(spark.createDataFrame([("1", 1, 10)], "TaskID string, v int, ts int"), base)}

    def read():
        return spark.read.parquet(state["path"])

    def write(df):
        state["path"] = replace_table(df, base)

    run = upsert_each_batch(read, write, ["TaskID"], ["ts"])
    batch = spark.createDataFrame([("1", 2, 20), ("1", 3, 30), ("2", 5, 5)], "TaskID string, v int, ts int")
    run(batch, 0)
    first = sorted(map(tuple, read().collect()))
    run(batch, 0)  # replay after a failure
    assert sorted(map(tuple, read().collect())) == first == [("1", 3, 30), ("2", 5, 5)]

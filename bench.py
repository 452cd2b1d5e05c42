"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built and fully executed (``write.format("noop")``, so every
row is produced but nothing is collected); one warm-up run, then the median of
``BENCH_REPEATS`` runs. The interval join is also timed in both forms on a
larger member set derived from ``orders`` (one employment interval per order),
since ``supplier`` is only 1,000 rows at sf0.1. Prints one JSON line.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["flag_under_target", "join_interval_days", "publish_task_leave_fact", "upsert_by_key",
            "publish_task_fact", "dedup_latest", "date_dimension", "planned_leave_deduction"]


def _time(fn, repeats: int) -> float:
    fn()  # warm-up
    runs = []
    for _ in range(repeats):
        t0 = time.perf_counter()
        fn()
        runs.append(time.perf_counter() - t0)
    return round(statistics.median(runs), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    from pyspark.sql import functions as F

    from effort_analytics.plans import analogues as A
    from effort_analytics.plans import targets as T
    from effort_analytics.queries import REGISTRY
    from effort_analytics.session import get_spark

    spark = get_spark(f"local[{cpus}]", cpus, extra_conf={"spark.driver.memory": "16g"})

    def run(name):
        return lambda: REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {name: _time(run(name), repeats) for name in HEADLINE}

    def interval(form):
        def go():
            t = A.Tables(spark, sf_dir)
            members = t.orders.select(
                F.col("o_orderkey").alias("WorkdayID"),
                F.to_date("o_orderdate").alias("StartDate"),
                F.when(F.col("o_orderkey") % 3 == 0, F.lit(dt.date(9999, 12, 31)))
                .otherwise(F.date_add(F.to_date("o_orderdate"), (F.col("o_custkey") % 900).cast("int")))
                .alias("EndDate"))
            fn = T.expected_hours if form == "scale" else T.expected_hours_literal
            fn(members, A.calendar(spark), A.AS_OF, A.MIN_YEAR).write.format("noop").mode("overwrite").save()
        return go

    times["interval_orders_scale"] = _time(interval("scale"), repeats)
    times["interval_orders_literal"] = _time(interval("literal"), repeats)
    spark.stop()
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "flag_under_target_median_sec", "value": times["flag_under_target"],
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "repeats": repeats}))


if __name__ == "__main__":
    main()

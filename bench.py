"""Time the headline queries: one warm-up, then the median of the runs, each reading every result row.

Prints one JSON line. ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the runs.
The dimensions and the lake are tables and are written once, before the clock starts, as is the warehouse that
``load_backfill`` loads all days into (a repeated load replaces the days it wrote).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from landfall.plans import facts as fact_plans
from landfall.session import get_session
from landfall.testbed import queries
from landfall.testbed.star import star

HEADLINE = (
    "q_port_state", "q_country", "q_purpose", "q_population", "count_by_dims", "count_by_places", "fact_arrivals",
    "fact_rejects", "fact_demographics", "clean_arrivals", "dim_time", "dim_airports", "key_fact",
    "labels_ports", "stage_day_partition", "sink_partitioned", "load_backfill", "dq_nulls", "dq_orphans",
    "dq_not_null_len")


def run(name: str, spark, sf_dir: str, warehouse: str) -> float:
    start = time.perf_counter()
    if name == "load_backfill":
        lake = queries._event_lake(spark, sf_dir)
        for first, last in fact_plans.stretches(spark, lake):
            fact_plans.run_range(spark, lake, warehouse, first, last, ordered=True)
    else:
        # The noop sink computes every column of every row and keeps nothing.
        queries.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = get_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    star(spark, sf_dir)
    warehouse = queries._event_warehouse(spark, sf_dir)
    seconds = {}
    for name in HEADLINE:
        run(name, spark, sf_dir, warehouse)
        seconds[name] = round(statistics.median(run(name, spark, sf_dir, warehouse) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "total time of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
        "runs": runs}))


if __name__ == "__main__":
    main()

"""Time the headline queries: ``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the number of cores.

Each query runs whole into Spark's ``noop`` sink, once to warm up the JVM and then ``BENCH_RUNS`` times; the
fastest run counts. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.catalog import QUERIES  # noqa: E402

HEADLINE = (
    "conform_order_items",
    "failed_rules",
    "rule_failure_counts",
    "dedupe_latest_orders",
    "dedupe_first_items",
    "scd2_customers",
    "scd2_events",
    "asof_hash",
    "asof_sweep",
    "fact_order_items",
    "recon_order_revenue",
    "daily_sales",
    "inventory_status",
    "funnel_daily",
    "gate_checks",
    "serve_daily_revenue",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spent = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        spent[name] = round(min(times[1:]), 3)
    total = round(sum(spent.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": spent, "sf": folder}))
    spark.stop()


if __name__ == "__main__":
    main()

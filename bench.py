"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query, the best counts (default 3, the first also warms up the JVM; a query that
              has taken BUDGET seconds is not run again)
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

from orestrata.plans.queries import QUERIES

BUDGET = 20.0

# From raw tables to a result, everything computed, unless the query is about stored layers.
HEADLINE = [
    "silver_customers",
    "silver_products",
    "silver_orders",
    "silver_order_items",
    "sales_enriched",
    "daily_sales",
    "category_performance",
    "customer_360",
    "adhoc_daily_gross",
    "customer_leaderboard",
    "reconcile_gross",
    "coerce_outcome",
    "foreign_key_candidates",
    "dq_profile",
    "dq_scorecard",
    "data_classes",
    "data_classes_by_value",
    "latest_per_key",
    "metric_country",
    "spine_daily_revenue",
    "layer_counts",
    "test_results",
    "reconcile_marts",
    "incremental_load",
    "upsert_compacted",
    "stream_orders",
    "stream_static_enriched",
    "stream_enriched",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        best, spent = None, 0.0
        for _ in range(runs):
            if spent > BUDGET:
                break
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - started
            spent += took
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
        print(f"{name:28} {best:7.3f}s", file=sys.stderr, flush=True)
    spark.stop()
    found = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )


if __name__ == "__main__":
    main()

"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR  folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default 8)
BENCH_RUNS    runs of each query, of which the median counts (default 3)
"""

from __future__ import annotations

import json
import os
import re
import time
from statistics import median

from pyspark.sql import SparkSession

from cashcycle.catalog.queries import registered

HEADLINE = (
    "mart_extract",
    "dedup_rows",
    "main_category",
    "daily_totals",
    "cogs_trailing",
    "inventory_trailing",
    "payables_trailing",
    "inbound_trailing",
    "replenishment",
    "black_stock",
    "l30_inventory_days",
    "monthly_flow_sums",
    "working_capital_days",
    "top_brands_wide",
    "brand_canonical",
    "daily_cogs",
    "tracking",
    "scorecard",
    "sheet_cogs",
)


def seconds(run) -> float:
    started = time.perf_counter()
    run()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cashcycle-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()

    def run(name: str) -> None:
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    run("scorecard")  # warm up the JVM
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    times = {
        name: median(seconds(lambda: run(name)) for _ in range(runs)) for name in HEADLINE
    }
    found = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

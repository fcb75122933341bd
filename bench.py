"""Times the headline queries and prints one JSON line.

Each query is planned and run from the parquet tables to the last row (noop sink), after one
untimed round that warms the JVM. ``value`` is the sum of the per-query medians.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from tidemark.plans.queries import QUERIES

HEADLINE = [
    "project_customer",
    "project_order",
    "quarantine_reasons",
    "latest_per_key",
    "running_high_water",
    "linked_upsert_base",
    "linked_upsert_oa",
    "partial_update",
    "upsert_staff",
    "gated_upsert",
    "customer_scope_update",
    "offset_ledger",
    "orders_by_status",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds: dict[str, list[float]] = {name: [] for name in HEADLINE}
    for attempt in range(rounds + 1):
        for name in HEADLINE:
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if attempt:
                seconds[name].append(time.perf_counter() - started)
    medians = {name: round(statistics.median(times), 3) for name, times in seconds.items()}
    result = {
        "metric": "headline queries, total of medians",
        "value": round(sum(medians.values()), 3),
        "unit": "sec",
        "queries": medians,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()

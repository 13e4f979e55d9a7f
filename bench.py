"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = (
    "latest_event",
    "state_timeline",
    "amount_by_flag",
    "distinct_parts_per_supplier",
    "collect_types",
    "joined_tags",
    "distinct_wide",
    "enrich_left",
    "snowflake_chain",
    "log_semijoin_rank",
    "union_explode_rest",
    "json_shapes",
    "text_clean",
    "sla_flags",
    "taxonomy",
    "mart_lanes",
    "mart_stock",
    "mart_legs",
    "mart_shipments",
    "mart_returns",
    "mart_support",
)


def session(cpus: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8)))
    from parcelmart.supplied import QUERIES

    names = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{folder}/nation.parquet").count()  # JVM start-up is not part of a query
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    result = {
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()

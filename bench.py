"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from varve.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "version_flags",
    "version_flags_nulls",
    "snapshot_by_date",
    "latest_rows",
    "incremental_equals_full",
    "deleted_flag",
    "row_hash_orders",
    "row_hash_events",
    "scan_jsonl",
    "scan_csv_plain",
    "worklist",
    "table_diff",
    "latest_run",
    "chunk_ntile",
    "listing_complete",
    "fetch_by_key",
    "replace_buckets",
    "bronze_events",
    "silver_events",
    "snapshot_silver",
    "feedback_details",
    "stream_bronze",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str, folder: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    names = sys.argv[1:] or HEADLINE
    # The first runs in a new JVM and of its Python workers mostly measure their start.
    for name in ("silver_events", "fetch_by_key"):
        run(name, sf_dir)
    seconds = {name: run(name, sf_dir) for name in names}
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Times the headline queries on one machine and prints one line of JSON.

Each query runs once to warm up and once to be timed, into a sink that discards its rows. The time
includes what the query does while it is being put together, such as building its lookup tables.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from workloads.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "stg_trips",
    "weather_hourly",
    "trips_validated",
    "trips_with_weather",
    "daily_weather_impact",
    "zone_weather_performance",
    "daily_trips_all_b",
    "daily_trips_valid_b",
    "daily_data_quality_b",
    "zone_analysis_b",
    "coverage_gaps",
    "high_water_filter",
    "dq_unique_combination",
    "dq_orphan_values",
    "upsert_keys",
    "ingest_trips",
)


def run(spark: SparkSession, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("skyfare-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call site per column
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run(spark, name)
        seconds[name] = round(run(spark, name), 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

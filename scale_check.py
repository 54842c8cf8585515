"""Times the pipeline on enlarged, skewed copies of the test tables, with its shuffle volume.

    python scale_check.py <folder of test tables> <copies> [shuffle]

A third of all trips is put into one pickup zone and one hour, and a third of all weather at one
station. With `shuffle` the lookup tables are treated as too large to broadcast.
"""

from __future__ import annotations

import json
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyfare import operators as op
from skyfare.scratch import Held, hold
from skyfare.sources import borough_station
from workloads import fixtures as fx

HOT_HOUR = "2024-01-10 08:"


def enlarged(spark: SparkSession, sf_dir: str, copies: int) -> tuple[DataFrame, DataFrame, int]:
    """Trips and weather of fixture A, `copies` times over, a third of them hot."""
    each = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    hot = F.col("copy") % 3 == 0
    trips = fx.trips_a(spark, sf_dir).withColumn("copy", each)
    minute = F.lpad((F.col("copy") % 60).cast("string"), 2, "0")
    at = F.concat(F.lit(HOT_HOUR), minute, F.lit(":00")).cast("timestamp_ntz")
    length = F.col("tpep_dropoff_datetime") - F.col("tpep_pickup_datetime")
    trips = trips.withColumns(
        {
            "tpep_dropoff_datetime": F.when(hot, at + length).otherwise(F.col("tpep_dropoff_datetime")),
            "tpep_pickup_datetime": F.when(hot, at).otherwise(F.col("tpep_pickup_datetime")),
            "PULocationID": F.when(hot, F.lit(0)).otherwise(F.col("PULocationID")),
        }
    ).drop("copy")
    weather = fx.weather_a(spark, sf_dir).withColumn("copy", each)
    weather = weather.withColumn(
        "station", F.when(hot, F.lit("JFK")).otherwise(F.col("station"))
    ).withColumns(
        {
            "station_name": F.concat("station", F.lit(" airfield")),
            "station_zone": F.concat(F.lit("zone of "), "station"),
        }
    ).drop("copy", "event_type")
    base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    trips.repartition(32).write.parquet(f"{base}/trips")
    weather.repartition(16).write.parquet(f"{base}/weather")
    trips, weather = spark.read.parquet(f"{base}/trips"), spark.read.parquet(f"{base}/weather")
    return trips, weather, trips.count()


def shuffle_bytes(log_dir: str) -> int:
    total = 0
    for path in Path(log_dir).rglob("*"):
        if not path.is_file():
            continue
        for line in path.read_text(errors="ignore").splitlines():
            if '"SparkListenerTaskEnd"' in line:
                metrics = json.loads(line).get("Task Metrics") or {}
                total += metrics.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
    return total


def main() -> None:
    sf_dir, copies, shuffled = sys.argv[1], int(sys.argv[2]), sys.argv[3:] == ["shuffle"]
    log_dir = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "64")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1" if shuffled else "10m")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.dir", f"file:{log_dir}")
        .config("spark.eventLog.buffer.kb", "1k")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    trips, weather, n = enlarged(spark, sf_dir, copies)
    zones = fx.taxi_zone(spark, sf_dir)

    def lookups() -> tuple[Held, Held]:
        boroughs = borough_station(spark, fx.BOROUGHS)
        both = (
            hold(op.zone_station_mapping(zones, boroughs, weather)),
            hold(op.weather_hourly(op.stg_weather_data(weather))),
        )
        return tuple(Held(h.df, h.rows, {c: 1 << 60 for c in h.widths}) for h in both) if shuffled else both

    def validated() -> DataFrame:
        return op.trips_validated(op.stg_yellow_trips(trips), *lookups(), fx.A_AS_OF, fx.A_MIN_DATE)

    def fact() -> DataFrame:
        return op.facts(op.stg_yellow_trips(trips), *lookups(), fx.A_AS_OF, fx.A_MIN_DATE)

    steps = {
        "weather_hourly": lambda: op.weather_hourly(op.stg_weather_data(weather)),
        "latest_per_station": lambda: op.latest_per_station(weather),
        "trips_validated": validated,
        "daily_trips_all": lambda: op.daily_trips_all(validated()),
        "zone_analysis": lambda: op.zone_analysis(zones, validated()),
        "daily_weather_impact": lambda: op.daily_weather_impact(fact()),
        "zone_weather_performance": lambda: op.zone_weather_performance(fact()),
    }
    print(f"{n} trips, {weather.count()} observations, lookups {'shuffled' if shuffled else 'measured'}")
    for name, make in steps.items():
        before, started = shuffle_bytes(log_dir), time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - started
        time.sleep(1)
        moved = (shuffle_bytes(log_dir) - before) / 1e6
        print(f"{name:26s} {seconds:7.2f} s {n / seconds / 1e6:6.2f} M trips/s {moved:9.1f} MB shuffled", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()

"""Raw rows to standard names and types, one projection each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skyfare.functions.casts import safe_double, safe_int, safe_string
from skyfare.functions.ratios import celsius
from skyfare.functions.times import hour_bucket, weekday, whole_seconds


def stg_yellow_trips(raw: DataFrame) -> DataFrame:
    """Trips with safe types, the parts of the pickup time, and the duration."""
    pickup = F.col("tpep_pickup_datetime").cast("timestamp_ntz")
    dropoff = F.col("tpep_dropoff_datetime").cast("timestamp_ntz")

    def whole(raw_name: str) -> Column:
        return safe_int(raw, raw_name)

    amounts = [
        "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
        "improvement_surcharge", "total_amount", "congestion_surcharge",
    ]
    return raw.select(
        safe_string(raw, "VendorID").alias("vendor_id"),
        pickup.alias("pickup_datetime"),
        dropoff.alias("dropoff_datetime"),
        whole("passenger_count").alias("passenger_count"),
        safe_double("trip_distance", raw).alias("trip_distance"),
        whole("RatecodeID").alias("ratecode_id"),
        "store_and_fwd_flag",
        whole("PULocationID").alias("pickup_location_id"),
        whole("DOLocationID").alias("dropoff_location_id"),
        whole("payment_type").alias("payment_type_id"),
        *[safe_double(name, raw).alias(name) for name in amounts],
        F.to_date(pickup).alias("pickup_date"),
        F.year(pickup).cast("bigint").alias("pickup_year"),
        F.month(pickup).cast("bigint").alias("pickup_month"),
        F.dayofmonth(pickup).cast("bigint").alias("pickup_day"),
        F.hour(pickup).cast("bigint").alias("pickup_hour"),
        weekday(pickup).alias("pickup_weekday"),
        whole_seconds(pickup, dropoff).alias("trip_duration_seconds"),
        hour_bucket(pickup).alias("pickup_hour_rounded"),
    )


def stg_weather_data(raw: DataFrame) -> DataFrame:
    """Observations with a time, in standard names, with °C and the parts of the time."""
    at = F.col("valid").cast("timestamp_ntz")
    return raw.where(F.col("valid").isNotNull()).select(
        "station",
        at.alias("observation_time"),
        "station_name",
        "station_zone",
        "lat",
        "lon",
        F.col("tmpf").alias("temperature_f"),
        celsius(F.col("tmpf")).alias("temperature_c"),
        F.col("p01i").alias("precipitation_inches"),
        F.col("vsby").alias("visibility_miles"),
        F.col("sknt").alias("wind_speed_knots"),
        F.col("gust").alias("wind_gust_knots"),
        F.col("skyc1").alias("sky_condition"),
        F.col("wxcodes").alias("weather_codes"),
        hour_bucket(at).alias("observation_hour"),
        F.to_date(at).alias("observation_date"),
        F.hour(at).cast("bigint").alias("hour_of_day"),
        weekday(at).alias("day_of_week"),
    )

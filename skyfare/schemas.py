"""Column layouts of the raw tables (fixed values the models are written against)."""

from __future__ import annotations

from pyspark.sql import types as T

TRIPS = T.StructType(
    [
        T.StructField("VendorID", T.LongType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.DoubleType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("DOLocationID", T.LongType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("source_file", T.StringType()),
    ]
)

WEATHER = T.StructType(
    [
        T.StructField("station", T.StringType()),
        T.StructField("valid", T.TimestampNTZType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("tmpf", T.DoubleType()),
        T.StructField("p01i", T.DoubleType()),
        T.StructField("vsby", T.DoubleType()),
        T.StructField("sknt", T.DoubleType()),
        T.StructField("gust", T.DoubleType()),
        T.StructField("skyc1", T.StringType()),
        T.StructField("wxcodes", T.StringType()),
        T.StructField("file_date", T.DateType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("station_zone", T.StringType()),
        T.StructField("source_file", T.StringType()),
    ]
)

TAXI_ZONE = T.StructType(
    [
        T.StructField("LocationID", T.LongType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

STATIONS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("zone", T.StringType()),
    ]
)

# Fields kept from a weather file when present, and those of them that are numbers.
WEATHER_FILE_FIELDS = (
    "station", "valid", "lat", "lon", "tmpf", "p01i", "vsby", "sknt", "gust", "skyc1", "wxcodes",
)
WEATHER_NUMERIC_FIELDS = ("tmpf", "p01i", "vsby", "sknt", "gust", "lon", "lat")

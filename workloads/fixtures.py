"""The engine's input tables, derived from the given test tables (see FIXTURES.md).

A: trips and weather at hour grain, from events, nation and region.
B: trips at volume, from lineitem, orders, customer and supplier.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

A_MIN_DATE = dt.date(2024, 1, 3)
A_AS_OF = dt.date(2024, 3, 28)
B_MIN_DATE = dt.date(1996, 1, 1)
B_AS_OF = dt.date(2000, 3, 31)
PROCESSED_AT = dt.datetime(2024, 3, 28, 12, tzinfo=dt.timezone.utc)

# MIDDLE EAST is left out on purpose: its zones have no station.
BOROUGHS = (("AFRICA", "JFK"), ("AMERICA", "LGA"), ("ASIA", "NYC"), ("EUROPE", "EWR"))
STATION_IDS = ("JFK", "LGA", "NYC", "EWR")
# EWR is left out on purpose: a lookup of it misses.
STATION_LIST = (
    {"id": "JFK", "name": "John F Kennedy", "zone": "queens"},
    {"id": "LGA", "name": "LaGuardia", "zone": "queens"},
    {"id": "NYC", "name": "Central Park", "zone": "manhattan"},
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def _station_code() -> Column:
    at = (F.col("user_id") % 4 + 1).cast("int")
    return F.element_at(F.array(*[F.lit(s) for s in STATION_IDS]), at)


def taxi_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.concat(F.lit("S"), (F.col("n_nationkey") % 3).cast("string")).alias("service_zone"),
    )


def weather_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin("signup", "error"))
    code, k = _station_code(), F.col("k")
    return events.withColumn("k", _k()).select(
        code.alias("station"),
        F.col("ts").alias("valid"),
        (F.lit(-74.0) + F.col("user_id") % 4).alias("lon"),
        (F.lit(40.0) + F.col("user_id") % 4).alias("lat"),
        F.col("value").alias("tmpf"),
        (k / 500).alias("p01i"),
        (k % 11).cast("double").alias("vsby"),
        (k % 30).cast("double").alias("sknt"),
        F.nullif(k % 3, F.lit(0)).cast("double").alias("gust"),
        F.when(k % 2 == 0, "CLR").otherwise("OVC").alias("skyc1"),
        F.when(k % 5 == 0, "RA").alias("wxcodes"),
        F.concat(code, F.lit(" airfield")).alias("station_name"),
        F.concat(F.lit("zone of "), code).alias("station_zone"),
        F.concat(code, F.lit("_"), F.date_format("ts", "yyyyMMdd")).alias("source_file"),
        F.col("event_type"),
    )


def trips_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where(
        F.col("event_type").isin("click", "purchase", "view")
    )
    k = F.col("k")
    none = F.lit(0.0)
    return events.withColumn("k", _k()).select(
        (F.col("user_id") % 3).alias("VendorID"),
        F.col("ts").alias("tpep_pickup_datetime"),
        (F.col("ts") + F.make_dt_interval(secs=k * 60 - 300)).alias("tpep_dropoff_datetime"),
        F.nullif(k % 7, F.lit(6)).cast("double").alias("passenger_count"),
        F.when(k % 17 == 0, F.lit(0.0)).otherwise(F.col("value") / 10).alias("trip_distance"),
        F.lit(1.0).alias("RatecodeID"),
        F.lit("N").alias("store_and_fwd_flag"),
        (F.col("user_id") % 25).alias("PULocationID"),
        (F.col("event_id") % 25).alias("DOLocationID"),
        (k % 4).alias("payment_type"),
        (F.col("value") - 5).alias("fare_amount"),
        none.alias("extra"),
        none.alias("mta_tax"),
        (F.col("value") / 10).alias("tip_amount"),
        none.alias("tolls_amount"),
        none.alias("improvement_surcharge"),
        (F.col("value") * 1.2).alias("total_amount"),
        none.alias("congestion_surcharge"),
        F.col("event_type").alias("source_file"),
    )


def trips_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    joined = (
        lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
        .join(customer, orders.o_custkey == customer.c_custkey)
        .join(supplier, lineitem.l_suppkey == supplier.s_suppkey)
    )
    price = F.col("l_extendedprice")
    none = F.lit(0.0)
    return joined.select(
        F.col("l_returnflag").alias("VendorID"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.col("l_linenumber").cast("double").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.lit(1.0).alias("RatecodeID"),
        F.lit("N").alias("store_and_fwd_flag"),
        F.col("c_nationkey").cast("bigint").alias("PULocationID"),
        F.col("s_nationkey").cast("bigint").alias("DOLocationID"),
        F.substring("o_orderpriority", 1, 1).try_cast("bigint").alias("payment_type"),
        price.alias("fare_amount"),
        none.alias("extra"),
        none.alias("mta_tax"),
        (price * F.col("l_discount")).alias("tip_amount"),
        none.alias("tolls_amount"),
        none.alias("improvement_surcharge"),
        (price * (1 + F.col("l_tax"))).alias("total_amount"),
        none.alias("congestion_surcharge"),
        F.date_format("o_orderdate", "yyyy-MM").alias("source_file"),
    )

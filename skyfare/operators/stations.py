"""Stations: latest known attributes, the zone mapping, and the configured list."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from skyfare.functions.labels import UNKNOWN
from skyfare.operators.lookup import lookup_join
from skyfare.scratch import Held, measure


def latest_per_station(raw_weather: DataFrame) -> DataFrame:
    """Name and zone of each station in its latest observation.

    Ties on the time go to the first name, then the first zone. Observations are first reduced to
    the latest time of each (station, name, zone), a map-side hash aggregate, so the window ranks
    a few rows per station however many observations it has.
    """
    attributes = (
        raw_weather.where(F.col("station").isNotNull())
        .groupBy("station", "station_name", "station_zone")
        .agg(F.max("valid").alias("latest"))
    )
    newest_first = Window.partitionBy("station").orderBy(
        F.desc_nulls_last("latest"),
        F.asc_nulls_first("station_name"),
        F.asc_nulls_first("station_zone"),
    )
    return (
        attributes.withColumn("rn", F.row_number().over(newest_first))
        .where(F.col("rn") == 1)
        .select(F.col("station").alias("station_id"), "station_name", "station_zone")
    )


def zone_station_mapping(
    taxi_zone: DataFrame, borough_map: Held | DataFrame, raw_weather: DataFrame
) -> DataFrame:
    """Station of each zone, by borough. Zones of an unmapped borough, or whose station has never
    reported, drop out."""
    in_borough = lookup_join(taxi_zone, borough_map, {"Borough": "borough"}, how="inner")
    return in_borough.join(latest_per_station(raw_weather), "station_id").select(
        F.col("LocationID").alias("taxi_zone_id"),
        F.col("Zone").alias("taxi_zone_name"),
        F.col("Borough").alias("taxi_borough"),
        "station_id",
        "station_name",
        "station_zone",
    )


def station_lookup(
    rows: DataFrame, stations: Held | DataFrame, key: str = "file_station"
) -> DataFrame:
    """Add the configured name and zone of the station in `key`, Unknown when it is not listed."""
    listed = measure(stations).select("id", station_name="name", station_zone="zone")
    found = lookup_join(rows, listed, {key: "id"})
    return found.withColumns(
        {c: F.coalesce(c, F.lit(UNKNOWN)) for c in ("station_name", "station_zone")}
    )

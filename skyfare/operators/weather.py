"""Hourly weather."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skyfare.functions.labels import weather_condition


def weather_hourly(observations: DataFrame) -> DataFrame:
    """One row per station (with its name and zone) and hour, labelled by its weather."""
    warmth = F.avg("temperature_f")
    rain = F.max("precipitation_inches")
    visibility = F.min("visibility_miles")
    return observations.groupBy(
        "station", "station_name", "station_zone",
        "observation_hour", "observation_date", "hour_of_day",
    ).agg(
        warmth.alias("avg_temperature_f"),
        F.avg("temperature_c").alias("avg_temperature_c"),
        rain.alias("precipitation_inches"),
        visibility.alias("min_visibility_miles"),
        F.avg("wind_speed_knots").alias("avg_wind_speed_knots"),
        F.max("wind_gust_knots").alias("max_wind_gust_knots"),
        weather_condition(rain, visibility, warmth).alias("weather_condition"),
        F.count(F.lit(1)).alias("observation_count"),
    )

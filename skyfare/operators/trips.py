"""Trips joined to stations and hourly weather, labelled, and the fact table built from them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from skyfare.functions.labels import (
    DEFAULT_MIN_DATE,
    VALID,
    data_quality_check,
    is_valid_date,
    missing_values_flag,
)
from skyfare.operators.lookup import lookup_join
from skyfare.operators.projection import fill_trip_nulls
from skyfare.scratch import Held, measure

# The columns of the validated trips and of the fact table, in order.
_STATION = ["station_id", "station_name", "station_zone"]
_HOUR_WEATHER = [
    "avg_temperature_f", "avg_temperature_c", "precipitation_inches", "min_visibility_miles",
    "avg_wind_speed_knots", "max_wind_gust_knots", "weather_condition",
]
_VALIDATED = [
    "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
    "ratecode_id", "store_and_fwd_flag", "pickup_location_id", "dropoff_location_id",
    "payment_type_id", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge",
    "station_id", "station_name", "station_zone", "weather_condition",
    "trip_duration_seconds", "pickup_date", "pickup_year", "pickup_month", "pickup_day",
    "pickup_hour", "pickup_weekday", "pickup_hour_rounded",
]
_FACT_TRIP = [
    "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
    "ratecode_id", "store_and_fwd_flag", "pickup_location_id", "dropoff_location_id",
    "payment_type_id", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge",
    "pickup_date", "pickup_year", "pickup_month", "pickup_day", "pickup_hour", "pickup_weekday",
    "trip_duration_seconds", "data_quality_check", "missing_values_flag",
]

_SALT_BY = ["pickup_datetime", "dropoff_location_id", "vendor_id"]  # what tells trips of one zone and hour apart


def with_station(trips: DataFrame, mapping: Held | DataFrame) -> DataFrame:
    """Add the weather station of the pickup zone."""
    side = measure(mapping).select("taxi_zone_id", *_STATION)
    return lookup_join(trips, side, {"pickup_location_id": "taxi_zone_id"}, salt_by=_SALT_BY)


def with_weather(
    trips: DataFrame, hourly: Held | DataFrame, columns: list[str], station: str = "station_id"
) -> DataFrame:
    """Add weather of the hour the pickup falls in, at the trip's station."""
    side = measure(hourly).select("station", "observation_hour", *columns)
    on = {station: "station", "pickup_hour_rounded": "observation_hour"}
    return lookup_join(trips, side, on, salt_by=_SALT_BY)


def label_trips(
    trips: DataFrame,
    as_of: dt.date | None = None,
    min_date: dt.date = DEFAULT_MIN_DATE,
    taken_along: Sequence[str] = (),
) -> DataFrame:
    """Quality labels and null filling. Both read the columns as joined, so they are one projection:
    filling first would hide what the labels look for."""
    filled = fill_trip_nulls()
    return trips.select(
        *[filled.get(name, F.col(name)).alias(name) for name in _VALIDATED],
        *[name for name in taken_along if name not in _VALIDATED],
        data_quality_check(min_date, as_of).alias("data_quality_check"),
        missing_values_flag().alias("missing_values_flag"),
        is_valid_date(F.col("pickup_datetime"), min_date, as_of).alias("is_valid_pickup_date"),
        is_valid_date(F.col("dropoff_datetime"), min_date, as_of).alias("is_valid_dropoff_date"),
    )


_LABELS = ["data_quality_check", "missing_values_flag", "is_valid_pickup_date", "is_valid_dropoff_date"]


def trips_wide(
    trips: DataFrame,
    mapping: Held | DataFrame,
    hourly: Held | DataFrame,
    as_of: dt.date | None = None,
    min_date: dt.date = DEFAULT_MIN_DATE,
) -> DataFrame:
    """The validated trips with all of their hour's weather beside them."""
    joined = with_weather(with_station(trips, mapping), hourly, _HOUR_WEATHER)
    return label_trips(joined, as_of, min_date, _HOUR_WEATHER)


def validated_of(wide: DataFrame) -> DataFrame:
    """`trips_validated` from `trips_wide`."""
    return wide.select(*_VALIDATED, *_LABELS)


def facts_of(
    wide: DataFrame, mapping: Held | DataFrame, hourly: Held | DataFrame
) -> DataFrame:
    """The fact table from `trips_wide`: its valid trips. Only where a zone or a station's hour is listed twice
    are they looked up again, as each lookup then multiplies them."""
    mapping, hourly = measure(mapping), measure(hourly)
    if not (_listed_once(mapping, "taxi_zone_id") and _listed_once(hourly, "station", "observation_hour")):
        return trips_with_weather(validated_of(wide), mapping, hourly)
    return _as_facts(wide.where(F.col("data_quality_check") == VALID))


def trips_validated(
    trips: DataFrame,
    mapping: Held | DataFrame,
    hourly: Held | DataFrame,
    as_of: dt.date | None = None,
    min_date: dt.date = DEFAULT_MIN_DATE,
) -> DataFrame:
    """Every trip with its station, weather condition and labels."""
    located = with_station(trips, mapping)
    return label_trips(with_weather(located, hourly, ["weather_condition"]), as_of, min_date)


def trips_with_weather(
    validated: DataFrame, mapping: Held | DataFrame, hourly: Held | DataFrame
) -> DataFrame:
    """Fact table: valid trips with their station and the weather of their hour.

    Station and weather are looked up again rather than taken from the validated trips: were a zone
    or a station's hour listed twice, each lookup must multiply the rows.
    """
    valid = validated.where(F.col("data_quality_check") == VALID)
    located = with_station(valid.drop(*_STATION, "weather_condition"), mapping)
    return _as_facts(with_weather(located, hourly, _HOUR_WEATHER))


def _as_facts(trips: DataFrame) -> DataFrame:
    return trips.select(
        *_FACT_TRIP,
        F.col("station_id").alias("weather_station"),
        "station_name",
        "station_zone",
        *_HOUR_WEATHER,
    )


def _listed_once(lookup: Held, *keys: str) -> bool:
    """Whether no key of the lookup is listed twice."""
    return lookup.df.groupBy(*keys).count().where("count > 1").isEmpty()


def facts(
    staged: DataFrame,
    mapping: Held | DataFrame,
    hourly: Held | DataFrame,
    as_of: dt.date | None = None,
    min_date: dt.date = DEFAULT_MIN_DATE,
) -> DataFrame:
    """The fact table straight from the staged trips, with the rows of
    `trips_with_weather(trips_validated(...))`.

    Where no zone and no hour of a station is listed twice, looking them up again would find what the
    first lookup found, so the weather is taken along from it: two joins of the trips, not four.
    """
    mapping, hourly = measure(mapping), measure(hourly)
    if not (_listed_once(mapping, "taxi_zone_id") and _listed_once(hourly, "station", "observation_hour")):
        return trips_with_weather(trips_validated(staged, mapping, hourly, as_of, min_date), mapping, hourly)
    wide = trips_wide(staged, mapping, hourly, as_of, min_date)
    return _as_facts(wide.where(F.col("data_quality_check") == VALID))

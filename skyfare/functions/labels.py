"""Rule labels. Every rule list is tried in order and the first rule that is TRUE wins; a rule that
is NULL because of a missing input does not match, so the next one is tried."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from skyfare.functions.times import months_before

# Label texts and thresholds.
VALID = "Valid"
TOO_OLD = "Date trop ancienne"
TOO_RECENT = "Date future ou trop récente"
BAD_DURATION = "Invalid trip duration"
ZERO_DISTANCE = "Zero distance with duration"
NEGATIVE_FARE = "Negative fare"
BAD_PASSENGERS = "Invalid passenger count"
NO_STATION = "Missing station data"
NO_WEATHER = "Missing weather data"

COMPLETE = "Complete"
MISSING_TIMESTAMP = "Missing timestamp"
MISSING_DISTANCE = "Missing trip distance"
MISSING_FARE = "Missing fare amount"
MISSING_PASSENGERS = "Missing passenger count"
MISSING_STATION = "Missing station information"
MISSING_STATION_NAME = "Missing station name"
MISSING_STATION_ZONE = "Missing station zone"
MISSING_WEATHER = "Missing weather condition"

DEFAULT_MIN_DATE = dt.date(2022, 1, 1)
SETTLING_MONTHS = 2  # the latest months are not settled yet
UNKNOWN = "Unknown"


def _first_true(rules: list[tuple[Column, str]], default: str) -> Column:
    label = F.when(rules[0][0], F.lit(rules[0][1]))
    for condition, text in rules[1:]:
        label = label.when(condition, F.lit(text))
    return label.otherwise(F.lit(default))


def weather_condition(precipitation: Column, visibility: Column, temperature_f: Column) -> Column:
    return _first_true(
        [
            (precipitation > 0.1, "Rainy"),
            (visibility < 3, "Poor Visibility"),
            (temperature_f < 32, "Freezing"),
            (temperature_f > 85, "Hot"),
        ],
        default="Normal",
    )


def data_quality_check(min_date: dt.date, as_of: dt.date | Column | None) -> Column:
    """Quality label of a trip, from the columns as read: call it before any null filling."""
    pickup = F.to_date("pickup_datetime")
    dropoff = F.to_date("dropoff_datetime")
    last = months_before(as_of, SETTLING_MONTHS)
    seconds = F.col("trip_duration_seconds")
    return _first_true(
        [
            ((pickup < F.lit(min_date)) | (dropoff < F.lit(min_date)), TOO_OLD),
            ((pickup > last) | (dropoff > last), TOO_RECENT),
            (seconds < 0, BAD_DURATION),
            ((F.col("trip_distance") == 0) & (seconds > 60), ZERO_DISTANCE),
            (F.col("fare_amount") < 0, NEGATIVE_FARE),
            (F.col("passenger_count") < 1, BAD_PASSENGERS),
            (F.col("station_id").isNull(), NO_STATION),
            (F.col("weather_condition").isNull(), NO_WEATHER),
        ],
        default=VALID,
    )


def missing_values_flag() -> Column:
    """Which field a trip lacks first, from the columns as read."""

    def absent(name: str) -> Column:
        return F.col(name).isNull()

    return _first_true(
        [
            (absent("pickup_datetime") | absent("dropoff_datetime"), MISSING_TIMESTAMP),
            (absent("trip_distance"), MISSING_DISTANCE),
            (absent("fare_amount"), MISSING_FARE),
            (absent("passenger_count"), MISSING_PASSENGERS),
            (absent("station_id"), MISSING_STATION),
            (absent("station_name"), MISSING_STATION_NAME),
            (absent("station_zone"), MISSING_STATION_ZONE),
            (absent("weather_condition"), MISSING_WEATHER),
        ],
        default=COMPLETE,
    )


def is_valid_date(ts: Column, min_date: dt.date, as_of: dt.date | Column | None) -> Column:
    """FALSE only for a date known to be out of bounds; a NULL date counts as valid."""
    day = F.to_date(ts)
    outside = (day < F.lit(min_date)) | (day > months_before(as_of, SETTLING_MONTHS))
    return F.when(outside, F.lit(False)).otherwise(F.lit(True))

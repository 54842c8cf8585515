"""Column helpers: casts, wall-clock time, ratios, file names and rule labels."""

from skyfare.functions.casts import clean_number, parse_wall_clock, safe_double, safe_int, safe_string
from skyfare.functions.labels import (
    data_quality_check,
    is_valid_date,
    missing_values_flag,
    weather_condition,
)
from skyfare.functions.names import date_token, scanned_file, station_token
from skyfare.functions.ratios import PartialMean, celsius, mean_ratio, safe_ratio
from skyfare.functions.times import hour_bucket, months_before, weekday, whole_seconds

__all__ = [
    "PartialMean",
    "celsius",
    "clean_number",
    "data_quality_check",
    "date_token",
    "hour_bucket",
    "is_valid_date",
    "mean_ratio",
    "missing_values_flag",
    "months_before",
    "parse_wall_clock",
    "safe_double",
    "safe_int",
    "safe_ratio",
    "safe_string",
    "scanned_file",
    "station_token",
    "weather_condition",
    "weekday",
    "whole_seconds",
]

"""DataFrame-to-DataFrame operators."""

from skyfare.operators.coverage import (
    coverage_gaps,
    expected_trip_files,
    expected_weather_files,
    missing_files,
    month_ranges,
)
from skyfare.operators.lookup import BROADCAST_BYTES, lookup_join
from skyfare.operators.marts import (
    daily_data_quality,
    daily_data_quality_of,
    daily_totals,
    daily_trips_all,
    daily_trips_all_of,
    daily_trips_valid,
    daily_trips_valid_of,
    daily_weather_impact,
    zone_analysis,
    zone_days,
    zone_metrics,
    zone_weather_days,
    zone_weather_of_days,
    zone_weather_performance,
    zones_of_days,
)
from skyfare.operators.projection import clean_numeric, fill_trip_nulls, parse_valid, project, with_lineage
from skyfare.operators.staging import stg_weather_data, stg_yellow_trips
from skyfare.operators.stations import latest_per_station, station_lookup, zone_station_mapping
from skyfare.operators.trips import (
    facts,
    facts_of,
    label_trips,
    trips_validated,
    trips_wide,
    trips_with_weather,
    validated_of,
    with_station,
    with_weather,
)
from skyfare.operators.weather import weather_hourly

__all__ = [
    "BROADCAST_BYTES",
    "clean_numeric",
    "coverage_gaps",
    "daily_data_quality",
    "daily_data_quality_of",
    "daily_totals",
    "daily_trips_all",
    "daily_trips_all_of",
    "daily_trips_valid",
    "daily_trips_valid_of",
    "daily_weather_impact",
    "expected_trip_files",
    "expected_weather_files",
    "facts",
    "facts_of",
    "fill_trip_nulls",
    "label_trips",
    "latest_per_station",
    "lookup_join",
    "missing_files",
    "month_ranges",
    "parse_valid",
    "project",
    "station_lookup",
    "stg_weather_data",
    "stg_yellow_trips",
    "trips_validated",
    "trips_wide",
    "trips_with_weather",
    "validated_of",
    "weather_hourly",
    "with_lineage",
    "with_station",
    "with_weather",
    "zone_analysis",
    "zone_days",
    "zone_metrics",
    "zone_station_mapping",
    "zone_weather_days",
    "zone_weather_of_days",
    "zone_weather_performance",
    "zones_of_days",
]

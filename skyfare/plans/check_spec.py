"""The checks declared on the model tables."""

from __future__ import annotations

from skyfare.plans.checks import Check

# Which column of which table is checked for what.
NOT_NULL = {
    "stg_yellow_trips": (
        "pickup_datetime", "dropoff_datetime", "trip_duration_seconds", "trip_distance",
    ),
    "stg_zone_to_station_mapping": ("taxi_zone_id", "station_id"),
    "int_yellow_trips_validated": ("pickup_datetime", "dropoff_datetime", "trip_distance"),
    "fct_taxi_trips_with_weather": (
        "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
        "ratecode_id", "store_and_fwd_flag", "pickup_location_id", "dropoff_location_id",
        "payment_type_id", "fare_amount", "total_amount", "pickup_date", "pickup_year",
        "pickup_month", "pickup_day", "pickup_hour", "pickup_weekday", "trip_duration_seconds",
        "data_quality_check", "missing_values_flag", "weather_station", "avg_temperature_f",
        "avg_temperature_c", "weather_condition",
    ),
    "mart_daily_trips_all": ("trip_date",),
    "mart_daily_trips_valid": ("trip_date",),
    "mart_daily_trips_data_quality": ("report_date",),
    "mart_zone_analysis": (
        "LocationID", "Borough", "Zone", "pickup_trips", "dropoff_trips", "total_trips",
        "avg_pickup_fare", "avg_dropoff_fare", "avg_pickup_distance", "avg_dropoff_distance",
        "pickup_revenue", "dropoff_revenue",
    ),
    "mart_daily_weather_impact": (
        "pickup_date", "weather_condition", "trip_count", "active_pickup_zones",
        "active_dropoff_zones", "avg_fare", "avg_total_amount", "avg_tip", "avg_tip_percentage",
        "avg_distance", "avg_duration_minutes", "avg_temperature", "max_precipitation",
        "min_visibility",
    ),
    "mart_zone_weather_performance": (
        "pickup_location_id", "weather_condition", "total_trips", "avg_fare", "avg_distance",
        "total_revenue", "avg_speed_mph", "revenue_per_mile", "avg_temperature",
        "avg_precipitation", "avg_visibility",
    ),
}
UNIQUE = {
    "stg_zone_to_station_mapping": "taxi_zone_id",
    "mart_daily_trips_all": "trip_date",
    "mart_daily_trips_valid": "trip_date",
    "mart_daily_trips_data_quality": "report_date",
    "mart_zone_analysis": "LocationID",
}
ACCEPTED_VALUES = {
    ("fct_taxi_trips_with_weather", "passenger_count"): (1, 2, 3, 4, 5, 6),
    ("fct_taxi_trips_with_weather", "data_quality_check"): ("Valid", "Invalid"),
    ("fct_taxi_trips_with_weather", "missing_values_flag"): (0, 1),
}
RELATIONSHIPS = {
    ("fct_taxi_trips_with_weather", "trip_distance"): ("int_yellow_trips_validated", "trip_distance"),
    ("fct_taxi_trips_with_weather", "pickup_location_id"): ("stg_zone_to_station_mapping", "taxi_zone_id"),
    ("fct_taxi_trips_with_weather", "pickup_month"): ("int_yellow_trips_validated", "pickup_month"),
    ("fct_taxi_trips_with_weather", "weather_station"): ("int_weather_hourly", "station"),
    ("mart_zone_weather_performance", "pickup_location_id"): (
        "fct_taxi_trips_with_weather", "pickup_location_id",
    ),
}
UNIQUE_COMBINATION = {
    "mart_daily_weather_impact": ("pickup_date", "weather_condition"),
    "mart_zone_weather_performance": ("pickup_location_id", "weather_condition"),
}
NOT_NEGATIVE = {
    "mart_daily_weather_impact": (
        "trip_count", "active_pickup_zones", "active_dropoff_zones", "avg_fare",
        "avg_total_amount", "avg_tip", "avg_tip_percentage", "avg_distance",
        "avg_duration_minutes", "max_precipitation", "min_visibility",
    ),
    "mart_zone_weather_performance": (
        "total_trips", "avg_fare", "avg_distance", "total_revenue", "avg_speed_mph",
        "revenue_per_mile", "avg_precipitation", "avg_visibility",
    ),
}


def model_checks() -> list[Check]:
    """Every declared check."""
    checks = [Check("not_null", m, c) for m, columns in NOT_NULL.items() for c in columns]
    checks += [Check("unique", m, c) for m, c in UNIQUE.items()]
    checks += [Check("accepted_values", m, c, v) for (m, c), v in ACCEPTED_VALUES.items()]
    checks += [Check("relationships", m, c, to) for (m, c), to in RELATIONSHIPS.items()]
    checks += [
        Check("unique_combination", m, "_and_".join(columns), columns)
        for m, columns in UNIQUE_COMBINATION.items()
    ]
    checks += [
        Check("expression_is_true", m, c, (f"{c} >= 0",))
        for m, columns in NOT_NEGATIVE.items()
        for c in columns
    ]
    return checks

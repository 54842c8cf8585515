"""Summary tables. Every grouping aggregates map-side first, so a hot date or zone sends one partial
row per task through the shuffle, not its trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skyfare.functions.labels import (
    BAD_DURATION,
    BAD_PASSENGERS,
    COMPLETE,
    NEGATIVE_FARE,
    VALID,
    ZERO_DISTANCE,
)
from skyfare.functions.ratios import PartialMean, mean_ratio, safe_ratio

def _rows() -> Column:
    return F.count(F.lit(1))


def _or_zero(value: str) -> Column:
    return F.coalesce(F.col(value), F.lit(0))


def _is_valid() -> Column:
    return F.col("data_quality_check") == VALID


def daily_trips_all(validated: DataFrame) -> DataFrame:
    """All trips per day, valid or not."""
    return validated.groupBy(F.col("pickup_date").alias("trip_date")).agg(
        _rows().alias("total_trips"),
        F.count_distinct("vendor_id").alias("active_vendors"),
        F.sum(_or_zero("passenger_count")).alias("total_passengers"),
        F.avg(_or_zero("trip_distance")).alias("avg_distance"),
        (F.avg(_or_zero("trip_duration_seconds")) / 60).alias("avg_duration_minutes"),
        F.sum(_or_zero("fare_amount")).alias("total_fare"),
        F.sum(_or_zero("tip_amount")).alias("total_tips"),
        F.sum(_or_zero("total_amount")).alias("total_revenue"),
        mean_ratio(_or_zero("tip_amount"), _or_zero("fare_amount"), 100.0).alias("avg_tip_percentage"),
    )


def daily_trips_valid(validated: DataFrame) -> DataFrame:
    """Valid trips per day."""
    valid = validated.where(_is_valid())
    return valid.groupBy(F.col("pickup_date").alias("trip_date")).agg(
        _rows().alias("total_trips"),
        F.count_distinct("vendor_id").alias("active_vendors"),
        F.sum("passenger_count").alias("total_passengers"),
        F.avg("passenger_count").alias("avg_passengers_per_trip"),
        F.avg("trip_distance").alias("avg_distance"),
        (F.avg("trip_duration_seconds") / 60).alias("avg_duration_minutes"),
        F.sum("fare_amount").alias("total_fare"),
        F.sum("tip_amount").alias("total_tips"),
        F.sum("total_amount").alias("total_revenue"),
        mean_ratio(F.col("tip_amount"), F.col("fare_amount"), 100.0).alias("avg_tip_percentage"),
    )


def daily_data_quality(validated: DataFrame) -> DataFrame:
    """Trips per day by quality, with the share of valid and of complete ones in percent."""
    check, flag = F.col("data_quality_check"), F.col("missing_values_flag")

    def share(condition: Column) -> Column:
        return F.round(F.lit(100.0) * F.count_if(condition) / _rows(), 2)

    return validated.groupBy(F.col("pickup_date").alias("report_date")).agg(
        _rows().alias("total_records"),
        F.count_if(check == VALID).alias("valid_records"),
        F.count_if(check != VALID).alias("invalid_records"),
        F.count_if(check == BAD_DURATION).alias("invalid_duration"),
        F.count_if(check == ZERO_DISTANCE).alias("zero_distance"),
        F.count_if(check == NEGATIVE_FARE).alias("negative_fare"),
        F.count_if(check == BAD_PASSENGERS).alias("invalid_passengers"),
        F.count_if(flag != COMPLETE).alias("incomplete_records"),
        share(check == VALID).alias("valid_rate"),
        share(flag == COMPLETE).alias("complete_rate"),
    )


def daily_totals(validated: DataFrame) -> DataFrame:
    """What the three daily tables need, one row per day from one pass over the trips.

    Trips are counted per day and vendor first: a vendor is then one row of its day, so counting vendors
    takes no copies of the trips.
    """
    valid, check, flag = _is_valid(), F.col("data_quality_check"), F.col("missing_values_flag")
    counts = {
        "total": F.lit(True), "valid": valid, "invalid": check != VALID, "bad_duration": check == BAD_DURATION,
        "zero_distance": check == ZERO_DISTANCE, "negative_fare": check == NEGATIVE_FARE,
        "bad_passengers": check == BAD_PASSENGERS, "incomplete": flag != COMPLETE, "complete": flag == COMPLETE,
    }
    measures = {
        "passengers": "passenger_count", "distance": "trip_distance", "seconds": "trip_duration_seconds",
        "fare": "fare_amount", "tip": "tip_amount", "revenue": "total_amount",
    }
    means = [PartialMean(f"all_{n}", _or_zero(c)) for n, c in measures.items()]
    means += [PartialMean(f"valid_{n}", F.when(valid, F.col(c))) for n, c in measures.items()]
    means += [
        PartialMean("all_tip_ratio", safe_ratio(_or_zero("tip_amount"), _or_zero("fare_amount"))),
        PartialMean("valid_tip_ratio", F.when(valid, safe_ratio(F.col("tip_amount"), F.col("fare_amount")))),
    ]
    per_vendor = validated.groupBy("pickup_date", "vendor_id").agg(
        *[F.count_if(condition).alias(name) for name, condition in counts.items()],
        *[column for mean in means for column in mean.start()],
    )
    return per_vendor.groupBy("pickup_date").agg(
        *[F.sum(name).alias(name) for name in counts],
        F.count("vendor_id").alias("vendors"),
        F.count(F.when(F.col("valid") > 0, F.col("vendor_id"))).alias("valid_vendors"),
        *[F.sum(f"{mean.name}__sum").alias(f"{mean.name}_sum") for mean in means],
        *[mean.finish().alias(f"{mean.name}_mean") for mean in means],
    )


def daily_trips_all_of(totals: DataFrame) -> DataFrame:
    """`daily_trips_all` from `daily_totals`."""
    return totals.select(
        F.col("pickup_date").alias("trip_date"),
        F.col("total").alias("total_trips"),
        F.col("vendors").alias("active_vendors"),
        F.col("all_passengers_sum").alias("total_passengers"),
        F.col("all_distance_mean").alias("avg_distance"),
        (F.col("all_seconds_mean") / 60).alias("avg_duration_minutes"),
        F.col("all_fare_sum").alias("total_fare"),
        F.col("all_tip_sum").alias("total_tips"),
        F.col("all_revenue_sum").alias("total_revenue"),
        (F.col("all_tip_ratio_mean") * 100).alias("avg_tip_percentage"),
    )


def daily_trips_valid_of(totals: DataFrame) -> DataFrame:
    """`daily_trips_valid` from `daily_totals`; a day without valid trips has no row."""
    return totals.where(F.col("valid") > 0).select(
        F.col("pickup_date").alias("trip_date"),
        F.col("valid").alias("total_trips"),
        F.col("valid_vendors").alias("active_vendors"),
        F.col("valid_passengers_sum").alias("total_passengers"),
        F.col("valid_passengers_mean").alias("avg_passengers_per_trip"),
        F.col("valid_distance_mean").alias("avg_distance"),
        (F.col("valid_seconds_mean") / 60).alias("avg_duration_minutes"),
        F.col("valid_fare_sum").alias("total_fare"),
        F.col("valid_tip_sum").alias("total_tips"),
        F.col("valid_revenue_sum").alias("total_revenue"),
        (F.col("valid_tip_ratio_mean") * 100).alias("avg_tip_percentage"),
    )


def daily_data_quality_of(totals: DataFrame) -> DataFrame:
    """`daily_data_quality` from `daily_totals`."""
    def share(name: str) -> Column:
        return F.round(F.lit(100.0) * F.col(name) / F.col("total"), 2)

    return totals.select(
        F.col("pickup_date").alias("report_date"),
        F.col("total").alias("total_records"),
        F.col("valid").alias("valid_records"),
        F.col("invalid").alias("invalid_records"),
        F.col("bad_duration").alias("invalid_duration"),
        "zero_distance",
        "negative_fare",
        F.col("bad_passengers").alias("invalid_passengers"),
        F.col("incomplete").alias("incomplete_records"),
        share("valid").alias("valid_rate"),
        share("complete").alias("complete_rate"),
    )


def zone_metrics(validated: DataFrame, location: str, role: str) -> DataFrame:
    """Valid trips per zone, the zone being the pickup or the dropoff `location` column."""
    placed = validated.where(F.col(location).isNotNull() & _is_valid())
    return (
        placed.groupBy(F.col(location).alias("location_id"))
        .agg(
            _rows().alias("trip_count"),
            F.avg("fare_amount").alias("avg_fare"),
            F.avg("trip_distance").alias("avg_distance"),
            F.sum("total_amount").alias("total_revenue"),
            (F.avg("trip_duration_seconds") / 60).alias("avg_duration_minutes"),
        )
        .withColumn("zone_role", F.lit(role))
    )


def _zone_means() -> tuple[PartialMean, PartialMean]:
    return PartialMean("fare", F.col("fare_amount")), PartialMean("distance", F.col("trip_distance"))


def zone_ends(validated: DataFrame, *by: str) -> DataFrame:
    """Counts and sums of the valid trips under each of their two zones, of which several rows may be of one zone.

    The trips are read once: they are reduced to (pickup, dropoff) pairs, and only the pairs are
    counted again under each of their two zones.
    """
    fare, distance = _zone_means()
    pairs = (
        validated.where(_is_valid())
        .groupBy(*by, "pickup_location_id", "dropoff_location_id")
        .agg(
            _rows().alias("trips"),
            F.sum("total_amount").alias("revenue"),
            *fare.start(),
            *distance.start(),
        )
    )
    ends = F.array(
        F.struct(F.col("pickup_location_id").alias("zone"), F.lit(True).alias("starts")),
        F.struct(F.col("dropoff_location_id").alias("zone"), F.lit(False).alias("starts")),
    )
    return pairs.select("*", F.inline(ends)).where(F.col("zone").isNotNull())


def zone_days(validated: DataFrame) -> DataFrame:
    """`zone_ends` per day, added up to one row per day, zone and end: what `zones_of_days` adds up further."""
    sums = ["trips", "revenue", *[f"{m.name}__{part}" for m in _zone_means() for part in ("sum", "n")]]
    ends = zone_ends(validated, "pickup_date")
    return ends.groupBy("pickup_date", "zone", "starts").agg(*[F.sum(c).alias(c) for c in sums])


def zone_analysis(taxi_zone: DataFrame, validated: DataFrame) -> DataFrame:
    """Every zone with the valid trips starting and ending in it, zeros where there are none."""
    return zones_of_days(taxi_zone, zone_ends(validated))


def zones_of_days(taxi_zone: DataFrame, ends: DataFrame) -> DataFrame:
    """`zone_analysis` from `zone_ends` or `zone_days`."""
    fare, distance = _zone_means()
    starts, stops = F.col("starts"), ~F.col("starts")
    by_zone = ends.groupBy(F.col("zone").alias("location_id")).agg(
        F.sum(F.when(starts, F.col("trips"))).alias("pickup_trips"),
        F.sum(F.when(stops, F.col("trips"))).alias("dropoff_trips"),
        fare.finish(starts).alias("avg_pickup_fare"),
        fare.finish(stops).alias("avg_dropoff_fare"),
        distance.finish(starts).alias("avg_pickup_distance"),
        distance.finish(stops).alias("avg_dropoff_distance"),
        F.sum(F.when(starts, F.col("revenue"))).alias("pickup_revenue"),
        F.sum(F.when(stops, F.col("revenue"))).alias("dropoff_revenue"),
    )
    role = F.when(F.col("pickup_trips").isNotNull(), F.lit("Pickup")).when(
        F.col("dropoff_trips").isNotNull(), F.lit("Dropoff")
    )
    zones = taxi_zone.join(by_zone, taxi_zone["LocationID"] == by_zone["location_id"], "left")
    return zones.select(
        "LocationID",
        "Borough",
        "Zone",
        "service_zone",
        role.alias("primary_zone_role"),
        _or_zero("pickup_trips").alias("pickup_trips"),
        _or_zero("dropoff_trips").alias("dropoff_trips"),
        (_or_zero("pickup_trips") + _or_zero("dropoff_trips")).alias("total_trips"),
        *[
            _or_zero(name).alias(name)
            for name in (
                "avg_pickup_fare", "avg_dropoff_fare", "avg_pickup_distance",
                "avg_dropoff_distance", "pickup_revenue", "dropoff_revenue",
            )
        ],
    )


def daily_weather_impact(fact: DataFrame) -> DataFrame:
    """Trips per day and weather condition, newest day first.

    Two distinct counts in one grouping would copy every trip three times before aggregating. The
    trips are reduced to (pickup, dropoff) pairs of the day first, and only the pairs are copied.
    """
    means = [
        PartialMean("avg_fare", F.col("fare_amount")),
        PartialMean("avg_total_amount", F.col("total_amount")),
        PartialMean("avg_tip", F.col("tip_amount")),
        PartialMean("tip_ratio", safe_ratio(F.col("tip_amount"), F.col("fare_amount"))),
        PartialMean("avg_distance", F.col("trip_distance")),
        PartialMean("seconds", F.col("trip_duration_seconds")),
        PartialMean("avg_temperature", F.col("avg_temperature_f")),
    ]
    pairs = fact.groupBy(
        "pickup_date", "weather_condition", "pickup_location_id", "dropoff_location_id"
    ).agg(
        _rows().alias("trips"),
        F.max("precipitation_inches").alias("rain"),
        F.min("min_visibility_miles").alias("visibility"),
        *[column for mean in means for column in mean.start()],
    )
    done = {mean.name: mean.finish() for mean in means}
    summary = pairs.groupBy("pickup_date", "weather_condition").agg(
        F.sum("trips").alias("trip_count"),
        F.count_distinct("pickup_location_id").alias("active_pickup_zones"),
        F.count_distinct("dropoff_location_id").alias("active_dropoff_zones"),
        done["avg_fare"].alias("avg_fare"),
        done["avg_total_amount"].alias("avg_total_amount"),
        done["avg_tip"].alias("avg_tip"),
        (done["tip_ratio"] * 100).alias("avg_tip_percentage"),
        done["avg_distance"].alias("avg_distance"),
        (done["seconds"] / 60).alias("avg_duration_minutes"),
        done["avg_temperature"].alias("avg_temperature"),
        F.max("rain").alias("max_precipitation"),
        F.min("visibility").alias("min_visibility"),
    )
    return summary.orderBy(F.desc("pickup_date"), "weather_condition")


def zone_weather_performance(fact: DataFrame) -> DataFrame:
    """Trips per pickup zone and weather condition, with speed and fare per mile."""
    known = fact.where(
        F.col("pickup_location_id").isNotNull() & F.col("weather_condition").isNotNull()
    )
    hours = F.col("trip_duration_seconds") / 3600
    return known.groupBy("pickup_location_id", "weather_condition").agg(
        _rows().alias("total_trips"),
        F.avg("fare_amount").alias("avg_fare"),
        F.avg("trip_distance").alias("avg_distance"),
        F.sum("total_amount").alias("total_revenue"),
        mean_ratio(F.col("trip_distance"), hours).alias("avg_speed_mph"),
        mean_ratio(F.col("fare_amount"), F.col("trip_distance")).alias("revenue_per_mile"),
        F.avg("avg_temperature_f").alias("avg_temperature"),
        F.avg("precipitation_inches").alias("avg_precipitation"),
        F.avg("min_visibility_miles").alias("avg_visibility"),
    )


def _zone_weather_means() -> dict[str, PartialMean]:
    hours = F.col("trip_duration_seconds") / 3600
    values = {
        "avg_fare": F.col("fare_amount"), "avg_distance": F.col("trip_distance"),
        "avg_speed_mph": safe_ratio(F.col("trip_distance"), hours),
        "revenue_per_mile": safe_ratio(F.col("fare_amount"), F.col("trip_distance")),
        "avg_temperature": F.col("avg_temperature_f"), "avg_precipitation": F.col("precipitation_inches"),
        "avg_visibility": F.col("min_visibility_miles"),
    }
    return {name: PartialMean(name, value) for name, value in values.items()}


def zone_weather_days(fact: DataFrame) -> DataFrame:
    """What `zone_weather_of_days` adds up: one row per day, pickup zone and weather condition."""
    known = fact.where(
        F.col("pickup_location_id").isNotNull() & F.col("weather_condition").isNotNull()
    )
    return known.groupBy("pickup_date", "pickup_location_id", "weather_condition").agg(
        _rows().alias("trips"),
        F.sum("total_amount").alias("revenue"),
        *[column for mean in _zone_weather_means().values() for column in mean.start()],
    )


def zone_weather_of_days(days: DataFrame) -> DataFrame:
    """`zone_weather_performance` from `zone_weather_days`."""
    done = {name: mean.finish().alias(name) for name, mean in _zone_weather_means().items()}
    return days.groupBy("pickup_location_id", "weather_condition").agg(
        F.sum("trips").alias("total_trips"),
        done["avg_fare"],
        done["avg_distance"],
        F.sum("revenue").alias("total_revenue"),
        done["avg_speed_mph"],
        done["revenue_per_mile"],
        done["avg_temperature"],
        done["avg_precipitation"],
        done["avg_visibility"],
    )

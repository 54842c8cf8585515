"""The models as stored tables, brought up to date by the days that changed.

A build remembers what it was made from: the trip files and their rows, the bounds of valid dates, and, as the stored models
themselves, the zone mapping and the hourly weather. The next build works out which days any of these changes:

- days that files not seen before, or not with as many rows, have trips on;
- days with another weather, where an hour's row came, went or differs;
- days with trips of a zone that is mapped to another station;
- days that a moved bound of valid dates passes over, by pickup or dropoff.

Only the raw trips of those days are read, validated and added up, and only their partitions are replaced.
What is asked for all days at once (zones) is kept as sums per day and added up from those. The days are
written down before the first table is touched and crossed out after the last, so a build that breaks off
is made good by the next one.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyfare.functions.labels import SETTLING_MONTHS
from skyfare.functions.times import months_before
from skyfare.operators.lookup import lookup_join
from skyfare.operators.marts import (
    daily_data_quality_of,
    daily_totals,
    daily_trips_all_of,
    daily_trips_valid_of,
    daily_weather_impact,
    zone_days,
    zone_weather_days,
    zone_weather_of_days,
    zones_of_days,
)
from skyfare.operators.trips import facts_of, trips_wide, validated_of
from skyfare.plans.days import Days
from skyfare.scratch import Held, discard, hold
from skyfare.sinks.tables import append, replace_partitions, replace_table, table_exists
from skyfare.sources.files import file_stats

# Tables of the build beside the models.
WIDE, ZONE_DAYS, ZONE_WEATHER_DAYS = "trips_wide", "zone_days", "zone_weather_days"
BUILT_FILES, BUILT_BOUNDS, OPEN_DAYS = "built_files", "built_bounds", "open_days"

MOST_NAMES = 4096  # files named in a filter; more are joined
_DIGITS = 9  # averages that agree to so many places count as unchanged: they are added up in no fixed order


@dataclass(frozen=True)
class Bounds:
    """First and last valid day."""

    first: dt.date
    last: dt.date

    @staticmethod
    def at(spark: SparkSession, min_date: dt.date, as_of: dt.date | None) -> Bounds:
        return Bounds(min_date, spark.range(1).select(months_before(as_of, SETTLING_MONTHS)).first()[0])

    def moved(self, before: Bounds) -> list[tuple[dt.date, dt.date]]:
        """Stretches of days that a bound has passed over."""
        day = dt.timedelta(1)
        stretches = [
            (min(self.first, before.first), max(self.first, before.first) - day),
            (min(self.last, before.last) + day, max(self.last, before.last)),
        ]
        return [(a, b) for a, b in stretches if a <= b]


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, _DIGITS).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


def _differing(now: DataFrame, before: DataFrame) -> DataFrame:
    """Rows that only one of two tables has, counting repeated ones."""
    now, before = _rounded(now), _rounded(before.select(*now.columns))
    return now.exceptAll(before).unionByName(before.exceptAll(now))


class StoredModels:
    """The tables of one store, and what has to be done to them."""

    def __init__(self, spark: SparkSession, store):
        self.spark, self.store = spark, store

    def table(self, model: str) -> DataFrame:
        return self.spark.table(self.store.name(model))

    def exists(self, model: str) -> bool:
        return table_exists(self.spark, self.store.name(model))

    def put(self, model: str, df: DataFrame, day: str, days: Days | None) -> DataFrame:
        """Store the rows of some days of a table, or with `days` None all of it."""
        if days is None:
            return self.store.save(model, df, [day])
        replace_partitions(df, self.store.name(model), day, days.values)
        return self.table(model)

    def put_whole(self, model: str, df: DataFrame) -> DataFrame:
        """Store all of a small table, which `df` may read."""
        if self.exists(model):
            return replace_table(df, self.store.name(model))
        return self.store.save(model, df)

    def files_now(self, sources) -> DataFrame | None:
        """(source_file, rows) of the trip files: from the ledger, or counted on that one column of the trips."""
        if "source_file" not in sources.trips.columns:
            return None
        counted = file_stats(sources.trips) if sources.files is None else sources.files
        return hold(counted.select("source_file", "rows"), "trip-files").df

    def unbuilt(self, trips: DataFrame, files: DataFrame) -> DataFrame:
        """Trips of files that no build has seen with as many rows; rows without a file name always count as such."""
        new = hold(files.join(self.table(BUILT_FILES), ["source_file", "rows"], "left_anti").select("source_file").distinct(), "unbuilt-files")
        if new.rows > MOST_NAMES:
            named = lookup_join(trips, new, {"source_file": "source_file"}, how="left_semi")
            return named.unionByName(trips.where("source_file IS NULL"))
        names = [r.source_file for r in new.df.where("source_file IS NOT NULL").collect()]
        return trips.where(F.col("source_file").isin(names) | F.col("source_file").isNull())

    def days_to_build(
        self, staged_days, trips: DataFrame, files: DataFrame | None, mapping: Held, hourly: Held, bounds: Bounds
    ) -> Days | None:
        """The days whose trips must be worked out again; None for all of them."""
        needed = (WIDE, ZONE_DAYS, BUILT_FILES, BUILT_BOUNDS, "stg_zone_to_station_mapping", "int_weather_hourly")
        if files is None or not all(self.exists(m) for m in needed):
            return None
        days = staged_days(self.unbuilt(trips, files))
        if self.exists(OPEN_DAYS):
            days |= Days.of(self.table(OPEN_DAYS), "pickup_date")
        weather = _differing(hourly.df.drop("observation_count"), self.table("int_weather_hourly").drop("observation_count"))
        days |= Days.of(weather, "observation_date")
        wide = self.table(WIDE)
        zones = hold(_differing(mapping.df, self.table("stg_zone_to_station_mapping")).select("taxi_zone_id").distinct(), "moved-zones")
        if zones.rows:
            of_zones = wide.select("pickup_location_id", "pickup_date").distinct()
            days |= Days.of(of_zones.join(zones.df, F.col("pickup_location_id") == F.col("taxi_zone_id"), "left_semi"), "pickup_date")
        before = self.table(BUILT_BOUNDS).first()
        for first, last in bounds.moved(Bounds(before.first_day, before.last_day)):
            touched = [F.to_date(c).between(F.lit(first), F.lit(last)) for c in ("pickup_datetime", "dropoff_datetime")]
            days |= Days.of(wide.where(touched[0] | touched[1]), "pickup_date")
        return days

    def begin(self, days: Days | None) -> None:
        """Write down what is about to be worked on, before any table is touched."""
        if days is not None:
            rows = [(d,) for d in sorted(days.values, key=lambda d: (d is not None, d or dt.date.min))]
            self.put_whole(OPEN_DAYS, self.spark.createDataFrame(rows, "pickup_date date"))

    def finish(self, files: DataFrame | None, bounds: Bounds) -> None:
        """Remember what the tables are made from; nothing is open any more."""
        if files is not None:
            self.put_whole(BUILT_FILES, files)
        state = self.spark.createDataFrame([(bounds.first, bounds.last)], "first_day date, last_day date")
        self.put_whole(BUILT_BOUNDS, state)
        self.put_whole(OPEN_DAYS, self.spark.createDataFrame([], "pickup_date date"))

    def above(self, model: str, column: str, fact: DataFrame) -> DataFrame | None:
        """Facts of days above the latest one that a table made from them has; None if it has none."""
        if not self.exists(model):
            return None
        mark = self.table(model).agg(F.max(column)).first()[0]
        return None if mark is None else fact.where(F.col("pickup_date") > F.lit(mark))


def save_lookup(models: StoredModels, model: str, held: Held, partition_by: tuple[str, ...] = ()) -> Held:
    """Store a held lookup table; its size is known already."""
    saved = models.store.save(model, held.df, list(partition_by))
    return replace(held, df=saved, path=None)


def save_trips(
    models: StoredModels, staged: DataFrame, mapping: Held, hourly: Held, as_of: dt.date | None, min_date: dt.date, days: Days | None
) -> dict[str, DataFrame]:
    """The validated trips and what is counted from them, for some days or all.

    The trips are stored once, with their weather beside them; the validated trips are a view of that table.
    """
    spark, store = models.spark, models.store
    if days is not None:
        staged = staged.where(days.near(F.col("pickup_datetime")) & days.hold(F.col("pickup_date")))
    name = store.name("int_yellow_trips_validated")
    if days is None or days:
        wide = models.put(WIDE, trips_wide(staged, mapping, hourly, as_of, min_date), "pickup_date", days)
        if days is not None:
            wide = wide.where(days.hold(F.col("pickup_date")))
        totals = hold(daily_totals(wide), "daily-totals")
        for model, of, day in (
            ("mart_daily_trips_all", daily_trips_all_of, "trip_date"),
            ("mart_daily_trips_valid", daily_trips_valid_of, "trip_date"),
            ("mart_daily_trips_data_quality", daily_data_quality_of, "report_date"),
        ):
            models.put(model, of(totals.df), day, days)
        models.put(ZONE_DAYS, zone_days(wide), "pickup_date", days)
        discard(totals)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")  # of an earlier form of the build, which stored these trips again
    columns = ", ".join(f"`{c}`" for c in validated_of(models.table(WIDE)).columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {store.name(WIDE)}")
    daily = ("mart_daily_trips_all", "mart_daily_trips_valid", "mart_daily_trips_data_quality")
    return {"int_yellow_trips_validated": spark.table(name), **{m: models.table(m) for m in daily}}


def save_facts(models: StoredModels, fact: DataFrame, rebuilt: bool) -> dict[str, DataFrame]:
    """What is counted from the facts, whose days are only ever added: the new ones are counted and added."""
    impact = "mart_daily_weather_impact"
    new = None if rebuilt else models.above(impact, "pickup_date", fact)
    if new is None:
        models.put_whole(impact, daily_weather_impact(fact))
    elif not new.isEmpty():
        both = models.table(impact).unionByName(daily_weather_impact(new))
        models.put_whole(impact, both.orderBy(F.desc("pickup_date"), "weather_condition"))
    new = None if rebuilt else models.above(ZONE_WEATHER_DAYS, "pickup_date", fact)
    if new is None:
        models.store.save(ZONE_WEATHER_DAYS, zone_weather_days(fact), ["pickup_date"])
    else:
        append(zone_weather_days(new), models.store.name(ZONE_WEATHER_DAYS))
    zones = "mart_zone_weather_performance"
    models.put_whole(zones, zone_weather_of_days(models.table(ZONE_WEATHER_DAYS)))
    return {impact: models.table(impact), zones: models.table(zones)}


def saved_zone_analysis(models: StoredModels, taxi_zone: DataFrame) -> DataFrame:
    return models.put_whole("mart_zone_analysis", zones_of_days(taxi_zone, models.table(ZONE_DAYS)))


def fact_rows(models: StoredModels, mapping: Held, hourly: Held) -> DataFrame:
    return facts_of(models.table(WIDE), mapping, hourly)


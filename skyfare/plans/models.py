"""The twelve model tables, in dependency order."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from skyfare.functions.labels import DEFAULT_MIN_DATE
from skyfare.operators.marts import (
    daily_data_quality,
    daily_trips_all,
    daily_trips_valid,
    daily_weather_impact,
    zone_analysis,
    zone_weather_performance,
)
from skyfare.operators.staging import stg_weather_data, stg_yellow_trips
from skyfare.operators.stations import zone_station_mapping
from skyfare.operators.trips import facts, trips_validated
from skyfare.operators.weather import weather_hourly
from skyfare.plans.days import Days
from skyfare.plans.stored import (
    Bounds,
    StoredModels,
    fact_rows,
    save_facts,
    save_lookup,
    save_trips,
    saved_zone_analysis,
)
from skyfare.scratch import Held, hold
from skyfare.sinks.tables import append, incremental, materialize, table_exists
from skyfare.sources.dimensions import DEFAULT_BOROUGH_STATIONS, borough_station

MODELS = (
    "stg_yellow_trips",
    "stg_weather_data",
    "stg_zone_to_station_mapping",
    "int_weather_hourly",
    "int_yellow_trips_validated",
    "fct_taxi_trips_with_weather",
    "mart_daily_trips_all",
    "mart_daily_trips_valid",
    "mart_daily_trips_data_quality",
    "mart_zone_analysis",
    "mart_daily_weather_impact",
    "mart_zone_weather_performance",
)


@dataclass(frozen=True)
class Sources:
    """Raw tables, and the trip files (source_file, rows) where a ledger has them."""

    trips: DataFrame
    weather: DataFrame
    taxi_zone: DataFrame
    files: DataFrame | None = None


@dataclass(frozen=True)
class TableStore:
    """Where model tables are kept: `<prefix><model>`, below `path` when one is given."""

    prefix: str = ""
    path: str | None = None

    def name(self, model: str) -> str:
        return f"{self.prefix}{model}"

    def location(self, model: str) -> str | None:
        return f"{self.path}/{model}" if self.path else None

    def save(
        self,
        model: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        cluster_by: Sequence[str] = (),
    ) -> DataFrame:
        return materialize(
            df, self.name(model), "overwrite", partition_by, cluster_by, self.location(model)
        )


def load_fact(store: TableStore, fact: DataFrame, full_refresh: bool = False) -> DataFrame:
    """Bring the fact table up to date: rebuild it, or add the trips above its latest pickup date.

    What is above the mark shares no key and no date with the table (the pickup time is a key and
    fixes the date), so the keyed upsert comes down to an append.
    """
    model = "fct_taxi_trips_with_weather"
    layout = (["pickup_date"], ["pickup_location_id", "weather_station"])
    spark, name = fact.sparkSession, store.name(model)
    if full_refresh or not table_exists(spark, name):
        return store.save(model, fact, *layout)
    append(incremental(fact, name, "pickup_date"), name, layout[1])
    return spark.table(name)


def build_models(
    spark: SparkSession,
    sources: Sources,
    as_of: dt.date | None = None,
    min_date: dt.date = DEFAULT_MIN_DATE,
    borough_stations: Sequence[tuple[str, str]] = DEFAULT_BOROUGH_STATIONS,
    store: TableStore | None = None,
    full_refresh: bool = False,
) -> dict[str, DataFrame]:
    """All models by name.

    With a `store`, staging stays lazy and every later model is a table, or a view of one. A build into a
    store that has been built into works on the days that have changed since (see `plans.stored`); with
    `full_refresh` it works on all, and the fact table is rebuilt. Days are told by the trips' `source_file`:
    without that column every build works on all days. A file of another number of rows is a new one.

    Without a store, only the two small lookup tables are held and the rest is one lazy plan per model.
    """
    boroughs = borough_station(spark, borough_stations)
    m: dict[str, DataFrame] = {
        "stg_yellow_trips": stg_yellow_trips(sources.trips),
        "stg_weather_data": stg_weather_data(sources.weather),
    }
    mapping = hold(zone_station_mapping(sources.taxi_zone, boroughs, sources.weather), "mapping")
    hourly = hold(weather_hourly(m["stg_weather_data"]), "hourly")
    if store is not None:
        m |= _stored(StoredModels(spark, store), sources, m["stg_yellow_trips"], mapping, hourly, as_of, min_date, full_refresh)
        return {model: m[model] for model in MODELS}
    m["stg_zone_to_station_mapping"], m["int_weather_hourly"] = mapping.df, hourly.df
    validated = trips_validated(m["stg_yellow_trips"], mapping, hourly, as_of, min_date)
    fact = facts(m["stg_yellow_trips"], mapping, hourly, as_of, min_date)
    m["int_yellow_trips_validated"] = validated
    m["fct_taxi_trips_with_weather"] = fact
    m["mart_daily_trips_all"] = daily_trips_all(validated)
    m["mart_daily_trips_valid"] = daily_trips_valid(validated)
    m["mart_daily_trips_data_quality"] = daily_data_quality(validated)
    m["mart_zone_analysis"] = zone_analysis(sources.taxi_zone, validated)
    m["mart_daily_weather_impact"] = daily_weather_impact(fact)
    m["mart_zone_weather_performance"] = zone_weather_performance(fact)
    return m


def _stored(
    models: StoredModels,
    sources: Sources,
    staged: DataFrame,
    mapping: Held,
    hourly: Held,
    as_of: dt.date | None,
    min_date: dt.date,
    full_refresh: bool,
) -> dict[str, DataFrame]:
    """The models that are tables, brought up to date."""
    bounds = Bounds.at(models.spark, min_date, as_of)

    def staged_days(trips: DataFrame) -> Days:
        return Days.of(stg_yellow_trips(trips), "pickup_date")

    files = models.files_now(sources)
    days = None if full_refresh else models.days_to_build(staged_days, sources.trips, files, mapping, hourly, bounds)
    models.begin(days)
    mapping = save_lookup(models, "stg_zone_to_station_mapping", mapping)
    hourly = save_lookup(models, "int_weather_hourly", hourly, ("observation_date",))
    built = save_trips(models, staged, mapping, hourly, as_of, min_date, days)
    fact_table = models.store.name("fct_taxi_trips_with_weather")
    rebuilt = full_refresh or not table_exists(models.spark, fact_table)
    # an increment reads only the days above the fact table's mark
    fact = load_fact(models.store, fact_rows(models, mapping, hourly), full_refresh)
    built |= save_facts(models, fact, rebuilt)
    built["mart_zone_analysis"] = saved_zone_analysis(models, sources.taxi_zone)
    models.finish(files, bounds)
    return {
        **built,
        "stg_zone_to_station_mapping": mapping.df,
        "int_weather_hourly": hourly.df,
        "fct_taxi_trips_with_weather": fact,
    }

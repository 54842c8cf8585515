"""Builds into tables that have been built into before."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from skyfare.operators import marts
from skyfare.plans import MODELS, Sources, TableStore, build_models, models as models_module, stored
from skyfare.plans.days import MOST_RANGES, Days
from skyfare.scratch import hold
from skyfare.sinks import append, materialize
from workloads import fixtures as fx
from workloads import queries as q

SF = "/root/testdata/sf0.001"


def rows(df):
    """Without regard to the order of columns: a table has its partition column last."""
    return sorted((tuple(r) for r in q.tidy(df.select(*sorted(df.columns))).collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def store(tmp_path):
    return TableStore(f"t_{uuid.uuid4().hex}_", str(tmp_path))


@pytest.fixture
def tables(spark, tmp_path):
    """Raw tables of the first load, with the second load's rows ready."""
    trips, weather = q.second_run_trips(spark, SF), q.second_run_weather(spark, SF)
    names = [f"t_{uuid.uuid4().hex}" for _ in range(2)]
    materialize(trips.where("source_file = 'first'"), names[0])
    materialize(weather.where("NOT late"), names[1])

    def sources():
        return Sources(spark.table(names[0]), spark.table(names[1]), fx.taxi_zone(spark, SF))

    def load():
        append(trips.where("source_file = 'second'"), names[0])
        append(weather.where("late"), names[1])

    return sources, load


def build(spark, sources, as_of, store=None, **more):
    return build_models(spark, sources, as_of, fx.A_MIN_DATE, fx.BOROUGHS, store, **more)


def test_a_second_build_has_what_a_full_one_has(spark, store, tables):
    sources, load = tables
    first = build(spark, sources(), q.FIRST_AS_OF, store)
    for model, df in build(spark, sources(), q.FIRST_AS_OF).items():
        assert sorted(first[model].columns) == sorted(df.columns)
        assert rows(first[model]) == rows(df), model
    old_facts = rows(first["fct_taxi_trips_with_weather"])
    load()
    second = build(spark, sources(), fx.A_AS_OF, store)
    whole = build(spark, sources(), fx.A_AS_OF)
    from_facts = {"fct_taxi_trips_with_weather", "mart_daily_weather_impact", "mart_zone_weather_performance"}
    for model in set(MODELS) - from_facts:
        assert rows(second[model]) == rows(whole[model]), model
    # the fact table takes only what lies above its mark, and its marts follow it
    fact = second["fct_taxi_trips_with_weather"]
    mark = max(r[sorted(fact.columns).index("pickup_date")] for r in old_facts)
    new = whole["fct_taxi_trips_with_weather"].where(F.col("pickup_date") > F.lit(mark))
    assert rows(fact) == sorted([*old_facts, *rows(new)], key=repr) and new.count() > 0
    assert rows(second["mart_daily_weather_impact"]) == rows(marts.daily_weather_impact(fact))
    assert rows(second["mart_zone_weather_performance"]) == rows(marts.zone_weather_performance(fact))
    refreshed = build(spark, sources(), fx.A_AS_OF, store, full_refresh=True)
    for model in MODELS:
        assert rows(refreshed[model]) == rows(whole[model]), model


def test_only_changed_days_are_read_and_written(spark, store, tables, monkeypatch):
    sources, load = tables
    build(spark, sources(), fx.A_AS_OF, store)
    seen = []

    def watched(staged, *args):
        seen.append(plan(staged))
        return wide(staged, *args)

    wide = stored.trips_wide
    monkeypatch.setattr(stored, "trips_wide", watched)
    name = store.name(stored.WIDE)
    files = lambda: {r.pickup_date: set(r.f) for r in spark.table(name).groupBy("pickup_date").agg(F.collect_set(F.col("_metadata.file_name")).alias("f")).collect()}
    before = files()
    build(spark, sources(), fx.A_AS_OF, store)
    assert not seen and files() == before  # nothing new: no trip is read
    load()
    trips = q.second_run_trips(spark, SF).where("source_file = 'second'")
    new_days = {r[0] for r in trips.select(F.to_date("tpep_pickup_datetime")).distinct().collect()}
    late_weather = {r[0] for r in q.second_run_weather(spark, SF).where("late").select(F.to_date("valid")).distinct().collect()}
    build(spark, sources(), fx.A_AS_OF, store)
    after = files()
    assert {d for d in after if after[d] != before.get(d)} == new_days | (late_weather & set(after))
    assert len(seen) == 1 and "PushedFilters" in seen[0] and "tpep_pickup_datetime" in seen[0].split("PushedFilters")[1]


def test_trips_are_joined_twice(spark, store, tables):
    sources, _ = tables
    build(spark, sources(), fx.A_AS_OF, store)
    held = [hold(spark.table(store.name(m)), m) for m in ("stg_zone_to_station_mapping", "int_weather_hourly")]
    fact = stored.fact_rows(stored.StoredModels(spark, store), *held)
    assert "Join" not in plan(fact)


def test_daily_tables_come_from_one_scan(spark, store, tables, monkeypatch):
    sources, _ = tables
    calls = []
    monkeypatch.setattr(stored, "daily_totals", lambda df: (calls.append(plan(marts.daily_totals(df))), marts.daily_totals(df))[1])
    build(spark, sources(), fx.A_AS_OF, store)
    assert len(calls) == 1 and calls[0].count("FileScan") == 1 and "Expand" not in calls[0]


@pytest.mark.parametrize("broken", ["save_lookup", "save_trips", "save_facts"])
def test_a_build_that_breaks_off_is_made_good(spark, store, tables, monkeypatch, broken):
    sources, load = tables
    build(spark, sources(), q.FIRST_AS_OF, store)
    load()
    real = getattr(models_module, broken)

    def fails(*args):
        real(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(models_module, broken, fails)
    with pytest.raises(RuntimeError, match="lost"):
        build(spark, sources(), fx.A_AS_OF, store)
    monkeypatch.setattr(models_module, broken, real)
    again = build(spark, sources(), fx.A_AS_OF, store)
    whole = build(spark, sources(), fx.A_AS_OF)
    for model in ("int_yellow_trips_validated", "mart_daily_trips_valid", "mart_zone_analysis"):
        assert rows(again[model]) == rows(whole[model]), model
    fact = again["fct_taxi_trips_with_weather"]
    assert rows(again["mart_daily_weather_impact"]) == rows(marts.daily_weather_impact(fact))


def test_days():
    day = dt.date(2024, 1, 1)
    every = [day + dt.timedelta(i) for i in (0, 1, 2, 10, 11, 40)]
    assert Days(frozenset(every)).ranges() == [(every[0], every[2]), (every[3], every[4]), (every[5], every[5])]
    assert Days().ranges() == [] and not Days() and Days(undated=True)
    scattered = Days(frozenset(day + dt.timedelta(3 * i) for i in range(500)))
    ranges = scattered.ranges()
    assert len(ranges) == MOST_RANGES
    assert all(any(a <= d <= b for a, b in ranges) for d in scattered.known)


def test_days_as_filters(spark):
    times = spark.sql("SELECT explode(array(timestamp_ntz'2024-01-01 23:59:59', timestamp_ntz'2024-01-02', timestamp_ntz'2024-01-09 12:00:00', null)) AS t")
    days = Days(frozenset({dt.date(2024, 1, 1), dt.date(2024, 1, 9)}))
    for some, n in ((days, 2), (Days(days.known, True), 3), (Days(undated=True), 1), (Days(), 0)):
        assert times.where(some.near(F.col("t")) & some.hold(F.to_date("t"))).count() == n


def test_bounds_that_move():
    d = dt.date
    before = stored.Bounds(d(2022, 1, 1), d(2024, 1, 31))
    assert stored.Bounds(d(2022, 1, 1), d(2024, 2, 2)).moved(before) == [(d(2024, 2, 1), d(2024, 2, 2))]
    assert stored.Bounds(d(2022, 1, 3), d(2024, 1, 31)).moved(before) == [(d(2022, 1, 1), d(2022, 1, 2))]
    assert before.moved(before) == []

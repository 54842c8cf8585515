from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyfare import operators as op
from skyfare.functions import labels
from skyfare.scratch import Held, hold, measure
from skyfare.sources import borough_station, stations_frame
from workloads import fixtures as fx

SF_DIR = "/root/testdata/sf0.001"
TS = dt.datetime


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def staged(spark):
    return op.stg_yellow_trips(fx.trips_a(spark, SF_DIR))


@pytest.fixture(scope="module")
def mapping(spark):
    zones = fx.taxi_zone(spark, SF_DIR)
    boroughs = borough_station(spark, fx.BOROUGHS)
    return hold(op.zone_station_mapping(zones, boroughs, fx.weather_a(spark, SF_DIR)))


@pytest.fixture(scope="module")
def hourly(spark):
    return hold(op.weather_hourly(op.stg_weather_data(fx.weather_a(spark, SF_DIR))))


@pytest.fixture(scope="module")
def validated(staged, mapping, hourly):
    return hold(op.trips_validated(staged, mapping, hourly, fx.A_AS_OF, fx.A_MIN_DATE)).df


def test_lookup_join_is_the_same_broadcast_or_shuffled(spark):
    facts = spark.sql("SELECT IF(id % 3 = 0, 7, id) AS k, id AS v FROM range(200)")
    facts = facts.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k, id AS v FROM range(9)"))
    lookup = spark.sql("SELECT id AS key, concat('n', id) AS name FROM range(50)")
    lookup = lookup.unionByName(spark.sql("SELECT 7L AS key, 'again' AS name"))
    for how in ("left", "inner"):
        small = op.lookup_join(facts, lookup, {"k": "key"}, how)
        large = op.lookup_join(facts, lookup, {"k": "key"}, how, max_bytes=0)
        assert "BroadcastHashJoin" in plan(small)
        assert "_salt" in plan(large)
        assert rows(small) == rows(large)
        assert small.columns == large.columns == ["k", "v", "name"]
    for how in ("left_semi", "left_anti"):
        keys = lookup.select("key")
        small = op.lookup_join(facts, keys, {"k": "key"}, how)
        assert rows(small) == rows(op.lookup_join(facts, keys, {"k": "key"}, how, max_bytes=0))


def test_hot_key_of_a_shuffled_lookup_is_split(spark):
    """A third of the rows share one key; adaptive execution must split them, and the grouping on
    that key above the join must not stop it."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "64",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        facts = spark.sql("SELECT IF(id % 3 = 0, 1, id % 5000) AS k, id AS v, uuid() AS h FROM range(0, 600000, 1, 8)")
        lookup = spark.sql("SELECT id AS key, id * 2 AS twice FROM range(5000)")
        joined = op.lookup_join(facts, lookup, {"k": "key"}, max_bytes=0)
        report = joined.groupBy("k").agg(F.count("h").alias("n"), F.max("twice").alias("twice"))
        got = report.where("k = 1").collect()
        report.collect()
        final = plan(report)
        hot = facts.where("k = 1").count()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert [(r.n, r.twice) for r in got] == [(hot, 2)]
    assert "skew=true" in final


def test_held_size_is_measured(spark):
    df = spark.sql("SELECT id, repeat('x', 10) AS t FROM range(100)")
    held = hold(df)
    assert held.size == measure(df).size == 100 * (16 + 2 * 8 + 10)
    assert held.select("id").size == 100 * (16 + 8)
    assert held.select(name="t").df.columns == ["name"]
    assert rows(held.df) == rows(df)
    assert hold(df.where("id < 0")).size == 0


def test_trips_are_not_shuffled_when_the_lookups_are_small(validated, staged, mapping, hourly):
    lazy = op.trips_validated(staged, mapping, hourly, fx.A_AS_OF, fx.A_MIN_DATE)
    text = plan(lazy)
    assert text.count("BroadcastHashJoin") == 2
    assert "hashpartitioning" not in text
    fact = op.trips_with_weather(validated, mapping, hourly)
    assert "hashpartitioning" not in plan(fact)


def test_validated_keeps_every_trip(staged, validated, hourly):
    assert validated.count() == staged.count()
    per_hour = hourly.df.groupBy("station", "observation_hour").count().where("count > 1")
    assert per_hour.isEmpty()


def test_validated_is_the_same_with_large_lookups(staged, validated, mapping, hourly):
    huge = [Held(h.df, 1 << 60, h.widths) for h in (mapping, hourly)]
    shuffled = op.trips_validated(staged, *huge, fx.A_AS_OF, fx.A_MIN_DATE)
    assert "_salt" in plan(shuffled)
    assert rows(shuffled) == rows(validated)


def test_broadcast_limit_is_a_session_setting(spark):
    facts, lookup = spark.range(9), spark.sql("SELECT id AS key, 1 AS one FROM range(9)")
    spark.conf.set("spark.skyfare.broadcastBytes", "10")
    try:
        assert "_salt" in plan(op.lookup_join(facts, lookup, {"id": "key"}))
    finally:
        spark.conf.unset("spark.skyfare.broadcastBytes")
    assert "_salt" not in plan(op.lookup_join(facts, lookup, {"id": "key"}))


def test_labels_look_at_unfilled_columns(spark, staged, mapping, hourly):
    """A trip without passengers counts as one passenger and is still flagged."""
    valid = op.trips_validated(staged, mapping, hourly, fx.A_AS_OF, fx.A_MIN_DATE)
    gone = valid.where(F.col("missing_values_flag") == labels.MISSING_PASSENGERS)
    assert not gone.isEmpty()
    assert [r[0] for r in gone.select("passenger_count").distinct().collect()] == [1]


def test_quality_parts_add_up(validated):
    report = op.daily_data_quality(validated)
    assert report.where("valid_records + invalid_records <> total_records").isEmpty()
    total = op.daily_trips_valid(validated).agg(F.sum("total_trips")).first()[0]
    assert total == validated.where("data_quality_check = 'Valid'").count()


def test_weather_that_names_an_hour_twice_multiplies_trips(spark):
    """Two name variants in one hour: two labelled rows per trip, and four facts."""
    raw = spark.createDataFrame(
        [("JFK", TS(2023, 5, 1, 10, 5), "old", 50.0), ("JFK", TS(2023, 5, 1, 10, 50), "new", 50.0)],
        "station string, valid timestamp_ntz, station_name string, tmpf double",
    )
    for c in ("lon", "lat", "p01i", "vsby", "sknt", "gust"):
        raw = raw.withColumn(c, F.lit(9.0))
    for c in ("skyc1", "wxcodes", "station_zone"):
        raw = raw.withColumn(c, F.lit("z"))
    zones = spark.createDataFrame([(1, "Queens", "Z", "S")], "LocationID long, Borough string, Zone string, service_zone string")
    mapping = op.zone_station_mapping(zones, borough_station(spark), raw)
    assert [r.station_name for r in mapping.collect()] == ["new"]
    hourly = op.weather_hourly(op.stg_weather_data(raw))
    trip = (
        fx.trips_a(spark, SF_DIR).limit(1)
        .withColumns({
            "tpep_pickup_datetime": F.lit("2023-05-01 10:59:59").cast("timestamp_ntz"),
            "tpep_dropoff_datetime": F.lit("2023-05-01 11:09:00").cast("timestamp_ntz"),
            "PULocationID": F.lit(1).cast("bigint"), "trip_distance": F.lit(1.0),
            "fare_amount": F.lit(5.0), "passenger_count": F.lit(1.0),
        })
    )
    validated = op.trips_validated(op.stg_yellow_trips(trip), mapping, hourly, dt.date(2024, 1, 1))
    assert validated.count() == 2
    assert op.trips_with_weather(validated, mapping, hourly).count() == 4


def test_latest_per_station_with_missing_times_and_ties(spark):
    raw = spark.createDataFrame(
        [
            ("A", None, "never", "z"), ("A", TS(2023, 1, 1), "b", "z"), ("A", TS(2023, 1, 1), "a", "y"),
            ("B", None, "only", "z"), (None, TS(2024, 1, 1), "no station", "z"),
            ("C", TS(2023, 1, 2), None, None), ("C", TS(2023, 1, 1), "older", "z"),
        ],
        "station string, valid timestamp_ntz, station_name string, station_zone string",
    )
    assert rows(op.latest_per_station(raw)) == [
        ("A", "a", "y"), ("B", "only", "z"), ("C", None, None)
    ]


def test_station_lookup_takes_the_first_entry(spark):
    listed = stations_frame(
        spark,
        [{"id": "JFK", "name": "first", "zone": "q"}, {"id": "JFK", "name": "second", "zone": "q"}, {"id": "LGA"}],
    )
    df = spark.createDataFrame([("JFK",), ("LGA",), ("XXX",)], "file_station string")
    assert rows(op.station_lookup(df, listed)) == [
        ("JFK", "first", "q"), ("LGA", "Unknown", "Unknown"), ("XXX", "Unknown", "Unknown"),
    ]


def test_daily_weather_impact_counts_zones_without_copying_trips(validated, mapping, hourly):
    fact = op.trips_with_weather(validated, mapping, hourly)
    direct = fact.groupBy("pickup_date", "weather_condition").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.count_distinct("pickup_location_id").alias("active_pickup_zones"),
        F.count_distinct("dropoff_location_id").alias("active_dropoff_zones"),
    )
    report = op.daily_weather_impact(fact)
    assert rows(report.select(direct.columns)) == rows(direct)
    days = [r.pickup_date for r in report.collect()]
    assert days == sorted(days, reverse=True)


def test_zone_analysis_agrees_with_the_metrics_of_each_end(spark, validated):
    zones = op.zone_analysis(fx.taxi_zone(spark, SF_DIR), validated)
    for role, column in (("pickup", "pickup_location_id"), ("dropoff", "dropoff_location_id")):
        one = op.zone_metrics(validated, column, role)
        want = one.select(F.col("location_id"), "trip_count", F.round("avg_fare", 6))
        got = zones.where(f"{role}_trips > 0").select(
            "LocationID", f"{role}_trips", F.round(f"avg_{role}_fare", 6)
        )
        assert rows(got) == rows(want)
    assert zones.where("primary_zone_role IS NULL AND total_trips > 0").isEmpty()


def test_month_ranges_are_cut_at_both_ends(spark):
    got = rows(op.month_ranges(spark, dt.date(2023, 12, 15), dt.date(2024, 2, 10)))
    assert got == [
        (dt.date(2023, 12, 15), dt.date(2023, 12, 31), "2023/12"),
        (dt.date(2024, 1, 1), dt.date(2024, 1, 31), "2024/01"),
        (dt.date(2024, 2, 1), dt.date(2024, 2, 10), "2024/02"),
    ]
    assert rows(op.month_ranges(spark, dt.date(2024, 2, 1), dt.date(2024, 1, 1))) == []


def test_expected_and_missing_files(spark):
    stations = spark.createDataFrame([("JFK",), ("LGA",)], "id string")
    expected = op.expected_weather_files(stations, dt.date(2024, 1, 1), dt.date(2024, 2, 3))
    listed = spark.createDataFrame([("JFK_20240101_20240131.csv",)], "source_file string")
    assert [r.source_file for r in op.missing_files(expected, listed).orderBy("source_file").collect()] == [
        "JFK_20240201_20240203.csv", "LGA_20240101_20240131.csv", "LGA_20240201_20240203.csv",
    ]
    trips = op.expected_trip_files(spark, "yellow", 2023, dt.date(2024, 2, 28))
    assert trips.count() == 14
    assert "yellow_2024-02.parquet" in [r.source_file for r in trips.collect()]


def test_coverage_gaps_by_day_and_month(spark):
    obs = spark.createDataFrame(
        [("A", TS(2024, 3, 10, 2, 30)), ("A", TS(2024, 3, 12, 23)), ("B", None)],
        "station string, valid timestamp_ntz",
    )
    stations = spark.createDataFrame([("A",), ("B",)], "id string")
    days = op.coverage_gaps(obs, stations, TS(2024, 3, 10), TS(2024, 3, 12), "day")
    assert rows(days) == [
        ("A", TS(2024, 3, 11)), ("B", TS(2024, 3, 10)), ("B", TS(2024, 3, 11)), ("B", TS(2024, 3, 12)),
    ]
    hours = op.coverage_gaps(obs, stations, TS(2024, 3, 10, 1), TS(2024, 3, 10, 3), "hour")
    assert ("A", TS(2024, 3, 10, 2)) not in rows(hours) and hours.count() == 5
    months = op.coverage_gaps(obs, stations, TS(2024, 2, 20), TS(2024, 3, 12), "month")
    assert rows(months) == [("A", TS(2024, 2, 1)), ("B", TS(2024, 2, 1)), ("B", TS(2024, 3, 1))]


def test_project(spark):
    df = spark.range(3)
    fields = [{"name": "id"}, {"name": "twice", "transformation": "id * 2"}]
    assert rows(op.project(df, fields)) == [(0, 0), (1, 2), (2, 4)]
    assert op.project(df).columns == ["id"]


def test_with_lineage_is_utc(spark):
    moment = dt.datetime(2024, 1, 1, 22, tzinfo=dt.timezone(dt.timedelta(hours=-5)))
    got = op.with_lineage(spark.range(1), moment).first()
    assert got.file_date == dt.date(2024, 1, 2)
    assert got.processed_at.timestamp() == moment.timestamp()

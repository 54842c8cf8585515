from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyfare import functions as fn
from skyfare.functions import labels

TS = dt.datetime


def values(df, column):
    return [r[column] for r in df.select(column).collect()]


def test_safe_int_rounds_half_away_from_zero(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, 2.5D), (2, -2.5D), (3, 2.4D), (4, double('NaN')), (5, 1e30D), (6, NULL) t(i, x)"
    ).orderBy("i")
    assert values(df.select(fn.safe_int(df, "x").alias("n")), "n") == [3, -3, 2, None, None, None]


def test_safe_int_of_text(spark):
    df = spark.createDataFrame([("1",), ("x",), ("2.5",), (None,)], "x string").coalesce(1)
    assert values(df.select(fn.safe_int(df, "x").alias("n")), "n") == [1, None, None, None]


def test_safe_double_and_string(spark):
    df = spark.createDataFrame([("1.5", 2.0), ("x", 2.5), (None, None)], "a string, b double").coalesce(1)
    out = df.select(fn.safe_double("a").alias("a"), fn.safe_string(df, "b").alias("b"))
    assert [tuple(r) for r in out.collect()] == [(1.5, "2"), (None, "2.5"), (None, None)]


@pytest.mark.parametrize(
    "text, number",
    [
        ("M", None), ("NA", None), ("None", None), ("null", None), ("", None), ("nan", None),
        ("NaN", None), ("T", None), ("1.5d", None), ("2F", None), ("abc", None), (None, None),
        ("1.5", 1.5), ("-3", -3.0), (" 7 ", 7.0), ("1e2", 100.0), ("0", 0.0),
    ],
)
def test_clean_number(spark, text, number):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(fn.clean_number(F.col("x"))).first()[0] == number


def test_parse_wall_clock(spark):
    df = spark.createDataFrame([("2023-01-01 00:51",), ("M",), (None,)], "x string").coalesce(1)
    got = values(df.select(fn.parse_wall_clock(F.col("x")).alias("t")), "t")
    assert got == [TS(2023, 1, 1, 0, 51), None, None]


def test_time_does_not_depend_on_the_session_zone(spark):
    """02:30 on 10 March 2024 does not exist in the session's zone, New York."""
    df = spark.sql(
        "SELECT timestamp_ntz'2024-03-10 01:30:00' AS a, timestamp_ntz'2024-03-10 02:30:01.9' AS b"
    )
    got = df.select(
        fn.hour_bucket(F.col("b")),
        fn.whole_seconds(F.col("a"), F.col("b")),
        fn.whole_seconds(F.col("b"), F.col("a")),
        fn.weekday(F.col("a")),
    ).first()
    assert tuple(got) == (TS(2024, 3, 10, 2), 3601, -3601, 1)


def test_months_before_clamps_to_month_end(spark):
    day = spark.range(1).select(fn.months_before(dt.date(2024, 4, 30), 2)).first()[0]
    assert day == dt.date(2024, 2, 29)
    assert spark.range(1).select(fn.months_before(None, 2)).first()[0] is not None


def test_mean_ratio_leaves_zero_denominators_out(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (3.0, 2.0)], "n double, d double")
    assert df.agg(fn.mean_ratio(F.col("n"), F.col("d"), 100.0)).first()[0] == 100.0
    none = df.where("d = 0").agg(fn.mean_ratio(F.col("n"), F.col("d"))).first()[0]
    assert none is None


def test_partial_mean_equals_mean(spark):
    df = spark.sql("SELECT id % 7 AS g, IF(id % 5 = 0, NULL, double(id)) AS x FROM range(100)")
    mean = fn.PartialMean("x", F.col("x"))
    two_steps = df.groupBy("g").agg(*mean.start()).agg(mean.finish()).first()[0]
    assert two_steps == pytest.approx(df.agg(F.avg("x")).first()[0])


@pytest.mark.parametrize(
    "p, v, t, label",
    [
        (0.11, 1.0, 20.0, "Rainy"), (0.1, 2.9, 20.0, "Poor Visibility"), (0.1, 3.0, 31.9, "Freezing"),
        (0.0, 3.0, 32.0, "Normal"), (0.0, 9.0, 85.0, "Normal"), (0.0, 9.0, 85.1, "Hot"),
        (None, None, None, "Normal"), (None, 2.0, None, "Poor Visibility"),
    ],
)
def test_weather_condition(spark, p, v, t, label):
    df = spark.createDataFrame([(p, v, t)], "p double, v double, t double")
    assert df.select(fn.weather_condition(F.col("p"), F.col("v"), F.col("t"))).first()[0] == label


GOOD = {
    "pickup_datetime": TS(2023, 5, 1, 10), "dropoff_datetime": TS(2023, 5, 1, 10, 10),
    "trip_duration_seconds": 600, "trip_distance": 2.0, "fare_amount": 9.0, "passenger_count": 1,
    "station_id": "JFK", "station_name": "n", "station_zone": "z", "weather_condition": "Normal",
}
TRIP = (
    "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, trip_duration_seconds bigint, "
    "trip_distance double, fare_amount double, passenger_count bigint, station_id string, "
    "station_name string, station_zone string, weather_condition string"
)
AS_OF = dt.date(2024, 4, 30)


@pytest.mark.parametrize(
    "changes, label",
    [
        ({}, labels.VALID),
        ({"pickup_datetime": TS(2021, 12, 31, 23, 59)}, labels.TOO_OLD),
        ({"dropoff_datetime": TS(2021, 12, 31)}, labels.TOO_OLD),
        ({"pickup_datetime": TS(2022, 1, 1)}, labels.VALID),
        ({"pickup_datetime": TS(2024, 2, 29, 23)}, labels.VALID),
        ({"pickup_datetime": TS(2024, 3, 1)}, labels.TOO_RECENT),
        ({"dropoff_datetime": TS(2024, 3, 1)}, labels.TOO_RECENT),
        ({"trip_duration_seconds": -1}, labels.BAD_DURATION),
        ({"trip_distance": 0.0}, labels.ZERO_DISTANCE),
        ({"trip_distance": 0.0, "trip_duration_seconds": 60}, labels.VALID),
        ({"trip_distance": 0.0, "trip_duration_seconds": 61}, labels.ZERO_DISTANCE),
        ({"fare_amount": -0.01}, labels.NEGATIVE_FARE),
        ({"fare_amount": 0.0}, labels.VALID),
        ({"passenger_count": 0}, labels.BAD_PASSENGERS),
        ({"station_id": None}, labels.NO_STATION),
        ({"weather_condition": None}, labels.NO_WEATHER),
        # the first rule wins
        ({"fare_amount": -1.0, "passenger_count": 0}, labels.NEGATIVE_FARE),
        ({"trip_duration_seconds": -5, "pickup_datetime": TS(2020, 1, 1)}, labels.TOO_OLD),
        # a missing value matches no rule
        ({"trip_distance": None, "fare_amount": None, "passenger_count": None}, labels.VALID),
        ({"pickup_datetime": None, "weather_condition": None}, labels.NO_WEATHER),
        ({"pickup_datetime": None, "dropoff_datetime": TS(2020, 1, 1)}, labels.TOO_OLD),
        ({"dropoff_datetime": None, "trip_duration_seconds": None}, labels.VALID),
    ],
)
def test_data_quality_check(spark, changes, label):
    df = spark.createDataFrame([tuple({**GOOD, **changes}.values())], TRIP)
    assert df.select(fn.data_quality_check(labels.DEFAULT_MIN_DATE, AS_OF)).first()[0] == label


@pytest.mark.parametrize(
    "changes, label",
    [
        ({}, labels.COMPLETE),
        ({"pickup_datetime": None}, labels.MISSING_TIMESTAMP),
        ({"dropoff_datetime": None, "fare_amount": None}, labels.MISSING_TIMESTAMP),
        ({"trip_distance": None}, labels.MISSING_DISTANCE),
        ({"fare_amount": None, "passenger_count": None}, labels.MISSING_FARE),
        ({"passenger_count": None}, labels.MISSING_PASSENGERS),
        ({"station_id": None, "station_name": None}, labels.MISSING_STATION),
        ({"station_name": None}, labels.MISSING_STATION_NAME),
        ({"station_zone": None}, labels.MISSING_STATION_ZONE),
        ({"weather_condition": None}, labels.MISSING_WEATHER),
    ],
)
def test_missing_values_flag(spark, changes, label):
    df = spark.createDataFrame([tuple({**GOOD, **changes}.values())], TRIP)
    assert df.select(fn.missing_values_flag()).first()[0] == label


@pytest.mark.parametrize(
    "ts, valid",
    [
        (TS(2021, 12, 31), False), (TS(2022, 1, 1), True), (TS(2024, 2, 29, 12), True),
        (TS(2024, 3, 1), False), (None, True),
    ],
)
def test_is_valid_date(spark, ts, valid):
    df = spark.createDataFrame([(ts,)], "t timestamp_ntz")
    flag = fn.is_valid_date(F.col("t"), labels.DEFAULT_MIN_DATE, AS_OF)
    assert df.select(flag).first()[0] is valid


def test_file_name_tokens(spark):
    names = ["JFK_20230101_20230131.csv", "readme.csv"]
    df = spark.createDataFrame([(n,) for n in names], "n string").coalesce(1)
    got = df.select(fn.station_token(F.col("n")), fn.date_token(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [("JFK", "20230101"), ("readme.csv", None)]

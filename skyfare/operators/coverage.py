"""What should be there and is not: periods per station, and files per period."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_STEP = {"hour": "INTERVAL 1 HOUR", "day": "INTERVAL 1 DAY", "month": "INTERVAL 1 MONTH"}


def _period(ts: Column, unit: str) -> Column:
    """Start of the hour, day or month of a zone-less timestamp."""
    day = F.lit(1) if unit == "month" else F.dayofmonth(ts)
    hour = F.hour(ts) if unit == "hour" else F.lit(0)
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), day, hour, F.lit(0), F.lit(0))


def _spine(first: Column, last: Column, unit: str) -> Column:
    """One row per period. A sequence may not run backwards, so callers drop the rows of an empty
    span and this one ends where it starts."""
    return F.explode(F.sequence(first, F.greatest(first, last), F.expr(_STEP[unit])))


def coverage_gaps(
    observations: DataFrame,
    stations: DataFrame,
    start: dt.datetime,
    end: dt.datetime,
    unit: str = "month",
) -> DataFrame:
    """Periods from `start` to `end` in which a station of `stations` (id) has no observation
    (station, valid), as (station, period).

    Each station's periods are generated on its own row, so nothing is crossed.
    """
    # by way of text: a datetime literal would pass through the session time zone
    bounds = (F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in (start, end))
    first, last = (_period(bound, unit) for bound in bounds)
    expected = stations.where(F.lit(start <= end)).select(
        F.col("id").alias("station"), _spine(first, last, unit).alias("period")
    )
    observed = observations.select(
        "station", _period(F.col("valid").cast("timestamp_ntz"), unit).alias("period")
    ).distinct()
    return expected.join(observed, ["station", "period"], "left_anti")


def _with_months(df: DataFrame, start: dt.date, as_of: dt.date) -> DataFrame:
    month = _spine(F.trunc(F.lit(start), "month"), F.lit(as_of), "month")
    months = df.where(F.lit(start <= as_of)).select("*", month.alias("_month"))
    return months.select(
        *df.columns,
        F.greatest("_month", F.lit(start)).alias("start_date"),
        F.least(F.last_day("_month"), F.lit(as_of)).alias("end_date"),
        F.date_format("_month", "yyyy/MM").alias("year_month"),
    )


def month_ranges(spark: SparkSession, start: dt.date, as_of: dt.date) -> DataFrame:
    """Calendar months from `start` up to `as_of`, cut at both ends: (start_date, end_date,
    year_month)."""
    return _with_months(spark.range(1), start, as_of).drop("id")


def expected_weather_files(stations: DataFrame, start: dt.date, as_of: dt.date) -> DataFrame:
    """Weather file that each station of `stations` (id) should have for each month."""
    first, last = (F.date_format(day, "yyyyMMdd") for day in ("start_date", "end_date"))
    files = _with_months(stations.select(F.col("id").alias("station")), start, as_of)
    return files.withColumn(
        "source_file", F.concat(F.concat_ws("_", "station", first, last), F.lit(".csv"))
    )


def expected_trip_files(
    spark: SparkSession,
    prefix: str,
    start_year: int,
    as_of: dt.date,
    extension: str = ".parquet",
) -> DataFrame:
    """Trip file of each month from January of `start_year` to the month of `as_of`."""
    ranges = month_ranges(spark, dt.date(start_year, 1, 1), as_of)
    month = F.replace("year_month", F.lit("/"), F.lit("-"))
    return ranges.select(
        "year_month", F.concat(F.lit(f"{prefix}_"), month, F.lit(extension)).alias("source_file")
    )


def missing_files(expected: DataFrame, listed: DataFrame) -> DataFrame:
    """Expected files that are not listed."""
    return expected.join(listed.select("source_file"), "source_file", "left_anti").select(
        *expected.columns
    )

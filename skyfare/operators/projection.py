"""Row-wise operators: configured projection, cleaning, null filling, lineage columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skyfare.functions.casts import MISSING_TOKENS, clean_number, parse_wall_clock
from skyfare.schemas import WEATHER_NUMERIC_FIELDS

# What a missing trip field is filled with.
TRIP_FILLS = {
    "passenger_count": 1,
    "trip_distance": 0.0,
    "fare_amount": 0.0,
    "extra": 0.0,
    "mta_tax": 0.0,
    "tip_amount": 0.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.0,
    "total_amount": 0.0,
    "congestion_surcharge": 0.0,
    "trip_duration_seconds": 0,
}


def fill_trip_nulls() -> dict[str, Column]:
    """Filled form of each trip column that is filled."""
    return {name: F.coalesce(F.col(name), F.lit(value)) for name, value in TRIP_FILLS.items()}


def project(df: DataFrame, fields: Sequence[Mapping[str, str]] | None = None) -> DataFrame:
    """Configured projection: each field has a `name` and may have a SQL `transformation` that
    computes it. Without fields every column is kept."""
    if not fields:
        return df
    return df.select(
        *[
            F.expr(field["transformation"]).alias(field["name"])
            if "transformation" in field
            else F.col(field["name"])
            for field in fields
        ]
    )


def clean_numeric(
    df: DataFrame,
    columns: Iterable[str] = WEATHER_NUMERIC_FIELDS,
    tokens: Iterable[str] = MISSING_TOKENS,
) -> DataFrame:
    """Turn text columns into numbers; columns the frame does not have are passed over."""
    tokens = list(tokens)
    return df.withColumns(
        {c: clean_number(F.col(c), tokens) for c in columns if c in df.columns}
    )


def parse_valid(df: DataFrame) -> DataFrame:
    """Read the observation time from text; text that is no time becomes NULL."""
    if "valid" not in df.columns:
        return df
    return df.withColumn("valid", parse_wall_clock(F.col("valid")))


def with_lineage(df: DataFrame, processed_at: dt.datetime) -> DataFrame:
    """Add the moment of processing and its UTC day."""
    moment = processed_at.astimezone(dt.timezone.utc)
    return df.withColumns({"file_date": F.lit(moment.date()), "processed_at": F.lit(moment)})

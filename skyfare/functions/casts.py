"""Lenient conversions: a value that does not fit becomes NULL instead of failing the job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

# How a weather file writes "no value". NaN is included because a cast would keep it.
MISSING_TOKENS = ("M", "NA", "None", "null", "", "nan", "NaN")

_FRACTIONAL = (T.DoubleType, T.FloatType, T.DecimalType)


def safe_int(df: DataFrame, name: str) -> Column:
    """Whole number or NULL; fractions round half away from zero, fractional text is NULL."""
    value = F.col(name)
    if isinstance(df.schema[name].dataType, _FRACTIONAL):
        value = F.round(value)
    return value.try_cast("bigint")


def _java_number(text: Column) -> Column:
    """Text that ends in one of Java's type suffixes ('1.5d'): the cast takes it, a data file does not."""
    return text.rlike(r"[0-9.][dDfF]\s*$")


def safe_double(name: str, df: DataFrame | None = None) -> Column:
    """Number or NULL. With `df`, the guard against type suffixes is left out where the column is no text."""
    value = F.col(name)
    if df is None or isinstance(df.schema[name].dataType, T.StringType):
        value = F.when(~_java_number(value.cast("string")), value)
    return value.try_cast("double")


def safe_string(df: DataFrame, name: str) -> Column:
    """Text form; a whole number held in a floating column prints without its '.0'."""
    value = F.col(name)
    text = value.try_cast("string")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        whole = value.try_cast("bigint")
        return F.when(whole.cast("double") == value, whole.cast("string")).otherwise(text)
    return text


def clean_number(text: Column, tokens: Iterable[str] = MISSING_TOKENS) -> Column:
    """Number in `text`, or NULL for a missing-value token or anything that is not a number."""
    not_a_number = text.isin(list(tokens)) | _java_number(text)
    return F.when(~not_a_number, text).try_cast("double")


def parse_wall_clock(text: Column) -> Column:
    """Zone-less timestamp in `text`, or NULL."""
    return text.try_cast("timestamp_ntz")

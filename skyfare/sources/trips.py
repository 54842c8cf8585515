"""Trip Parquet files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from skyfare.functions.names import scanned_file


def read_trips(
    spark: SparkSession, *paths: str, glob: str = "*.parquet", schema: T.StructType | None = None
) -> DataFrame:
    """Trips of all files in one scan, plus the name of each row's file; the schema is taken from the
    files unless it is given."""
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    reader = reader.option("mergeSchema", True) if schema is None else reader.schema(schema)
    trips = reader.parquet(*paths)
    return trips.select(*trips.columns, scanned_file().alias("source_file"))


def available(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """Wanted columns that exist, in the order wanted; all columns when none is left."""
    found = [name for name in wanted if name in df.columns]
    return found or df.columns


def read_columns(spark: SparkSession, path: str, wanted: Sequence[str] = ()) -> DataFrame:
    """Scan of the wanted columns; columns a file set does not have are passed over."""
    df = spark.read.parquet(path)
    return df.select(*available(df, wanted))

"""File listings and the ledger of files already loaded, as DataFrames of file names."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyfare.functions.names import date_token


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files below `path` as (path, source_file); only names are read, never contents."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(path)
    )
    return listing.select("path", F.element_at(F.split("path", "/"), -1).alias("source_file"))


def _day_text(day: str | dt.date | None) -> str | None:
    return None if day is None else str(day).replace("-", "")


def prune_files(
    files: DataFrame, start: str | dt.date | None = None, end: str | dt.date | None = None
) -> DataFrame:
    """Keep files whose first day, the second token of the name, lies in [start, end].

    Days are compared as text, YYYYMMDD. A name without a second token is kept.
    """
    token = date_token(F.col("source_file"))
    first, last = _day_text(start), _day_text(end)
    if first is not None:
        files = files.where(token.isNull() | (token >= first))
    if last is not None:
        files = files.where(token.isNull() | (token <= last))
    return files


def loaded_files(spark: SparkSession, table: str, column: str = "source_file") -> DataFrame:
    """Names of the files a table was loaded from. A table that does not exist has loaded none;
    any other problem with the table is an error, not an empty ledger."""
    if not spark.catalog.tableExists(table):
        return spark.createDataFrame([], "source_file string")
    spark.catalog.refreshTable(table)  # another session may have added files
    names = spark.table(table).select(F.col(column).alias("source_file"))
    return names.where(F.col("source_file").isNotNull()).distinct()


def new_files(listed: DataFrame, loaded: DataFrame) -> DataFrame:
    """Listed files that are not in the ledger."""
    return listed.join(loaded.select("source_file"), "source_file", "left_anti").select(
        *listed.columns
    )


def file_stats(df: DataFrame) -> DataFrame:
    """Rows per source file."""
    return df.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))

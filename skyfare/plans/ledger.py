"""The ledger of a raw table: a small table of its own with one entry per file and attempt to load it.

A load first writes down which files it begins with, then adds their rows in one append, then writes down how
each came out. Loads list and report by the ledger alone; the table of rows, however large, is not read for it.

A load that breaks off leaves files that were begun and have no outcome. The next load looks for these few
names in the table: an append adds all of a load's rows or none, so rows that are there mean that only
the outcome was lost; without rows the file is loaded again.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from skyfare.operators.lookup import lookup_join
from skyfare.scratch import hold
from skyfare.sinks.tables import drop_table, materialize, table_exists
from skyfare.sources.files import file_stats

# Outcomes.
BEGUN, LOADED, EMPTY, FAILED = "begun", "loaded", "empty", "failed"
_ENTRY = "source_file string, path string, rows bigint, outcome string, reason string, load string, at timestamp"


class Ledger:
    """The files of one raw table; `column` is the table's column with the name of each row's file."""

    def __init__(self, spark: SparkSession, table: str, column: str = "source_file", load: str | None = None):
        self.spark, self.table, self.column = spark, table, column
        self.name = f"{table}__files"
        self.load = load or uuid.uuid4().hex  # entries of one load, or of one run of a stream, share it

    def entries(self) -> DataFrame:
        if not table_exists(self.spark, self.name):
            return self.spark.createDataFrame([], _ENTRY)
        self.spark.catalog.refreshTable(self.name)  # another session may have added entries
        return self.spark.table(self.name)

    def latest(self) -> DataFrame:
        """The last entry of each file. Where a file was loaded once, that stands."""
        order = Window.partitionBy("source_file").orderBy(F.desc(F.col("outcome") == LOADED), F.desc("at"), F.desc(F.col("outcome") != BEGUN))
        return self.entries().withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")

    def loaded(self) -> DataFrame:
        """(source_file, rows) of the files that the table has rows of."""
        return self.entries().where(F.col("outcome") == LOADED).groupBy("source_file").agg(F.max("rows").alias("rows"))

    def failed(self) -> DataFrame:
        """(path, source_file) of the files whose last attempt failed: they are tried again until they load."""
        return self.latest().where(F.col("outcome") == FAILED).select("path", "source_file")

    def _add(self, entries: DataFrame) -> None:
        rows = entries.select(
            "source_file", "path", F.col("rows").cast("bigint").alias("rows"), "outcome", "reason", F.lit(self.load).alias("load"), F.current_timestamp().alias("at")
        )
        materialize(rows.coalesce(1), self.name, "append")  # names of one load's files

    def settle(self) -> None:
        """Make good what an earlier load left open, and take in a table that was loaded without a ledger."""
        if not table_exists(self.spark, self.table):
            drop_table(self.spark, self.name)  # of a table that was dropped: nothing of it is loaded any more
            return
        self.spark.catalog.refreshTable(self.table)
        named = F.col(self.column).alias("source_file")
        none = [F.lit(None).cast("string").alias(c) for c in ("path", "reason")]
        if not table_exists(self.spark, self.name):
            counted = file_stats(self.spark.table(self.table).select(named)).where("source_file IS NOT NULL")
            self._add(counted.select("source_file", "rows", F.lit(LOADED).alias("outcome"), *none))
            return
        left = hold(self.latest().where(F.col("outcome") == BEGUN).select("source_file", "path"), "begun-files")
        if left.rows:
            rows = lookup_join(self.spark.table(self.table).select(named), left.select("source_file"), {"source_file": "source_file"}, how="left_semi")
            counted = left.df.join(file_stats(rows), "source_file", "left")
            outcome = F.when(F.col("rows").isNull(), FAILED).otherwise(LOADED)
            reason = F.when(F.col("rows").isNull(), "the load broke off")
            self._add(counted.select("source_file", "path", F.coalesce("rows", F.lit(0)).alias("rows"), outcome.alias("outcome"), reason.alias("reason")))

    def begin(self, files: DataFrame) -> None:
        """`files` (path, source_file) are about to be loaded."""
        none = F.lit(None).cast("string")
        self._add(files.select("source_file", "path", F.lit(0).alias("rows"), F.lit(BEGUN).alias("outcome"), none.alias("reason")))

    def end(self, files: DataFrame, counts: DataFrame, failures: Collection[tuple[str, str]]) -> None:
        """How `files` came out: `counts` (path, rows) of those read, and the failed ones as (path, reason)."""
        known = self.spark.createDataFrame(list(failures), "path string, reason string")

        def plain() -> Column:
            """One file's path is written in two ways: file:/x and file:///x."""
            return F.regexp_replace("path", "^file:/+", "/")

        counted = counts.select(plain().alias("_at"), "rows")
        reasons = known.select(plain().alias("_at"), "reason")
        joined = files.withColumn("_at", plain()).join(counted, "_at", "left").join(reasons, "_at", "left")
        rows = F.when(F.col("reason").isNotNull(), 0).otherwise(F.coalesce("rows", F.lit(0)))
        outcome = F.when(F.col("reason").isNotNull(), FAILED).when(rows == 0, EMPTY).otherwise(LOADED)
        self._add(joined.select("source_file", "path", rows.alias("rows"), outcome.alias("outcome"), "reason"))

    def report(self, detailed: bool = False) -> DataFrame:
        """(source_file, rows) of the files of this load; detailed: also outcome and reason."""
        mine = self.entries().where((F.col("load") == self.load) & (F.col("outcome") != BEGUN))
        if not detailed:
            return mine.select("source_file", "rows")
        return mine.select("source_file", "rows", "outcome", "reason")

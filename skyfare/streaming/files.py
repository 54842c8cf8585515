"""Ingest as a stream of file names.

Each call takes in the files that have appeared since the last one and stops. A micro-batch that is
repeated after a failure leaves out the files that the ledger has as loaded, so it does not add them twice.
A file that cannot be read stays in the ledger as failed, and every later call tries it again until it
loads, although the stream's own checkpoint has its name as done.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyfare.plans.ingest import WEATHER_TABLE, load_trip_files, load_weather_files
from skyfare.plans.ledger import Ledger
from skyfare.scratch import hold
from skyfare.sinks.tables import ensure_table
from skyfare.sources.dimensions import stations_frame
from skyfare.sources.files import list_files, new_files
from skyfare.sources.weather import MARK


def _new_names(spark: SparkSession, path: str, glob: str, files_per_batch: int) -> DataFrame:
    """A stream of the names of files that appear below `path`; their contents are not read."""
    names = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
    )
    return names.select("path", F.element_at(F.split("path", "/"), -1).alias("source_file"))


def _drain(
    spark: SparkSession,
    path: str,
    glob: str,
    files_per_batch: int,
    checkpoint: str,
    ledger: Ledger,
    load: Callable[[Ledger, DataFrame], None],
) -> DataFrame:
    """Load what failed before and is still there, then what is new; gives the outcome of each file."""
    failed = ledger.failed().select("source_file")
    again = hold(list_files(spark, path, glob).join(failed, "source_file", "left_semi").select("path", "source_file"), "failed-files")
    if again.rows:
        load(ledger, again.df)

    def write(batch: DataFrame, _: int) -> None:
        own = Ledger(batch.sparkSession, ledger.table, ledger.column, ledger.load)
        listed = hold(batch, "stream-files").df
        load(own, hold(new_files(listed, own.loaded()), "new-files").df)

    names = _new_names(spark, path, glob, files_per_batch)
    query = (
        names.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # micro-batches write from a session of their own
    if spark.catalog.tableExists(ledger.table):
        spark.catalog.refreshTable(ledger.table)
    return ledger.report(detailed=True)


def stream_trips(
    spark: SparkSession,
    path: str,
    table: str,
    checkpoint: str,
    fields: Sequence[Mapping[str, str]] | None = None,
    files_per_batch: int = 1000,
    table_path: str | None = None,
    ledger_column: str = "source_file",
) -> DataFrame:
    """Append the trips of new Parquet files below `path` to `table`; source_file, rows, outcome and reason
    of every file that this call has tried.

    The stream is of file names; each micro-batch loads its files as `ingest_trips` does, with all
    their columns. A file that cannot be read is reported as failed and tried again by the next call.
    """
    ledger = Ledger(spark, table, ledger_column)
    ledger.settle()

    def load(own: Ledger, todo: DataFrame) -> None:
        load_trip_files(own, todo, fields, table_path)

    return _drain(spark, path, "*.parquet", files_per_batch, checkpoint, ledger, load)


def stream_weather(
    spark: SparkSession,
    path: str,
    stations: Sequence[Mapping[str, str]],
    table: str,
    checkpoint: str,
    processed_at: dt.datetime | None = None,
    files_per_batch: int = 1000,
    table_path: str | None = None,
    mark: str | None = MARK,
) -> DataFrame:
    """Append the observations of new weather files below `path` to `table`, and report as `stream_trips` does.
    `mark` tells a file's preamble, as for `ingest_weather`."""
    ledger = Ledger(spark, table)
    ledger.settle()
    ensure_table(spark, table, WEATHER_TABLE, ["valid_date"], table_path)

    def load(own: Ledger, todo: DataFrame) -> None:
        moment = processed_at or dt.datetime.now(dt.timezone.utc)
        load_weather_files(own, todo, stations_frame(own.spark, stations), moment, mark)

    return _drain(spark, path, "*.csv", files_per_batch, checkpoint, ledger, load)

"""Loading new files into the raw tables, each file once."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import batched

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from skyfare.functions.names import scanned_file
from skyfare.operators.projection import clean_numeric, parse_valid, project, with_lineage
from skyfare.operators.stations import station_lookup
from skyfare.plans.ledger import Ledger
from skyfare.schemas import TRIPS, WEATHER
from skyfare.scratch import Held, hold
from skyfare.sinks.tables import (
    aligned,
    append,
    append_evolving,
    beyond_double,
    doubled,
    ensure_table,
    evolve,
    table_exists,
    wider,
)
from skyfare.sources.dimensions import stations_frame
from skyfare.sources.files import list_files, new_files, prune_files
from skyfare.sources.trips import read_trips
from skyfare.sources.weather import (
    MARK,
    data_lines,
    files_without_header,
    parse_weather_lines,
    weather_headers,
    weather_lines,
)

FILES_PER_LOAD = 4096
FOOTERS_AT_ONCE = 32
WEATHER_TABLE = T.StructType([*WEATHER.fields, T.StructField("valid_date", T.DateType())])

# How Spark reports a file that it cannot read, and files whose schemas do not fit together.
_BAD_FILE = ("FAILED_READ_FILE", "is not a Parquet file", "CANNOT_READ_FILE_FOOTER")
_CLASH = ("CANNOT_MERGE", "COLUMN_ALREADY_EXISTS", "Failed to merge")

_SPARK_SCHEMA = "org.apache.spark.sql.parquet.row.metadata"  # Spark's own entry in a footer

Failures = list[tuple[str, str]]  # (path, reason)


def _reason(error: Exception) -> str:
    return str(error).strip().splitlines()[0][:500]


def _load_or_split(paths: Sequence[str], load: Callable[[Sequence[str]], None]) -> Failures:
    """Load files together; if one of them cannot be read, halve the set until only such files are
    left out. A load is one append, which adds nothing when it fails. Any other error is raised."""
    try:
        load(paths)
        return []
    except (PySparkException, Py4JJavaError) as error:
        if not any(mark in str(error) for mark in _BAD_FILE):
            raise
        if len(paths) == 1:
            return [(paths[0], _reason(error))]
    middle = len(paths) // 2
    return _load_or_split(paths[:middle], load) + _load_or_split(paths[middle:], load)


def _footer(spark: SparkSession, path: str) -> str:
    """A file's columns as its footer has them, read without a job; of a file without a readable one, its path."""
    parquet, conf = spark._jvm.org.apache.parquet, spark._jsc.hadoopConfiguration()
    no_rows = parquet.format.converter.ParquetMetadataConverter.SKIP_ROW_GROUPS
    try:
        file = parquet.hadoop.util.HadoopInputFile.fromPath(spark._jvm.org.apache.hadoop.fs.Path(path), conf)
        options = parquet.HadoopReadOptions.builder(conf).withMetadataFilter(no_rows).build()
        reader = parquet.hadoop.ParquetFileReader.open(file, options)
    except Py4JJavaError:
        return path
    try:
        meta = reader.getFileMetaData()
        return f"{meta.getSchema()} {meta.getKeyValueMetaData().get(_SPARK_SCHEMA)}"
    finally:
        reader.close()


def _schema_of(spark: SparkSession, paths: Sequence[str]) -> tuple[T.StructType | None, str]:
    """The schema of files that fit together, and otherwise why there is none."""
    try:
        return spark.read.option("mergeSchema", True).parquet(*paths).schema, ""
    except (PySparkException, Py4JJavaError) as error:
        marks = (*_BAD_FILE, "UNABLE_TO_INFER_SCHEMA", *(_CLASH if len(paths) > 1 else ()))
        if not any(mark in str(error) for mark in marks):
            raise
        return None, _reason(error)


def _fits(one: T.StructType, other: T.StructType) -> bool:
    """Whether columns of one name, letter case aside, are the same column in both."""
    known = {f.name.lower(): f for f in one.fields}
    return all(known.get(f.name.lower(), f) == f for f in other.fields)


def file_schemas(spark: SparkSession, paths: Sequence[str]) -> tuple[dict[str, list[str]], Failures]:
    """Files grouped by schema (as JSON), from their footers, and the files without a readable one.

    Footers of files that fit together are read in one job. Where some do not, each file's footer is read
    once, many at a time and without jobs; of files with the same footer one stands for all. So the number
    of jobs is that of different footers and unreadable files, not of files. No rows are read.
    """
    schema, reason = _schema_of(spark, paths)
    if schema is not None:
        return {schema.json(): list(paths)}, []
    if len(paths) == 1:
        return {}, [(paths[0], reason)]
    alike: dict[str, list[str]] = {}
    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        for path, footer in zip(paths, pool.map(lambda path: _footer(spark, path), paths)):
            alike.setdefault(footer, []).append(path)
        kinds = list(pool.map(lambda files: _schema_of(spark, files[:1]), alike.values()))
    groups: list[tuple[T.StructType, list[str]]] = []
    failures: Failures = []
    for files, (schema, reason) in zip(alike.values(), kinds):
        if schema is None:
            failures += [(path, reason) for path in files]
            continue
        at = next((i for i, (known, _) in enumerate(groups) if _fits(known, schema)), len(groups))
        known, some = groups[at] if at < len(groups) else (T.StructType(), [])
        names = set(known.fieldNames())
        wide = T.StructType([*known.fields, *(f for f in schema.fields if f.name not in names)])
        groups[at : at + 1] = [(wide, some + files)]
    merged: dict[str, list[str]] = {}
    for schema, files in groups:
        merged.setdefault(schema.json(), []).extend(files)
    return merged, failures


def _batches(todo: DataFrame) -> Iterator[DataFrame]:
    """Files (path, source_file), a bounded number at a time. Only file names pass through the driver, where
    Spark keeps the names of the files of a scan."""
    names = todo.select("path", "source_file").orderBy("path").toLocalIterator()
    for some in batched(names, FILES_PER_LOAD):
        yield todo.sparkSession.createDataFrame([tuple(r) for r in some], "path string, source_file string")


def _paths(files: DataFrame) -> list[str]:
    return [r.path for r in files.collect()]  # one batch's


_COUNTS = "path string, rows bigint"


def weather_rows(
    parsed: DataFrame, stations: Held | DataFrame, processed_at: dt.datetime
) -> DataFrame:
    """Text rows of weather files as rows of the raw weather table."""
    typed = parse_valid(clean_numeric(parsed))
    rows = with_lineage(station_lookup(typed, stations), processed_at)
    return rows.select(
        *WEATHER.fieldNames(), F.to_date("valid").alias("valid_date")
    )


def ingest_weather(
    spark: SparkSession,
    path: str,
    stations: Sequence[Mapping[str, str]],
    table: str,
    processed_at: dt.datetime | None = None,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    table_path: str | None = None,
    detailed: bool = False,
    mark: str | None = MARK,
) -> DataFrame:
    """Append the weather files below `path` that `table` has not been loaded from; rows per file,
    with `detailed` also the outcome (loaded, empty, failed) and the reason of a failure.

    The table is partitioned by the day of the observation and sorted by station within files. Lines
    that begin with `mark` are a file's preamble; with `mark` None it is all that stands before the header.
    """
    moment = processed_at or dt.datetime.now(dt.timezone.utc)
    listed = prune_files(list_files(spark, path, "*.csv"), start, end)
    ledger = Ledger(spark, table)
    ledger.settle()
    ensure_table(spark, table, WEATHER_TABLE, ["valid_date"], table_path)
    known = stations_frame(spark, stations)

    todo = hold(new_files(listed, ledger.loaded()), "new-files").df
    load_weather_files(ledger, todo, known, moment, mark)
    return ledger.report(detailed)


def load_weather_files(
    ledger: Ledger,
    todo: DataFrame,
    stations: Held | DataFrame,
    moment: dt.datetime,
    mark: str | None = MARK,
) -> None:
    """Append the weather files that `todo` (path, source_file) lists, and enter them into the ledger; files
    without a header are failures. The text is read once; what follows reads the lines held."""
    spark = ledger.spark
    for files in _batches(todo):
        counts, headless = [spark.createDataFrame([], _COUNTS)], []

        def load(paths: Sequence[str], counts: list[DataFrame] = counts, headless: Failures = headless) -> None:
            lines = hold(weather_lines(spark, *paths), "weather-lines").df
            headers = weather_headers(lines, mark)
            rows = weather_rows(parse_weather_lines(lines, mark, headers), stations, moment)
            append_evolving(rows, ledger.table, ["station"])
            counted = data_lines(lines, headers, mark).groupBy(F.col("file_path").alias("path"))
            counts.append(counted.agg(F.count(F.lit(1)).alias("rows")))
            # names of the files of this load
            headless.extend((r.file_path, "no header line") for r in files_without_header(lines, headers).collect())

        ledger.begin(files)
        failures = _load_or_split(_paths(files), load)
        ledger.end(files, reduce(DataFrame.unionByName, counts), failures + headless)


def trip_rows(
    raw: DataFrame, fields: Sequence[Mapping[str, str]] | None, ledger_column: str = "source_file"
) -> DataFrame:
    """Rows of trip files as rows of the raw trip table: the configured fields, or all."""
    if fields:
        raw = project(raw, [*fields, {"name": "source_file"}])
    return raw.withColumnRenamed("source_file", ledger_column)


def _table_schema(schemas: Sequence[T.StructType], table: T.StructType | None) -> T.StructType:
    """One schema for files of all `schemas`: a column in a type that holds the values of all of them,
    and at least what the models expect of it. Names are matched without regard to letter case; of
    several spellings the models' one counts, else the table's, else the first in order of text."""
    expected = {f.name.lower(): f for f in TRIPS.fields}
    merged: dict[str, T.StructField] = {f.name.lower(): f for f in (table.fields if table else ())}
    fixed = set(merged)
    for f in (f for s in schemas for f in s.fields):
        key = f.name.lower()
        now = merged.get(key)
        if now is None:
            model = expected.get(key)
            name = model.name if model else f.name
            kind = wider(model.dataType, f.dataType) if model else f.dataType
        else:
            name = now.name if key in fixed or key in expected else min(now.name, f.name)
            kind = wider(now.dataType, f.dataType)
        merged[key] = T.StructField(name, kind)
    return T.StructType(list(merged.values()))


def load_trip_files(
    ledger: Ledger,
    todo: DataFrame,
    fields: Sequence[Mapping[str, str]] | None,
    table_path: str | None,
) -> None:
    """Append the trip files that `todo` (path, source_file) lists, and enter them into the ledger.

    The footers of all of them decide the table's columns and types before the first row is stored;
    files are then read by schema, each group in one scan, and stored in one append per load.
    """
    spark, table = ledger.spark, ledger.table
    loads: list[tuple[DataFrame, dict[str, list[str]], Failures]] = []
    for files in _batches(todo):
        loads.append((files, *file_schemas(spark, _paths(files))))

    def rows_of(schema: str, paths: Sequence[str]) -> DataFrame:
        raw = read_trips(spark, *paths, schema=T.StructType.fromJson(json.loads(schema)))
        return trip_rows(raw, fields, ledger.column)

    results = {s: rows_of(s, files[:1]).schema for _, groups, _ in loads for s, files in groups.items()}
    schema = _loaded_schema(ledger, results, loads, rows_of, table_path) if results else None
    for files, groups, unread in loads:
        group_of = {path: s for s, paths in groups.items() for path in paths}
        counts = [spark.createDataFrame([], _COUNTS)]

        def load(paths: Sequence[str], group_of: Mapping[str, str] = group_of, counts: list[DataFrame] = counts) -> None:
            by_schema: dict[str, list[str]] = {}
            for path in paths:
                by_schema.setdefault(group_of[path], []).append(path)
            parts = [aligned(rows_of(s, files), schema) for s, files in by_schema.items()]
            append(reduce(DataFrame.unionByName, parts), table)
            for s, some in by_schema.items():  # from the files' footers: no column is read
                read = spark.read.schema(T.StructType.fromJson(json.loads(s))).parquet(*some)
                counts.append(read.groupBy(scanned_file("path").alias("path")).agg(F.count(F.lit(1)).alias("rows")))

        ledger.begin(files)
        failures = unread + (_load_or_split(sorted(group_of), load) if group_of else [])
        ledger.end(files, reduce(DataFrame.unionByName, counts), failures)


def _loaded_schema(
    ledger: Ledger,
    results: Mapping[str, T.StructType],
    loads: Sequence[tuple[DataFrame, Mapping[str, Sequence[str]], Failures]],
    rows_of: Callable[[str, Sequence[str]], DataFrame],
    table_path: str | None,
) -> T.StructType:
    """The columns that the table has for this load, made or widened where needed.

    Whole numbers that meet fractions, in the table, in other files or in what the models expect, are looked at:
    those beyond 2**53 make the column text.
    """
    spark, table = ledger.spark, ledger.table
    exists = table_exists(spark, table)
    have = spark.table(table).schema if exists else None
    schema = _table_schema(list(results.values()), have)
    far: set[str] = set()
    for s, kind in results.items():
        met = doubled(kind, schema)
        if met:
            for _, groups, _ in loads:
                if s in groups:
                    far |= beyond_double(rows_of(s, groups[s]), met)
    if far:
        text = [T.StructField(f.name, T.StringType() if f.name.lower() in far else f.dataType) for f in schema.fields]
        schema = T.StructType(text)
    if exists:
        evolve(spark, table, schema, far)
        return spark.table(table).schema
    ensure_table(spark, table, schema, path=table_path)
    return schema


def ingest_trips(
    spark: SparkSession,
    path: str,
    table: str,
    fields: Sequence[Mapping[str, str]] | None = None,
    table_path: str | None = None,
    ledger_column: str = "source_file",
    detailed: bool = False,
) -> DataFrame:
    """Append the trip files below `path` that `table` has not been loaded from; rows per file, with
    `detailed` also the outcome (loaded, empty, failed) and the reason of a failure.

    `ledger_column` is the table's column with the name of each row's file.
    """
    ledger = Ledger(spark, table, ledger_column)
    ledger.settle()
    todo = hold(new_files(list_files(spark, path, "*.parquet"), ledger.loaded()), "new-files").df
    load_trip_files(ledger, todo, fields, table_path)
    return ledger.report(detailed)

"""Writing catalog tables stored as Parquet.

A write laid out by date asks adaptive execution to rebalance on the date: small dates share a task
and a hot date is split over several, so neither many tiny files nor one huge task results.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from skyfare.operators.lookup import lookup_join
from skyfare.scratch import Held, discard, hold, remove_path

_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@contextmanager
def _replacing_all(spark: SparkSession) -> Iterator[None]:
    """An overwrite replaces the whole table (static), whatever the session says. Set on the session,
    because a table keeps the options it was written with; nothing here ever sets it to dynamic."""
    before = spark.conf.get(_OVERWRITE_MODE)
    if before.lower() != "static":
        spark.conf.set(_OVERWRITE_MODE, "static")
    try:
        yield
    finally:
        if before.lower() != "static":
            spark.conf.set(_OVERWRITE_MODE, before)


def laid_out(
    df: DataFrame, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()
) -> DataFrame:
    """Rows grouped by partition and sorted by the clustering columns within each file, which keeps
    the row-group minima and maxima tight enough to skip on."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if cluster_by:
        df = df.sortWithinPartitions(*partition_by, *cluster_by)
    return df


def materialize(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    path: str | None = None,
) -> DataFrame:
    """Build table `name` from `df` and return the table."""
    writer = laid_out(df, partition_by, cluster_by).write.format("parquet").mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is not None:
        writer = writer.option("path", path)
    with _replacing_all(df.sparkSession):
        writer.saveAsTable(name)
    return df.sparkSession.table(name)


def _location(spark: SparkSession, table: str) -> str:
    """Where a table's files are."""
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return about["Location"].rstrip("/")


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table with its files, also an external one's."""
    if spark.catalog.tableExists(table):
        location = _location(spark, table)
        spark.sql(f"DROP TABLE {table}")
        remove_path(spark, location)


def table_exists(spark: SparkSession, name: str) -> bool:
    """Whether the table exists. A replacement of it that broke off between its two renames is finished first."""
    following, former = f"{name}__next", f"{name}__former"
    exists = spark.catalog.tableExists(name)
    if spark.catalog.tableExists(former):
        if not exists and spark.catalog.tableExists(following):
            spark.sql(f"ALTER TABLE {following} RENAME TO {name}")
            exists = True
        if exists:
            drop_table(spark, former)
    return exists


def replace_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()
) -> DataFrame:
    """Put `df` in the place of table `name`, which `df` may read.

    It is written in full to a second location, as a table of its own; the two tables then change names,
    which touches none of the new files, and the former one is removed. Whatever fails while it is
    written leaves the old table whole. What fails between the renames is made good by the next
    `table_exists`. The table then lies beside its former place, on a path of its own: ask the catalog for it.
    """
    spark = df.sparkSession
    if not table_exists(spark, name):
        return materialize(df, name, "overwrite", partition_by, cluster_by)
    following, former = f"{name}__next", f"{name}__former"
    path = f"{_location(spark, name).split('__at_')[0]}__at_{uuid.uuid4().hex}"
    drop_table(spark, following)  # of an earlier attempt
    materialize(df, following, "overwrite", partition_by, cluster_by, path)
    spark.sql(f"ALTER TABLE {name} RENAME TO {former}")
    spark.sql(f"ALTER TABLE {following} RENAME TO {name}")
    drop_table(spark, former)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    path: str | None = None,
) -> None:
    """Create an empty table unless it exists."""
    if not table_exists(spark, name):
        materialize(spark.createDataFrame([], schema), name, "error", partition_by, path=path)


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)
_DOUBLE_DIGITS = 15
_DOUBLE_WHOLE = 1 << 53  # up to here a double holds every whole number


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both; TypeError if there is none.

    Whole numbers and fractions are a double, which holds whole numbers up to 2**53 only: `evolve` and the
    loads look at the values first. Decimals of more than 15 digits beside fractions, or that no decimal
    holds together, are text.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    pair = (a, b)
    if all(isinstance(x, _INTEGRAL) for x in pair):
        return max(pair, key=lambda x: _INTEGRAL.index(type(x)))
    if all(isinstance(x, (*_INTEGRAL, *_FLOATING, T.DecimalType)) for x in pair):
        if any(isinstance(x, _FLOATING) for x in pair):
            long = any(isinstance(x, T.DecimalType) and x.precision > _DOUBLE_DIGITS for x in pair)
            return T.StringType() if long else T.DoubleType()
        decimals = [x if isinstance(x, T.DecimalType) else T.DecimalType(20, 0) for x in pair]
        scale = max(x.scale for x in decimals)
        whole = max(x.precision - x.scale for x in decimals)
        return T.DecimalType(min(38, whole + scale), scale) if whole + scale <= 38 else T.StringType()
    if any(isinstance(x, T.StringType) for x in pair) and not any(
        isinstance(x, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)) for x in pair
    ):
        return T.StringType()
    times = {T.DateType, T.TimestampType, T.TimestampNTZType}
    if {type(x) for x in pair} <= times and T.DateType in {type(x) for x in pair}:
        return next(x for x in pair if not isinstance(x, T.DateType))
    raise TypeError(f"no type holds both {a.simpleString()} and {b.simpleString()}")


_wider = wider


def beyond_double(df: DataFrame, columns: Collection[str]) -> set[str]:
    """Which of the whole-number `columns` (any letter case) hold a value that a double cannot; names in lower case.

    One aggregate over these columns alone, and none if `df` has none of them as whole numbers.
    """
    wanted = {c.lower() for c in columns}
    whole = [f.name for f in df.schema.fields if f.name.lower() in wanted and isinstance(f.dataType, T.LongType)]
    if not whole:
        return set()
    far = [(F.max(F.col(f"`{c}`")) > _DOUBLE_WHOLE) | (F.min(F.col(f"`{c}`")) < -_DOUBLE_WHOLE) for c in whole]
    found = df.agg(*[x.alias(str(i)) for i, x in enumerate(far)]).first()
    return {c.lower() for c, x in zip(whole, found, strict=True) if x}


def doubled(have: T.StructType, more: T.StructType) -> set[str]:
    """Columns (lower case) that are whole numbers in one schema and fractions in the other."""
    named = {f.name.lower(): f.dataType for f in more.fields}
    pairs = [(f.name.lower(), {type(f.dataType), type(named[f.name.lower()])}) for f in have.fields if f.name.lower() in named]
    return {name for name, kinds in pairs if T.LongType in kinds and kinds & {T.FloatType, T.DoubleType}}


def widened(have: T.StructType, more: T.StructType, as_text: Collection[str] = ()) -> T.StructType:
    """The columns of `have`, then those that only `more` has, each in a type that holds both. Names
    are matched without regard to letter case, as Spark does; `have` decides how they are written.
    Columns of `as_text` (lower case) are text where they would be doubles."""

    def wider(a: T.DataType, b: T.DataType, name: str = "") -> T.DataType:
        kind = _wider(a, b)
        return T.StringType() if kind == T.DoubleType() and name in as_text else kind

    named = {f.name.lower(): f for f in more.fields}
    known = {f.name.lower() for f in have.fields}
    both = [
        T.StructField(f.name, wider(f.dataType, named[f.name.lower()].dataType, f.name.lower()) if f.name.lower() in named else f.dataType)
        for f in have.fields
    ]
    added = [T.StructField(f.name, f.dataType) for f in more.fields if f.name.lower() not in known]
    return T.StructType([*both, *added])


def aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`df` with exactly the columns and types of `schema`: absent ones NULL, others cast."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _must_fit(df: DataFrame, table: str, schema: T.StructType) -> None:
    """An error if the table lacks a column of `df`, or has a type that cannot hold its values."""
    known = {f.name.lower() for f in schema.fields}
    surplus = [c for c in df.columns if c.lower() not in known]
    if surplus:
        raise ValueError(f"{table} has no column {', '.join(surplus)}")
    for now, then in zip(schema.fields, widened(schema, df.schema).fields, strict=True):
        if isinstance(now.dataType, T.DoubleType) and now.name.lower() in beyond_double(df, doubled(schema, df.schema)):
            raise ValueError(f"{table}.{now.name} is double and cannot hold whole numbers beyond 2**53")
        if now.dataType != then.dataType:
            raise ValueError(
                f"{table}.{now.name} is {now.dataType.simpleString()} and needs {then.dataType.simpleString()}"
            )


def append(df: DataFrame, table: str, cluster_by: Sequence[str] = ()) -> None:
    """Add rows to an existing table, columns matched by name, laid out by the table's partitions.

    Columns that the table lacks, or whose values its types cannot hold, are an error.
    """
    spark = df.sparkSession
    schema = spark.table(table).schema
    _must_fit(df, table, schema)
    rows = aligned(df, schema)
    laid_out(rows, partition_columns(spark, table), cluster_by).write.insertInto(table)


def evolve(
    spark: SparkSession, table: str, schema: T.StructType, as_text: Collection[str] = ()
) -> None:
    """Give an existing table the columns of `schema` that it lacks, NULL in its rows, and types that
    hold those of `schema` too.

    A column whose type changes makes the table be written anew, beside the old one, which stays whole
    until it is replaced. A column of whole numbers beyond 2**53 that meets fractions becomes text, which
    keeps both; so do the columns `as_text`, whose new values are such.
    """
    have = spark.table(table).schema
    far = beyond_double(spark.table(table), doubled(have, schema))
    want = widened(have, schema, {*as_text, *far})
    if any(now.dataType != then.dataType for now, then in zip(have.fields, want.fields, strict=False)):
        replace_table(aligned(spark.table(table), want), table, partition_columns(spark, table))
        return
    added = want.fields[len(have.fields) :]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def append_evolving(df: DataFrame, table: str, cluster_by: Sequence[str] = ()) -> None:
    """Add rows to an existing table; columns the table lacks are added to it first, and are NULL
    in the rows it already has; a type that cannot hold the new values becomes wider."""
    spark = df.sparkSession
    table_exists(spark, table)
    have = spark.table(table).schema
    far = beyond_double(df, doubled(have, df.schema))
    evolve(spark, table, df.schema, far)
    append(df, table, cluster_by)


def above_high_water(df: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Rows whose `column` is strictly above its maximum in `target`."""
    return df.where(F.col(column) > target.agg(F.max(column)).scalar())


def incremental(
    df: DataFrame, table: str, column: str, full_refresh: bool = False
) -> DataFrame:
    """Rows of `df` still to be loaded into `table`: those above its high-water mark.

    Late rows, at or below the mark, are left out. A table that does not exist or is empty has no
    mark, and a full refresh ignores it: then all rows are to be loaded.
    """
    spark = df.sparkSession
    if full_refresh or not table_exists(spark, table):
        return df
    target = spark.table(table)
    return df if target.isEmpty() else above_high_water(df, target, column)


def _sharing_partitions(target: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """Rows of `target` in partitions that `rows` has rows in. The bounds prune partitions when the
    scan is planned; the semi join prunes those between them when it runs."""
    touched = hold(rows.select(column).distinct(), "upsert-partitions")
    low, high, some_null = touched.df.agg(
        F.min(column), F.max(column), F.count_if(F.col(column).isNull()) > 0
    ).first()
    shared = lookup_join(
        target.where(F.col(column).between(low, high)), touched, {column: column}, how="left_semi"
    ).select(*target.columns)
    if some_null:
        shared = shared.unionByName(target.where(F.col(column).isNull()))
    return shared


def upsert(
    batch: DataFrame,
    table: str,
    keys: Sequence[str],
    partition_by: str,
    cluster_by: Sequence[str] = (),
) -> None:
    """Replace the rows of `table` whose keys occur in `batch`, and add the other rows of `batch`.

    `partition_by`, the table's partition column, must follow from the keys (as the pickup date
    follows from the pickup time): then only partitions the batch has rows in can hold a match, and
    only those are read and rewritten. NULL keys match nothing, and rows of the batch with equal
    keys are all kept. New partitions are written beside the old ones and swapped in on success.
    """
    spark = batch.sparkSession
    target = spark.table(table)
    _must_fit(batch, table, target.schema)
    copy = hold(batch, "upsert-batch")
    rows = copy.df
    in_reach = _sharing_partitions(target, rows, partition_by)
    kept = in_reach.join(rows.select(*keys).distinct(), list(keys), "left_anti")
    merged = kept.select(*target.columns).unionByName(aligned(rows, target.schema))
    # a table cannot be overwritten while it is read, so the merged partitions are held first
    _overwrite_partitions(hold(merged, "upsert-merged"), table, partition_by, cluster_by)
    discard(copy)


def _overwrite_partitions(ready: Held, table: str, partition_by: str, cluster_by: Sequence[str]) -> None:
    """Put the rows of a held table in the place of the partitions that they are in; the copy is removed."""
    spark = ready.df.sparkSession
    # the mode belongs to a session, and others may be writing in this one
    apart = spark.newSession()
    apart.conf.set(_OVERWRITE_MODE, "dynamic")
    again = apart.read.schema(ready.df.schema).parquet(ready.path)
    laid_out(again, [partition_by], cluster_by).write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)
    discard(ready)


def replace_partitions(
    df: DataFrame, table: str, partition_by: str, values: Collection[object] = (), cluster_by: Sequence[str] = ()
) -> None:
    """Replace the partitions of `table` that `df`, which may read the table, has rows in.

    Partitions of `values` that `df` has no rows in are removed. Partitions are swapped in one after another:
    if that breaks off, doing it again puts it right.
    """
    spark = df.sparkSession
    ready = hold(aligned(df, spark.table(table).schema), "partitions")
    present = {r[0] for r in ready.df.select(partition_by).distinct().collect()} if values else set()
    if ready.rows:
        _overwrite_partitions(ready, table, partition_by, cluster_by)
    gone = set(values) - present
    if gone:
        stored = {r[0] for r in spark.table(table).select(partition_by).distinct().collect()}
        location = _location(spark, table)
        for value in gone & stored:
            label = "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)
            spec = "NULL" if value is None else f"'{value}'"
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition_by} = {spec})")
            remove_path(spark, f"{location}/{partition_by}={label}")
        spark.catalog.refreshTable(table)

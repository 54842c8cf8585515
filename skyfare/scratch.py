"""Held tables: intermediate results written once to the shared checkpoint folder and read back.

A held table is an ordinary Parquet folder, so it survives the loss of executors, cuts the lineage,
and gives the next plan true sizes instead of estimates.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

_FIXED_WIDTH = 8
_ROW_OVERHEAD = 16


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="skyfare-")


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for held tables, from `spark.checkpoint.dir`.

    Only a local session may do without that setting; it then gets a temporary folder. A temporary
    folder of one machine is of no use to the executors of a cluster, so there it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        shared = _own_folder(spark.conf.get("spark.app.id", ""))
    return shared.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Held:
    """A table of known size: its rows, and the bytes of each column in memory."""

    df: DataFrame
    rows: int
    widths: Mapping[str, int]
    path: str | None = None

    @property
    def size(self) -> int:
        return self.rows * _ROW_OVERHEAD + sum(self.widths.values())

    def select(self, *columns: str, **renamed: str) -> Held:
        """A projection, sized by its own columns; `new="old"` renames."""
        source = {**{c: c for c in columns}, **renamed}
        return Held(
            self.df.select(*[F.col(old).alias(new) for new, old in source.items()]),
            self.rows,
            {new: self.widths[old] for new, old in source.items()},
        )


_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def _variable_bytes(field: T.StructField) -> Column | None:
    """Bytes of a value beyond its fixed width; of nested values, those of their text form."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.octet_length(c)
    if isinstance(field.dataType, _NESTED):
        return F.octet_length(F.to_json(F.struct(c)))
    if isinstance(field.dataType, T.DecimalType) and field.dataType.precision > 18:
        return F.lit(16)
    return None


def _totals(df: DataFrame) -> list[Column]:
    """Aggregates for the row count and for the bytes of each column of variable width."""
    variable = [(f.name, b) for f in df.schema.fields if (b := _variable_bytes(f)) is not None]
    return [
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(b.cast("bigint")).alias(f"text_{c}") for c, b in variable],
    ]


def _sized(df: DataFrame, totals: Mapping[str, int | None]) -> Held:
    rows = totals["rows"] or 0
    widths = {c: rows * _FIXED_WIDTH + (totals.get(f"text_{c}") or 0) for c in df.columns}
    return Held(df, rows, widths)


def hold(df: DataFrame, name: str = "held") -> Held:
    """Write `df` to the shared folder and measure it in the same job."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    seen = Observation()
    df.observe(seen, *_totals(df)).write.parquet(path)
    sized = _sized(spark.read.schema(df.schema).parquet(path), seen.get)
    return Held(sized.df, sized.rows, sized.widths, path)


def remove_path(spark: SparkSession, folder: str) -> None:
    """Remove a folder with all its files, in whatever store it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(table: Held) -> None:
    """Remove a held table that nothing will read again."""
    if table.path is not None:
        remove_path(table.df.sparkSession, table.path)


def measure(table: Held | DataFrame) -> Held:
    """`table` with its size, which takes one aggregate unless the size is known already."""
    if isinstance(table, Held):
        return table
    return _sized(table, table.agg(*_totals(table)).first().asDict())


def literal(spark: SparkSession, rows: Sequence[tuple[str, ...]], columns: Sequence[str]) -> Held:
    """Text rows given inline, as a relation inside the plan: nothing is stored or computed."""
    arrow = pa.table({c: pa.array([r[i] for r in rows], pa.string()) for i, c in enumerate(columns)})
    widths = {
        c: sum(_FIXED_WIDTH + len((r[i] or "").encode()) for r in rows) for i, c in enumerate(columns)
    }
    return Held(spark.createDataFrame(arrow), len(rows), widths)

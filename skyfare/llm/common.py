"""What several operators of this folder share."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyfare.operators.lookup import lookup_join
from skyfare.scratch import hold, scratch_path

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; every other character stays."""
    return F.translate(text, _UPPER, _UPPER.lower())


def whole_text(df: DataFrame, column: str = "text") -> Column:
    """The text column, null read as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def held(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read back: a cut in the lineage that survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def located(df: DataFrame) -> tuple[DataFrame, Column]:
    """`df` and the place of each row: (file, row in the file).

    A frame that is no plain read of files is written to the shared folder first, so that every row
    has a place that stays the same however often it is read.
    """
    try:
        place = df.metadataColumn("_metadata")
        df.select(place["file_path"], place["row_index"]).schema  # noqa: B018  analysed here
    except AnalysisException:
        df = held(df, "located")
        place = df.metadataColumn("_metadata")
    return df, F.struct(place["file_path"].alias("file"), place["row_index"].alias("row"))


def place_bits(places: DataFrame) -> DataFrame:
    """(file, stretch, bits): one bit map for each 32,768 consecutive rows of a file that hold a place (file, row).

    Rows are brought together before the maps are made, so no task makes a map of a few rows for every stretch.
    """
    at = F.col("row") + 1
    return (
        places.select("file", F.bitmap_bucket_number(at).alias("stretch"), F.bitmap_bit_position(at).alias("bit"))
        .repartition("file", "stretch")
        .groupBy("file", "stretch")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )


def rows_at(docs: DataFrame, place: Column, places: DataFrame) -> DataFrame:
    """The rows of `docs` whose place is among `places` (file, row), with all their columns.

    `docs` and `place` are as `located` gives them. The rows are read once more and not shuffled: what reaches
    them is one bit a row, 256 MiB for two thousand million rows; only beyond that is it a shuffle.
    """
    maps = hold(place_bits(places), "places")
    inner = [f"_place_{c}" for c in ("file", "stretch", "bit")]
    at = place["row"] + 1
    marked = docs.withColumns(
        dict(zip(inner, (place["file"], F.bitmap_bucket_number(at), F.bitmap_bit_position(at)), strict=True))
    )
    side = maps.select(_place_file="file", _place_stretch="stretch", _place_bits="bits")
    found = lookup_join(
        marked, side, {"_place_file": "_place_file", "_place_stretch": "_place_stretch"}, how="inner", salt_by=["_place_bit"]
    )
    octet = F.expr("cast(conv(hex(substring(_place_bits, int(_place_bit DIV 8) + 1, 1)), 16, 10) AS bigint)")
    return found.where(F.getbit(octet, F.expr("int(_place_bit % 8)")) == 1).select(*[f"`{c}`" for c in docs.columns])


def bounded_sample(df: DataFrame, key: str, most: int) -> DataFrame:
    """At most `most` rows of `df`, taken by a hash of `key`; all rows if there are no more.

    The share to take follows the number of rows, so no task hands on more than its part of it.
    """
    n = df.count()
    if n <= most:
        return df
    share = int(1_000_000 * min(1.0, 1.2 * most / n)) + 1
    mixed = F.pmod(F.xxhash64(df[key], F.lit("sample")), F.lit(1_000_000))
    return df.filter(mixed < share).orderBy(F.xxhash64(key), key).limit(most)

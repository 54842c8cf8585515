"""Station weather text files: preamble lines, one header line, comma-separated rows.

Preamble lines are those with a mark, or, without a mark, all lines before the header.

Files are read as lines, in one scan: the lines are held, and headers, rows and counts are taken from
the held table. Each file's header decides which field is which, so files
with different columns or column orders can be read together. A line is taken for a header when one
of its fields is the name of a weather field, which no data row has as a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyfare.functions.names import scanned_file, station_token
from skyfare.operators.lookup import lookup_join
from skyfare.schemas import WEATHER_FILE_FIELDS
from skyfare.scratch import Held, hold

_HEADER_LINE = r'(^|,)\s*"?(' + "|".join(WEATHER_FILE_FIELDS) + r')"?\s*(,|$)'


MARK = "#"


def lines_of(text: DataFrame) -> DataFrame:
    """Scanned text lines as (file_path, source_file, value, position); position grows along a file."""
    return text.select(
        scanned_file("path").alias("file_path"),
        scanned_file().alias("source_file"),
        "value",
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("line")).alias("position"),
    )


def weather_lines(spark: SparkSession, *paths: str, glob: str = "*.csv") -> DataFrame:
    """Lines of weather files."""
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    return lines_of(reader.text(list(paths)))


def _fields(line: Column, width: int) -> Column:
    columns = [f"c{i}" for i in range(width)]
    parsed = F.from_csv(line, ", ".join(f"{c} string" for c in columns))
    return F.array(*[parsed[c] for c in columns])


def weather_headers(lines: DataFrame, mark: str | None = MARK) -> Held:
    """(file_path, header, header_position) per file: its first line that names a weather field."""
    at = F.col("position") if "position" in lines.columns else F.lit(None)
    found = _unmarked(lines, mark).where(F.col("value").rlike(_HEADER_LINE)).groupBy("file_path")
    first = found.agg(F.min(F.struct(at.alias("position"), "value")).alias("first"))
    return hold(
        first.select("file_path", F.col("first.value").alias("header"), F.col("first.position").alias("header_position")),
        "weather-headers",
    )


def files_without_header(lines: DataFrame, headers: Held) -> DataFrame:
    """(file_path) of files that have lines but no header."""
    return lines.where(F.trim("value") != "").select("file_path").distinct().join(headers.df, "file_path", "left_anti")


def _unmarked(lines: DataFrame, mark: str | None) -> DataFrame:
    lines = lines.where(F.trim("value") != "")
    return lines if mark is None else lines.where(~F.col("value").startswith(mark))


def data_lines(lines: DataFrame, headers: Held, mark: str | None = MARK) -> DataFrame:
    """The lines that are rows, each with its file's header."""
    is_header = F.col("value").rlike(_HEADER_LINE)
    known = lookup_join(_unmarked(lines, mark).where(~is_header), headers, {"file_path": "file_path"}, how="inner")
    return known if mark is not None else known.where(F.col("position") > F.col("header_position"))


def parse_weather_lines(lines: DataFrame, mark: str | None = MARK, headers: Held | None = None) -> DataFrame:
    """Rows of weather files as text columns, with the file name and the station it is named after.

    Fields a file lacks are NULL. A file with a header but no rows gives no rows. With `mark` None all
    lines before a file's header are its preamble, which needs the lines' `position`.
    """
    if headers is None:
        lines = hold(lines, "weather-lines").df
        headers = weather_headers(lines, mark)
    width = headers.df.agg(F.max(F.size(F.split("header", ",")))).first()[0] or 1
    names = F.transform(F.split("header", ","), lambda name: F.trim(F.replace(name, F.lit('"'))))
    known = data_lines(lines, headers, mark)
    rows = (
        known.select("source_file", names.alias("names"), _fields(F.col("value"), width).alias("fields"))
    )

    def field(name: str) -> Column:
        # array_position is 0 for an absent name, and get() of index -1 is NULL
        at = F.array_position("names", F.lit(name)).cast("int") - 1
        return F.get("fields", at).alias(name)

    return rows.select(
        *[field(name) for name in WEATHER_FILE_FIELDS],
        "source_file",
        station_token(F.col("source_file")).alias("file_station"),
    )


def read_weather(spark: SparkSession, *paths: str, glob: str = "*.csv", mark: str | None = MARK) -> DataFrame:
    return parse_weather_lines(weather_lines(spark, *paths, glob=glob), mark)

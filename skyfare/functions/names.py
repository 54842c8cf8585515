"""Parts of a data file's name, `<station>_<first day>_<last day>.<ext>`."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def station_token(file_name: Column) -> Column:
    return F.split(file_name, "_")[0]


def date_token(file_name: Column) -> Column:
    """Second token of the name, NULL when the name has no second token."""
    return F.get(F.split(file_name, "_"), F.lit(1))


def scanned_file(part: str = "name") -> Column:
    """Name (or path) of the file a scanned row comes from, as it is on disk. Spark reports it
    percent-encoded, which would not match a listing for names with spaces and the like."""
    encoded = F.replace(F.col(f"_metadata.file_{part}"), F.lit("+"), F.lit("%2B"))
    return F.url_decode(encoded)

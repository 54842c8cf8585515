"""Small dimensions given inline or by configuration."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import SparkSession

from skyfare.functions.labels import UNKNOWN
from skyfare.schemas import STATIONS
from skyfare.scratch import Held, literal

# The weather station that stands for each borough.
DEFAULT_BOROUGH_STATIONS = (
    ("Queens", "JFK"),
    ("Bronx", "LGA"),
    ("Brooklyn", "JFK"),
    ("Manhattan", "NYC"),
    ("Staten Island", "EWR"),
    ("EWR", "EWR"),
)


def borough_station(
    spark: SparkSession, rows: Iterable[tuple[str, str]] = DEFAULT_BOROUGH_STATIONS
) -> Held:
    return literal(spark, list(rows), ["borough", "station_id"])


def stations_frame(spark: SparkSession, stations: Iterable[Mapping[str, str]]) -> Held:
    """Configured stations; of entries with the same id the first one counts."""
    first: dict[str, Mapping[str, str]] = {}
    for station in stations:
        first.setdefault(station["id"], station)
    rows = [(i, s.get("name", UNKNOWN), s.get("zone", UNKNOWN)) for i, s in first.items()]
    return literal(spark, rows, STATIONS.fieldNames())

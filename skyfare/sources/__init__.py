"""Readers: trip Parquet, weather text files, file listings and small dimensions."""

from skyfare.sources.dimensions import DEFAULT_BOROUGH_STATIONS, borough_station, stations_frame
from skyfare.sources.files import (
    file_stats,
    list_files,
    loaded_files,
    new_files,
    prune_files,
)
from skyfare.sources.trips import available, read_columns, read_trips
from skyfare.sources.weather import parse_weather_lines, read_weather, weather_lines

__all__ = [
    "DEFAULT_BOROUGH_STATIONS",
    "available",
    "borough_station",
    "file_stats",
    "list_files",
    "loaded_files",
    "new_files",
    "parse_weather_lines",
    "prune_files",
    "read_columns",
    "read_trips",
    "read_weather",
    "stations_frame",
    "weather_lines",
]

"""File-source streams that load each new file once."""

from skyfare.streaming.files import stream_trips, stream_weather

__all__ = ["stream_trips", "stream_weather"]

"""Structured Streaming forms of the incremental loads."""

from meridian.streaming.weather_stream import start_weather_stream  # noqa: F401

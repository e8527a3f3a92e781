"""Streams: landings brought into a table as they arrive."""

from varve.streaming.landing import stream_landings

__all__ = ["stream_landings"]

"""Structured Streaming entry points (incremental landing of extract files)."""

from sparesledger.streaming.landing import current_rows, land_incrementally, stream_extract

__all__ = ["current_rows", "land_incrementally", "stream_extract"]

"""Incremental loading with Structured Streaming."""

from tidestrata.streaming.incremental import stream_categories, stream_statistics

__all__ = ["stream_categories", "stream_statistics"]

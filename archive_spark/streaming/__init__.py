"""Streaming ingest of landed pages."""

from .ingest import compact, read_current, stream_segments

__all__ = ["compact", "read_current", "stream_segments"]

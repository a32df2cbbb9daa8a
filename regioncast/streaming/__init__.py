"""Structured Streaming jobs."""

from regioncast.streaming.ingest import ingest_csv_stream

__all__ = ["ingest_csv_stream"]

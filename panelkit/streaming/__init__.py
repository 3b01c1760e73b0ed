"""Streaming ingestion of the feeds."""

from panelkit.streaming.ingest import append_stream, ingest_feed, parse_stream, read_stream

__all__ = ["append_stream", "ingest_feed", "parse_stream", "read_stream"]

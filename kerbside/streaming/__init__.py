"""Incremental bronze landing with Structured Streaming (file source, availableNow)."""
from kerbside.streaming.bronze_ingest import ingest_landed_trips

__all__ = ["ingest_landed_trips"]

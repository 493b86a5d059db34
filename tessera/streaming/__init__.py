"""Incremental ingest of a landing folder into the bronze layer (Structured Streaming)."""

from tessera.streaming.ingest import ingest_landing

__all__ = ["ingest_landing"]

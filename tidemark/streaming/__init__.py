"""Streaming jobs."""

from tidemark.streaming.batches import append_stream
from tidemark.streaming.incremental import incremental_upsert
from tidemark.streaming.ingest import ensure_raw, ingest_raw

__all__ = ["append_stream", "ensure_raw", "incremental_upsert", "ingest_raw"]

"""Incremental ingest with Structured Streaming."""

from .ingest import classify_batch, read_stream, run_ingest, write_classified

__all__ = ["classify_batch", "read_stream", "run_ingest", "write_classified"]

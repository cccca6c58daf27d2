"""Incremental versions of the ingest → clean step (Structured Streaming)."""

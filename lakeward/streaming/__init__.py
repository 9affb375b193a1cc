"""Structured Streaming jobs (incremental landing -> bronze ingest)."""

"""Structured Streaming forms of ingest, deduplication and calendar aggregates."""

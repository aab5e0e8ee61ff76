"""Structured Streaming forms of the readings ingest and its load buckets."""

"""Structured Streaming ingest of record files."""

"""Structured Streaming forms of ingest, dedup and incidents."""

"""Structured Streaming forms of ingest, dedup and tumbling windows."""

"""Scans: snapshot JSON, receiver stats, registry, Parquet levels, listings, text objects."""

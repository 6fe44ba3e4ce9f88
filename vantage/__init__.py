"""vantage: position-snapshot analytics expressed as lazy Spark DataFrame operators.

Subpackages
-----------
sources    scans of snapshot JSON, receiver stats, registry, Parquet levels, listings, text
functions  column expressions (altitude, callsign, week ending, type-code decoding, ...)
operators  reports, enrichment joins, dedup, quality checks, paths, weather
plans      pipeline compositions (hourly / daily / weekly levels, publish / retention plans)
streaming  Structured Streaming ingest, dedup and tumbling windows
"""

__all__ = ["session"]

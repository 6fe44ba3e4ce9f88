"""Catalogue of registered queries: key -> (Spark builder, DuckDB oracle or None).

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the driver's tables
(through the adapters in ``vantage.sources.fixtures``).  Modules named ``keys_*`` register
their entries on import.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn
    return deco


def load_all():
    from vantage.plans import keys_reports  # noqa: F401
    for mod in ("keys_enrich", "keys_levels", "keys_paths", "keys_quality", "keys_weather", "keys_streaming"):
        try:
            __import__(f"vantage.plans.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"vantage.plans.{mod}":
                raise
    return QUERIES, ORACLE

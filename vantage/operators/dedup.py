"""Deduplication (W1) and idempotent keyed append.

Dedup keys always include the epoch, so a hot aircraft is spread over many shuffle
partitions; the row kept for a key is fixed by a total order (no arbitrary pick)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OBS_KEY = ("hex", "observation_epoch")
STATS_KEY = ("end_epoch", "period")


def _order(cols) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in cols]


def dedup(df: DataFrame, keys=OBS_KEY, order=("observation_time", "source_file"), partition=()) -> DataFrame:
    """Keep the first row of every key (``partition`` columns are part of the key, e.g. the
    capture date of a daily level).  ``row_number`` over a hash partitioning of the key."""
    w = Window.partitionBy(*partition, *keys).orderBy(*_order(order))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def append_new(target: DataFrame, batch: DataFrame, keys=OBS_KEY, order=("source_file",),
               target_window: tuple[str, Column] | None = None) -> DataFrame:
    """Rows of ``batch`` to append so that ``target`` gains every new key once (insert or ignore).

    * rows with a NULL key part are rejected (the storage key is NOT NULL);
    * inside the batch the first row per key wins (``order``: load order);
    * keys already in the target are dropped with a left-anti join.
    ``target_window=(col, lower_bound)`` prunes the target before the anti join (e.g. only the
    capture dates the batch can overlap), so the join does not read all history."""
    ok = None
    for k in keys:
        ok = F.col(k).isNotNull() if ok is None else (ok & F.col(k).isNotNull())
    first = dedup(batch.where(ok), keys, order)
    t = target.select(*keys)
    if target_window is not None:
        col, lo = target_window
        t = target.where(F.col(col) >= lo).select(*keys)
    return first.join(t, list(keys), "left_anti")

"""Summaries that merge (A3, A24, A27): approximate distinct aircraft from sketches kept per date.

Distinct counts do not add up over dates, so the exact reports read all rows of a week or a range
again.  ``level_sketches`` folds a level once into one small row a date (rows, time range and a
HyperLogLog sketch of the aircraft); weeks, ranges and totals then merge those rows alone.  The
relative standard error is about 1.04 / sqrt(2^lg_k): 0.8 % at the default of 14.  Exact stays the
default of every report; these are for ranges too large to read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.functions.columns import week_ending
from vantage.sinks import write_level

LG_K = 14


def standard_error(lg_k: int = LG_K) -> float:
    return 1.04 / 2 ** (lg_k / 2)


def level_sketches(level: DataFrame, col: str = "capture_date", lg_k: int = LG_K) -> DataFrame:
    """One row a date: rows, earliest and latest time, and the sketch of its aircraft.  The sketch is
    built map-side; a date's rows are never brought together."""
    return level.groupBy(col).agg(F.count(F.lit(1)).alias("total_records"), F.min("observation_time").alias("earliest"),
                                  F.max("observation_time").alias("latest"), F.hll_sketch_agg("hex", lg_k).alias("aircraft"))


def store_sketches(level: DataFrame, root: str, lg_k: int = LG_K) -> str:
    """Write (or replace) the sketches of the dates of ``level`` beside the levels; run with each
    build of a date."""
    return write_level(level_sketches(level, lg_k=lg_k), root, "sketches")


def read_sketches(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/sketches")


def _merged():
    return [F.sum("total_records").alias("total_records"),
            F.hll_sketch_estimate(F.hll_union_agg("aircraft")).alias("approx_aircraft"),
            F.min("earliest").alias("earliest"), F.max("latest").alias("latest"), F.count(F.lit(1)).alias("dates")]


def weekly_summary(sketches: DataFrame, col: str = "capture_date") -> DataFrame:
    """A3 by merging the dates of each week."""
    return sketches.groupBy(week_ending(col).alias("week_ending")).agg(*_merged())


def range_summary(sketches: DataFrame, first: str | None = None, last: str | None = None, col: str = "capture_date") -> DataFrame:
    """A24 / A27 by merging the dates from ``first`` to ``last`` (both inside; all by default)."""
    kept = sketches
    if first:
        kept = kept.where(F.col(col) >= F.lit(first).cast("date"))
    if last:
        kept = kept.where(F.col(col) <= F.lit(last).cast("date"))
    return kept.agg(*_merged())

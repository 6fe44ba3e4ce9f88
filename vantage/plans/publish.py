"""Publish and retention planning (K6, K7): the plan is a DataFrame; copying or deleting is
left to the caller (``vantage.sinks.publish``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# File-name layout per level: (prefix of object names, 1-based '_' field holding the date).
LEVEL_NAMES = {"hourly": ("hourly/", 3), "daily": ("daily/", 3), "weekly": ("weekly/", 4)}


def file_date(name_col: str, level: str):
    _, part = LEVEL_NAMES[level]
    raw = F.regexp_replace(F.split_part(F.col(name_col), F.lit("_"), F.lit(part)), r"\.parquet$", "")
    return F.try_to_date(raw, "yyyy-MM-dd")


def publish_plan(files: DataFrame, existing: DataFrame, level: str, days_back: int, today: str) -> DataFrame:
    """K6: which local files to upload -- inside the date window ending yesterday (weekly:
    ending the last completed Sunday) and not yet present remotely (left-anti on object name)."""
    prefix, _ = LEVEL_NAMES[level]
    t = F.lit(today).cast("date")
    if level == "weekly":
        end = F.date_sub(t, ((F.dayofweek(t) + 5) % 7 + 1).cast("int"))
        start = F.date_sub(end, 7 * (days_back - 1))
    else:
        end = F.date_sub(t, 1)
        start = F.date_sub(end, days_back - 1)
    f = files.select("name", file_date("name", level).alias("file_date"),
                     F.concat(F.lit(prefix), F.col("name")).alias("object_name"))
    ex = existing.select(F.col("object_name")).distinct().withColumn("exists_remote", F.lit(True))
    j = f.join(ex, "object_name", "left")
    inside = F.col("file_date").between(start, end)
    remote = F.coalesce("exists_remote", F.lit(False))
    action = (F.when(F.col("file_date").isNull(), F.lit("unparsable")).when(~inside, F.lit("outside-window"))
              .when(remote, F.lit("skip-exists")).otherwise(F.lit("upload")))
    return j.select("name", "object_name", "file_date", remote.alias("exists_remote"), action.alias("action"))


def retention_candidates(files: DataFrame, now: str, days: int) -> DataFrame:
    """K7: files whose modification time is older than ``days`` days before ``now``."""
    n = F.lit(now).cast("timestamp_ntz")
    cut = F.timestamp_add("DAY", F.lit(-days), n)
    return (files.where(F.col("mtime") < cut)
            .select("name", "mtime", (F.timestamp_diff("SECOND", F.col("mtime"), n) / F.lit(3600.0)).alias("age_hours")))

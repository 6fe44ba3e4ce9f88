"""Hourly -> daily -> weekly levels (M1-M4, M10-M12) as distributed jobs.

The level data model is one Parquet dataset per level partitioned by ``capture_date``
(plus ``capture_hour`` for hourly).  Capture time and observation time are kept apart: a
file's date is when it was captured, so overlapping captures repeat observations and the
daily level removes them (dedup per capture date on ``(hex, observation_epoch)``).
All dates of a run are handled in one job (grouped by date) instead of one process per date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.functions.columns import week_ending
from vantage.operators import dedup as D
from vantage.operators import reports as R

COMPLETE = ("lat", "lon", "gs", "track")


def with_capture_cols(df: DataFrame, ts: str = "capture_ts") -> DataFrame:
    return df.withColumn("capture_date", F.to_date(ts)).withColumn("capture_hour", F.hour(ts))


def hourly_level(captured: DataFrame) -> DataFrame:
    """M1 rows: completeness filter (F1) + partition columns.  Nothing valid -> no rows."""
    return with_capture_cols(R.complete_only(captured, COMPLETE))


def capture_hourly(captured: DataFrame) -> DataFrame:
    """M1 report: A1 summary of every hourly capture, computed in one grouped pass."""
    h = hourly_level(captured)
    return (h.groupBy("capture_ts")
            .agg(F.count(F.lit(1)).alias("total_records"), F.count_distinct("hex").alias("unique_aircraft"),
                 F.min("observation_time").alias("earliest"), F.max("observation_time").alias("latest")))


def daily_level(hourly: DataFrame, dates=None) -> DataFrame:
    """M2 (W1): DISTINCT ON (hex, observation_epoch) per capture date, first by observation
    time, ring-slot file, capture time.  ``dates`` restricts to those capture dates
    (partition filter on a stored level)."""
    src = hourly if dates is None else hourly.where(F.col("capture_date").isin(list(dates)))
    return D.dedup(src, D.OBS_KEY, ("observation_time", "source_file", "capture_ts"), partition=("capture_date",))


def dedup_counts(hourly: DataFrame, daily: DataFrame) -> DataFrame:
    """A2: rows before / after / removed per capture date, of two stored levels."""
    b = hourly.groupBy("capture_date").agg(F.count(F.lit(1)).alias("rows_before"))
    a = daily.groupBy("capture_date").agg(F.count(F.lit(1)).alias("rows_after"))
    return (b.join(a, "capture_date", "left")
            .select("capture_date", "rows_before", F.coalesce("rows_after", F.lit(0)).alias("rows_after"))
            .withColumn("removed", F.col("rows_before") - F.col("rows_after")))


def dedup_effect(hourly: DataFrame) -> DataFrame:
    """A2 ahead of the build: what deduplication does to each capture date, from one scan (a
    partial count per key, then one per date)."""
    per_key = hourly.groupBy("capture_date", *D.OBS_KEY).agg(F.count(F.lit(1)).alias("n"))
    return (per_key.groupBy("capture_date").agg(F.sum("n").alias("rows_before"), F.count(F.lit(1)).alias("rows_after"))
            .withColumn("removed", F.col("rows_before") - F.col("rows_after")))


def weekly_level(daily: DataFrame, dedup: bool = False) -> DataFrame:
    """M3: daily rows of a Monday-Sunday week (by capture date) under ``week_ending``.
    UNION ALL by default (as published); ``dedup=True`` removes keys repeated across days."""
    w = daily.withColumn("week_ending", week_ending("capture_date"))
    if dedup:
        w = D.dedup(w, D.OBS_KEY, ("observation_time", "source_file", "capture_date"), partition=("week_ending",))
    return w


def weekly_rollup(daily: DataFrame, dedup: bool = False) -> DataFrame:
    """M3 + M12: per week, rows, days (files) used, aircraft, and the duplicate-key warning
    count (keys seen on more than one day), in one pass over the week's rows."""
    w = weekly_level(daily, dedup)
    per_key = w.groupBy("week_ending", "capture_date", *D.OBS_KEY).agg(F.count(F.lit(1)).alias("n"))
    return _week_totals(per_key)


def _week_totals(per_day_key: DataFrame) -> DataFrame:
    """Totals of each week from its rows per (week, day, key).  Aircraft and days are reduced to
    one row per (week, day, hex) and (week, key) first, so nothing counts distinct raw rows."""
    per_key = (per_day_key.groupBy("week_ending", *D.OBS_KEY)
               .agg(F.sum("n").alias("n"), F.bit_or(day_bit("capture_date")).alias("days")))
    per_hex = (per_key.groupBy("week_ending", "hex")
               .agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 1).alias("dups"), F.bit_or("days").alias("days")))
    return (per_hex.groupBy("week_ending")
            .agg(F.sum("n").alias("total_records"), F.bit_count(F.bit_or("days")).cast("long").alias("files_used"),
                 F.count("hex").alias("unique_aircraft"), F.sum("dups").alias("duplicate_keys")))


def day_bit(date: str) -> F.Column:
    """One of seven bits: the days of a week are united and counted without a set of dates."""
    return F.expr(f"shiftleft(1, weekday({date}))")


def week_bounds(df: DataFrame, date_col: str) -> DataFrame:
    """M4: Monday start and Sunday end of the week of every distinct date."""
    d = df.select(F.col(date_col).alias("date")).distinct()
    return d.select("date", F.date_sub(week_ending("date"), 6).alias("week_start"), week_ending("date").alias("week_ending"))


def last_sunday(today) -> F.Column:
    """Last completed Sunday before ``today`` (today Sunday -> previous Sunday)."""
    t = F.lit(today).cast("date") if isinstance(today, str) else today
    return F.date_sub(t, ((F.dayofweek(t) + 5) % 7 + 1).cast("int"))


def week_members(daily: DataFrame) -> DataFrame:
    """For every week present, its 7 dates and whether a daily partition exists."""
    present = daily.select("capture_date").distinct()
    weeks = present.select(week_ending("capture_date").alias("week_ending")).distinct()
    days = weeks.select("week_ending", F.explode(F.sequence(F.date_sub("week_ending", 6), F.col("week_ending")))
                        .alias("capture_date"))
    flagged = days.join(present.withColumn("present", F.lit(True)), "capture_date", "left")
    return flagged.select("week_ending", "capture_date", F.coalesce("present", F.lit(False)).alias("present"))


def backfill_weeks(daily: DataFrame, sundays) -> DataFrame:
    """Weekly rollups for a list of Sundays in one job (partition filter on capture date)."""
    sun = [F.lit(s).cast("date") for s in sundays]
    lo = F.least(*[F.date_sub(s, 6) for s in sun]) if len(sun) > 1 else F.date_sub(sun[0], 6)
    hi = F.greatest(*sun) if len(sun) > 1 else sun[0]
    d = daily.where((F.col("capture_date") >= lo) & (F.col("capture_date") <= hi))
    return weekly_rollup(d).where(F.col("week_ending").isin(*sun))


def regeneration_plan(hourly_files: DataFrame, daily: DataFrame, start: str, end: str, force: bool = False,
                      daily_dates_col: str = "capture_date") -> DataFrame:
    """For every date in [start, end]: number of hourly files, whether the daily
    partition exists, and the action (skip-exists unless force / skip-no-input / regenerate)."""
    spark = hourly_files.sparkSession
    dates = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date"))
    h = (hourly_files.groupBy(F.to_date("capture_ts").alias("date")).agg(F.count(F.lit(1)).alias("hourly_files")))
    d = daily.select(F.col(daily_dates_col).alias("date")).distinct().withColumn("daily_exists", F.lit(True))
    j = dates.join(h, "date", "left").join(d, "date", "left")
    n = F.coalesce("hourly_files", F.lit(0))
    ex = F.coalesce("daily_exists", F.lit(False))
    action = (F.when(ex & F.lit(not force), F.lit("skip-exists"))
              .when(n == 0, F.lit("skip-no-input")).otherwise(F.lit("regenerate")))
    return j.select("date", n.alias("hourly_files"), ex.alias("daily_exists"), action.alias("action"))


def regenerate_daily(hourly: DataFrame, plan: DataFrame) -> DataFrame:
    """M10 second half: one daily job for all dates the plan marks 'regenerate'."""
    todo = plan.where(F.col("action") == "regenerate").select(F.col("date").alias("capture_date"))
    return daily_level(hourly.join(F.broadcast(todo), "capture_date", "left_semi"))

"""Data-quality gates and pipeline health.

The validator of one file ran up to a dozen queries; here all counters come from a single
pass: one aggregate keyed by ``(hex, observation_epoch)`` (needed for duplicate detection)
that also carries every other counter, and one tiny final aggregate over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantage.functions.columns import pct

_N = "n"


def _now(now: str) -> Column:
    return F.lit(now).cast("timestamp_ntz")


def _key_counters(obs: DataFrame, now: str, max_age_days: int, group=()) -> DataFrame:
    t = F.col("observation_time")
    old = F.timestamp_add("DAY", F.lit(-max_age_days), _now(now))
    return (obs.groupBy(*group, "hex", "observation_epoch")
            .agg(F.count(F.lit(1)).alias(_N),
                 F.count_if(F.col("lat").isNotNull() & F.col("lon").isNotNull()).alias("pos"),
                 F.count_if(F.col("alt_baro").isNotNull()).alias("alt"),
                 F.count_if(F.col("alt_baro") == "ground").alias("ground"),
                 F.count_if(t > _now(now)).alias("future"),
                 F.count_if(t < old).alias("old")))


def _totals(per_key: DataFrame, group=()) -> DataFrame:
    return (per_key.groupBy(*group)
            .agg(F.sum(_N).alias("total_records"), F.count_if(F.col(_N) > 1).alias("duplicate_keys"),
                 F.coalesce(F.sum(F.when(F.col("hex").isNull(), F.col(_N))), F.lit(0)).alias("missing_hex"),
                 F.sum("pos").alias("with_position"), F.sum("alt").alias("with_altitude"),
                 F.sum("ground").alias("on_ground"), F.sum("future").alias("future_rows"),
                 F.sum("old").alias("old_rows")))


def _below_half(part: Column, total: Column) -> Column:
    """Is the share of ``part`` under 50 %?  In integers, so no rounding decides; no rows: yes."""
    return F.coalesce((part * 2 < total) | (total == 0), F.lit(True))


def validation_report(obs: DataFrame, now: str, max_age_days: int = 365) -> DataFrame:
    """One row per check -- (check, value, status).  FAIL when duplicate keys > 0,
    NULL hex > 0, position coverage < 50 % or future rows > 0; old rows are INFO only."""
    t = _totals(_key_counters(obs, now, max_age_days))
    pos_pct = F.coalesce(pct(F.col("with_position"), F.col("total_records")), F.lit(0.0))
    low = _below_half(F.col("with_position"), F.col("total_records"))

    def chk(name, value, fail):
        status = F.lit("INFO") if fail is None else F.when(fail, F.lit("FAIL")).otherwise(F.lit("PASS"))
        return F.struct(F.lit(name).alias("check"), value.cast("double").alias("value"), status.alias("status"))

    checks = F.array(
        chk("total_records", F.col("total_records"), None),
        chk("duplicate_keys", F.col("duplicate_keys"), F.col("duplicate_keys") > 0),
        chk("missing_hex", F.col("missing_hex"), F.col("missing_hex") > 0),
        chk("position_coverage_pct", pos_pct, low),
        chk("altitude_coverage_pct", pct(F.col("with_altitude"), F.col("total_records")), None),
        chk("ground_pct", pct(F.col("on_ground"), F.col("total_records")), None),
        chk("future_rows", F.col("future_rows"), F.col("future_rows") > 0),
        chk("old_rows", F.col("old_rows"), None),
    )
    rows = t.select(F.inline(checks))
    fails = F.count_if(F.col("status") == "FAIL")
    overall = rows.agg(F.lit("overall").alias("check"), fails.cast("double").alias("value"),
                       F.when(fails > 0, F.lit("FAIL")).otherwise(F.lit("PASS")).alias("status"))
    return rows.unionByName(overall)


def validation_by_capture(obs: DataFrame, now: str, max_age_days: int = 365, col: str = "capture_date") -> DataFrame:
    """The same gate for every capture date of a level, in one grouped pass."""
    t = _totals(_key_counters(obs, now, max_age_days, (col,)), (col,))
    pos_pct = F.coalesce(pct(F.col("with_position"), F.col("total_records")), F.lit(0.0))
    passed = ~((F.col("duplicate_keys") > 0) | (F.col("missing_hex") > 0) | _below_half(F.col("with_position"), F.col("total_records")) | (F.col("future_rows") > 0))
    return t.select(col, "total_records", "duplicate_keys", "missing_hex", pos_pct.alias("position_pct"),
                    "future_rows", "old_rows", passed.alias("passed"))


def stale_rows(level: DataFrame, overlap_days: int = 1, col: str = "capture_date") -> DataFrame:
    """Rows whose observation date lies before the capture window (capture date - overlap)."""
    d = F.to_date("observation_time")
    stale = d < F.date_sub(F.col(col), overlap_days)
    return (level.groupBy(col)
            .agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(stale).alias("stale_rows"),
                 F.min(F.when(stale, d)).alias("earliest_stale_date"))
            .where(F.col("stale_rows") > 0))


def daily_inventory(daily: DataFrame, rows=(5000, 35000), aircraft=(250, 925), col: str = "capture_date") -> DataFrame:
    """Per day rows and aircraft, 'good' when both fall in the expected ranges."""
    g = daily.groupBy(col).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("hex").alias("aircraft"))
    good = F.col("rows").between(*rows) & F.col("aircraft").between(*aircraft)
    return g.withColumn("verdict", F.when(good, F.lit("good")).otherwise(F.lit("check")))


def missing_slots(present: DataFrame, col: str, start: Column, end: Column, step: str) -> DataFrame:
    """Expected slots (``sequence`` of start..end by ``step``) that are not present."""
    spark = present.sparkSession
    exp = spark.range(1).select(F.explode(F.sequence(start, end, F.expr(f"INTERVAL {step}"))).alias(col))
    return exp.join(present.select(col).distinct(), col, "left_anti")


def missing_hours(files: DataFrame, now: str, hours: int = 48) -> DataFrame:
    """M5: hourly captures missing in the last ``hours`` hours (up to the hour of ``now``)."""
    end = F.date_trunc("hour", _now(now)).cast("timestamp_ntz")
    start = F.timestamp_add("HOUR", F.lit(-(hours - 1)), end)
    return missing_slots(files.select(F.col("capture_ts").alias("hour_ts")), "hour_ts", start, end, "1 HOUR")


def hourly_status(files: DataFrame, hourly: DataFrame, now: str, hours: int = 48) -> DataFrame:
    """M5 summary: expected and found hourly captures of the window, its newest file (name, size,
    modification time) and what that file holds (rows, aircraft; an empty file is listed with 0
    rows).  ``ok`` as the monitor judges: something was found, and the file of the current hour, if
    there is one, is not empty."""
    end = F.date_trunc("hour", _now(now)).cast("timestamp_ntz")
    start = F.timestamp_add("HOUR", F.lit(-(hours - 1)), end)
    seen = files.where((F.col("capture_ts") >= start) & (F.col("capture_ts") <= end))
    g = seen.agg(F.count_distinct("capture_ts").alias("found"), F.max_by(F.struct("capture_ts", "name", "size", "mtime"), "capture_ts").alias("l"))
    held = (hourly.where((F.col("capture_ts") >= start) & (F.col("capture_ts") <= end)).groupBy("capture_ts", "hex").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("capture_ts").agg(F.sum("n").alias("rows"), F.count("hex").alias("aircraft")))
    j = g.withColumn("capture_ts", F.col("l.capture_ts")).join(held, "capture_ts", "left")
    rows = F.when(F.col("capture_ts").isNotNull(), F.coalesce("rows", F.lit(0)))
    empty = F.coalesce((F.col("capture_ts") == end) & (rows == 0), F.lit(False))
    return j.select(F.lit(hours).cast("long").alias("expected"), "found", F.col("l.name").alias("latest_file"),
                    F.col("l.size").alias("latest_size"), F.col("l.mtime").alias("latest_mtime"), rows.alias("latest_rows"),
                    F.when(F.col("capture_ts").isNotNull(), F.coalesce("aircraft", F.lit(0))).alias("latest_aircraft"),
                    ((F.col("found") > 0) & ~empty).alias("ok"))


def missing_days(files: DataFrame, today: str, days: int = 7) -> DataFrame:
    """M6: days without any capture among the ``days`` days ending yesterday."""
    end = F.date_sub(F.lit(today).cast("date"), 1)
    start = F.date_sub(end, days - 1)
    present = files.select(F.to_date("capture_ts").alias("date"))
    return missing_slots(present, "date", start, end, "1 DAY")


def level_counts(level: DataFrame, col: str = "capture_date") -> DataFrame:
    """Rows and aircraft of each file of a level (aircraft are folded to one row per file first)."""
    return (level.groupBy(col, "hex").agg(F.count(F.lit(1)).alias("n"))
            .groupBy(col).agg(F.sum("n").alias("rows"), F.count("hex").alias("aircraft")))


def capture_health(level: DataFrame, files: DataFrame, min_size: int = 512 * 1024, min_rows: int = 1000,
                   col: str = "capture_date") -> DataFrame:
    """Per daily file rows and aircraft beside its own listed size (``files``: ``col`` and
    size); flags for small files and low row counts (thresholds are parameters)."""
    return health_of(level_counts(level, col), files, min_size, min_rows, col)


def health_of(counts: DataFrame, files: DataFrame, min_size: int = 512 * 1024, min_rows: int = 1000,
              col: str = "capture_date") -> DataFrame:
    """``capture_health`` from the ``level_counts`` of a level."""
    j = counts.join(files.select(col, "size"), col, "left")
    size = F.coalesce(F.col("size"), F.lit(0))
    small, low = size < min_size, F.col("rows") < min_rows
    return j.select(col, "rows", "aircraft", size.alias("size_bytes"), small.alias("small_file"), low.alias("low_rows"),
                    (~small & ~low).alias("ok"))


def weekly_health(weekly: DataFrame, files: DataFrame, k: int = 4) -> DataFrame:
    """M7: the latest ``k`` weekly files: size, rows, days present, aircraft.  ``weekly`` has
    week_ending and capture_date; ``files`` lists week_ending and size."""
    newest = files.orderBy(F.desc("week_ending")).limit(k)      # k rows of the listing
    kept = weekly.join(F.broadcast(newest.select("week_ending")), "week_ending", "left_semi")
    per = (kept.groupBy("week_ending", "capture_date", "hex").agg(F.count(F.lit(1)).alias("n"))
           .groupBy("week_ending", "hex").agg(F.sum("n").alias("n"), F.bit_or(F.expr("shiftleft(1, weekday(capture_date))")).alias("days")))
    g = (per.groupBy("week_ending")
         .agg(F.sum("n").alias("total_records"), F.count("hex").alias("unique_aircraft"),
              F.bit_count(F.bit_or("days")).cast("long").alias("files_used")))
    zero = F.lit(0).cast("long")
    return (newest.join(g, "week_ending", "left")
            .select("week_ending", F.col("size").alias("size_bytes"), F.coalesce("total_records", zero).alias("total_records"),
                    F.coalesce("files_used", zero).alias("files_used"), F.coalesce("unique_aircraft", zero).alias("unique_aircraft")))


# Markers of a failed run in a log's tail (fixed values).
LOG_ERROR_MARKERS = ["ERROR", "Error", "Traceback"]


def log_health(logs: DataFrame, text_col: str = "content", tail: int = 5, mtime_col: str | None = None,
               now: str | None = None) -> DataFrame:
    """M8: does any of the last ``tail`` lines of each log contain an error marker, and how many
    hours ago was it written (``mtime_col``, ``now``)?  The log's text is not carried on.

    Lines split like text-mode ``readlines`` (``\\r\\n``, ``\\r`` and ``\\n`` end a line; a final
    newline does not start an empty line).  The whole text is scanned."""
    body = F.regexp_replace(F.col(text_col), r"(\r\n|\r|\n)$", "")
    lines = F.when(F.col(text_col) == "", F.array().cast("array<string>")).otherwise(F.split(body, r"\r\n|\r|\n"))
    pattern = "|".join(LOG_ERROR_MARKERS)
    return (logs.withColumn("_l", lines)
            .withColumn("_t", F.when(F.size("_l") < tail, F.col("_l")).otherwise(F.slice("_l", -tail, tail)))
            .withColumn("n_lines", F.size("_l"))
            .withColumn("has_error", F.exists("_t", lambda x: x.rlike(pattern)))
            .withColumns({"age_hours": F.timestamp_diff("SECOND", F.col(mtime_col), _now(now)) / F.lit(3600.0)}
                         if mtime_col and now else {})
            .drop("_l", "_t", text_col))


def pipeline_status(files: DataFrame, hourly: DataFrame, daily_counts: DataFrame, daily_files: DataFrame,
                    weekly_files: DataFrame, now: str, hours: int = 48, days: int = 7, **health) -> DataFrame:
    """M9: per component what was expected, found and flagged, and ok; one clock for all.
    ``daily_counts``: the ``level_counts`` of the daily level.

    The verdicts are the monitor's: hourly as ``hourly_status``; daily when any file of the last
    ``days`` days exists; weekly when any file exists.  Missing slots and flagged small files are
    counted, but do not fail a component.  'overall' is ok when all components are."""
    today = F.to_date(_now(now))
    h = hourly_status(files, hourly, now, hours).select(
        F.lit("hourly").alias("component"), "expected", "found", (~F.col("ok")).cast("long").alias("flagged"), "ok")
    inside = F.col("capture_date").between(F.date_sub(today, days), F.date_sub(today, 1))
    recent = health_of(daily_counts.where(inside), daily_files.where(inside), **health)
    zero = F.lit(0).cast("long")
    listed = daily_files.where(inside).agg(F.count_distinct("capture_date").alias("found"), F.max(zero).alias("flagged"))
    flagged = recent.agg(zero.alias("found"), F.count_if(~F.col("ok")).alias("flagged"))
    d = (listed.unionByName(flagged).agg(F.sum("found").alias("found"), F.sum("flagged").alias("flagged"))
         .select(F.lit("daily").alias("component"), F.lit(days).cast("long").alias("expected"), "found",
                 F.coalesce("flagged", zero).alias("flagged"), (F.col("found") > 0).alias("ok")))
    w = weekly_files.agg(F.count(F.lit(1)).alias("found")).select(
        F.lit("weekly").alias("component"), F.lit(1).cast("long").alias("expected"), "found",
        F.lit(0).cast("long").alias("flagged"), (F.col("found") > 0).alias("ok"))
    comp = h.unionByName(d).unionByName(w)
    overall = comp.agg(F.lit("overall").alias("component"), F.sum("expected").alias("expected"), F.sum("found").alias("found"),
                       F.sum("flagged").alias("flagged"), F.bool_and("ok").alias("ok"))
    return comp.unionByName(overall)

"""Driver keys for quality gates, pipeline health and publish/retention planning."""

from __future__ import annotations

from pyspark.sql import functions as F

from vantage.functions.columns import week_ending as week_ending_of
from vantage.operators import quality as Q
from vantage.operators import reports as R
from vantage.oracle import sql, week_ending
from vantage.plans import levels as L
from vantage.plans import publish as P
from vantage.plans.catalog import register
from vantage.plans.keys_levels import daily, hourly
from vantage.session import staged
from vantage.sources import fixtures as fx

# Fixed clocks and thresholds of the registered queries.
NOW = "2024-01-25 00:00:00"
MAX_AGE_DAYS = 20
MONITOR_NOW = "2024-01-20 12:30:00"
MONITOR_TODAY = "2024-01-20"
QUIET_TODAY = "2024-02-25"          # a week in which captures stop
PUBLISH_TODAY = "2024-01-20"
UPLOADED_BEFORE = "2024-01-16"
RETENTION_NOW = "2024-01-20 00:00:00"
RETENTION_DAYS = 7


@register("duplicate_keys", sql("""
SELECT COUNT(*) AS duplicate_count FROM (SELECT hex, observation_epoch, COUNT(*) AS cnt FROM hourly
 GROUP BY hex, observation_epoch HAVING COUNT(*) > 1) t""", "hourly"))
def _duplicate_keys(spark, sf):
    return R.duplicate_keys(hourly(spark, sf))


@register("duplicate_examples", sql("""
SELECT hex, observation_epoch, COUNT(*) AS count FROM hourly GROUP BY hex, observation_epoch HAVING COUNT(*) > 1
ORDER BY count DESC, hex, observation_epoch LIMIT 5""", "hourly"))
def _duplicate_examples(spark, sf):
    return R.duplicate_examples(hourly(spark, sf))


KEYED = f"""
k AS (SELECT {{g}} hex, observation_epoch, COUNT(*) AS n,
  COUNT(*) FILTER (WHERE lat IS NOT NULL AND lon IS NOT NULL) AS pos,
  COUNT(*) FILTER (WHERE alt_baro IS NOT NULL) AS alt, COUNT(*) FILTER (WHERE alt_baro = 'ground') AS ground,
  COUNT(*) FILTER (WHERE observation_time > TIMESTAMP '{NOW}') AS future,
  COUNT(*) FILTER (WHERE observation_time < TIMESTAMP '{NOW}' - INTERVAL '{MAX_AGE_DAYS}' DAY) AS old
 FROM hourly GROUP BY ALL),
t AS (SELECT {{g}} CAST(SUM(n) AS BIGINT) AS total_records, COUNT(*) FILTER (WHERE n > 1) AS duplicate_keys,
  CAST(COALESCE(SUM(CASE WHEN hex IS NULL THEN n END), 0) AS BIGINT) AS missing_hex,
  CAST(SUM(pos) AS BIGINT) AS with_position, CAST(SUM(alt) AS BIGINT) AS with_altitude,
  CAST(SUM(ground) AS BIGINT) AS on_ground, CAST(SUM(future) AS BIGINT) AS future_rows, CAST(SUM(old) AS BIGINT) AS old_rows
 FROM k GROUP BY ALL)"""
LOW = "COALESCE(100.0::DOUBLE * with_position / NULLIF(total_records, 0), 0.0) < 50"
PCT = "COALESCE(ROUND(100.0::DOUBLE * {a} / NULLIF({b}, 0), 2), 0.0)"


@register("validation_report", sql("WITH " + KEYED.format(g="") + f""",
c AS (
 SELECT 'total_records' AS "check", CAST(total_records AS DOUBLE) AS value, 'INFO' AS status FROM t
 UNION ALL SELECT 'duplicate_keys', duplicate_keys, CASE WHEN duplicate_keys > 0 THEN 'FAIL' ELSE 'PASS' END FROM t
 UNION ALL SELECT 'missing_hex', missing_hex, CASE WHEN missing_hex > 0 THEN 'FAIL' ELSE 'PASS' END FROM t
 UNION ALL SELECT 'position_coverage_pct', {PCT.format(a='with_position', b='total_records')},
   CASE WHEN {LOW} THEN 'FAIL' ELSE 'PASS' END FROM t
 UNION ALL SELECT 'altitude_coverage_pct', ROUND(100.0::DOUBLE * with_altitude / NULLIF(total_records, 0), 2), 'INFO' FROM t
 UNION ALL SELECT 'ground_pct', ROUND(100.0::DOUBLE * on_ground / NULLIF(total_records, 0), 2), 'INFO' FROM t
 UNION ALL SELECT 'future_rows', future_rows, CASE WHEN future_rows > 0 THEN 'FAIL' ELSE 'PASS' END FROM t
 UNION ALL SELECT 'old_rows', old_rows, 'INFO' FROM t)
SELECT * FROM c UNION ALL
SELECT 'overall', CAST(COUNT(*) FILTER (WHERE status = 'FAIL') AS DOUBLE),
 CASE WHEN COUNT(*) FILTER (WHERE status = 'FAIL') > 0 THEN 'FAIL' ELSE 'PASS' END FROM c""", "hourly"))
def _validation_report(spark, sf):
    return Q.validation_report(hourly(spark, sf), NOW, MAX_AGE_DAYS)


@register("validation_by_capture", sql("WITH " + KEYED.format(g="capture_date,") + f"""
SELECT capture_date, total_records, duplicate_keys, missing_hex, {PCT.format(a='with_position', b='total_records')} AS position_pct,
 future_rows, old_rows,
 NOT (duplicate_keys > 0 OR missing_hex > 0 OR {LOW} OR future_rows > 0) AS passed
FROM t""", "hourly"))
def _validation_by_capture(spark, sf):
    return Q.validation_by_capture(hourly(spark, sf), NOW, MAX_AGE_DAYS)


@register("stale_rows", sql("""
SELECT capture_date, COUNT(*) AS total_rows,
 COUNT(*) FILTER (WHERE CAST(observation_time AS DATE) < capture_date - 1) AS stale_rows,
 MIN(CASE WHEN CAST(observation_time AS DATE) < capture_date - 1 THEN CAST(observation_time AS DATE) END) AS earliest_stale_date
FROM daily GROUP BY capture_date
HAVING COUNT(*) FILTER (WHERE CAST(observation_time AS DATE) < capture_date - 1) > 0""", "daily"))
def _stale_rows(spark, sf):
    return Q.stale_rows(daily(spark, sf), 1)


@register("daily_inventory", sql("""
SELECT capture_date, COUNT(*) AS rows, COUNT(DISTINCT hex) AS aircraft,
 CASE WHEN COUNT(*) BETWEEN 5000 AND 35000 AND COUNT(DISTINCT hex) BETWEEN 250 AND 925 THEN 'good' ELSE 'check' END AS verdict
FROM daily GROUP BY capture_date""", "daily"))
def _daily_inventory(spark, sf):
    return Q.daily_inventory(daily(spark, sf))


DAILY_FILES = "df AS (SELECT capture_date, COUNT(*) * 41 AS size FROM daily GROUP BY capture_date)"
HEALTH = """
held AS (SELECT capture_date, COUNT(*) AS rows, COUNT(DISTINCT hex) AS aircraft FROM daily GROUP BY capture_date),
health AS (SELECT capture_date, rows, aircraft, size AS size_bytes, size < 512 * 1024 AS small_file, rows < 1000 AS low_rows,
 size >= 512 * 1024 AND rows >= 1000 AS ok FROM held JOIN df USING (capture_date))"""


@register("capture_health", sql("WITH " + DAILY_FILES + "," + HEALTH + " SELECT * FROM health", "daily"))
def _capture_health(spark, sf):
    d = daily(spark, sf)
    return Q.capture_health(d, fx.level_files(d, "capture_date"))


MISSING_HOURS = f"""
mh AS (SELECT * FROM (SELECT CAST(unnest(generate_series(date_trunc('hour', TIMESTAMP '{MONITOR_NOW}') - INTERVAL 47 HOUR,
   date_trunc('hour', TIMESTAMP '{MONITOR_NOW}'), INTERVAL 1 HOUR)) AS TIMESTAMP) AS hour_ts) e
 WHERE hour_ts NOT IN (SELECT capture_ts FROM files_with_gaps))"""
MISSING_DAYS = f"""
md AS (SELECT * FROM (SELECT CAST(unnest(generate_series(DATE '{QUIET_TODAY}' - 7, DATE '{QUIET_TODAY}' - 1, INTERVAL 1 DAY)) AS DATE) AS date) e
 WHERE date NOT IN (SELECT CAST(capture_ts AS DATE) FROM files_with_gaps))"""


@register("missing_hours", sql("WITH " + MISSING_HOURS + " SELECT * FROM mh", "files_with_gaps"))
def _missing_hours(spark, sf):
    return Q.missing_hours(fx.files_with_gaps(spark, sf), MONITOR_NOW, 48)


STATUS = f"""
seen AS (SELECT * FROM files_with_gaps WHERE capture_ts BETWEEN date_trunc('hour', TIMESTAMP '{MONITOR_NOW}') - INTERVAL 47 HOUR
   AND date_trunc('hour', TIMESTAMP '{MONITOR_NOW}')),
newest AS (SELECT COUNT(DISTINCT capture_ts) AS found, arg_max(name, capture_ts) AS latest_file, arg_max(size, capture_ts) AS latest_size,
  arg_max(mtime, capture_ts) AS latest_mtime, MAX(capture_ts) AS last_ts FROM seen),
status AS (SELECT CAST(48 AS BIGINT) AS expected, found, latest_file, latest_size, latest_mtime,
  CASE WHEN last_ts IS NOT NULL THEN (SELECT COUNT(*) FROM hourly WHERE capture_ts = last_ts) END AS latest_rows,
  CASE WHEN last_ts IS NOT NULL THEN (SELECT COUNT(DISTINCT hex) FROM hourly WHERE capture_ts = last_ts) END AS latest_aircraft,
  found > 0 AND NOT COALESCE(last_ts = date_trunc('hour', TIMESTAMP '{MONITOR_NOW}')
    AND (SELECT COUNT(*) FROM hourly WHERE capture_ts = last_ts) = 0, FALSE) AS ok FROM newest)"""


@register("hourly_status", sql("WITH " + STATUS + " SELECT * FROM status", "files_with_gaps", "hourly"))
def _hourly_status(spark, sf):
    return Q.hourly_status(fx.files_with_gaps(spark, sf), hourly(spark, sf), MONITOR_NOW, 48)


@register("missing_days", sql("WITH " + MISSING_DAYS + " SELECT * FROM md", "files_with_gaps"))
def _missing_days(spark, sf):
    return Q.missing_days(fx.files_with_gaps(spark, sf), QUIET_TODAY, 7)


WEEKLY_HEALTH = f"""
wk AS (SELECT {week_ending('capture_date')} AS week_ending, * FROM daily),
wh AS (SELECT week_ending, COUNT(*) * 41 AS size_bytes, COUNT(*) AS total_records, COUNT(DISTINCT capture_date) AS files_used,
 COUNT(DISTINCT hex) AS unique_aircraft FROM wk GROUP BY week_ending ORDER BY week_ending DESC LIMIT 4)"""


@register("weekly_health", sql("WITH " + WEEKLY_HEALTH + " SELECT * FROM wh", "daily"))
def _weekly_health(spark, sf):
    w = L.weekly_level(daily(spark, sf))
    return Q.weekly_health(w, fx.level_files(w, "week_ending"), 4)


RECENT = f"capture_date BETWEEN DATE '{MONITOR_TODAY}' - 7 AND DATE '{MONITOR_TODAY}' - 1"


@register("pipeline_status", sql("WITH " + STATUS + "," + DAILY_FILES + "," + HEALTH + f""",
parts AS (
 SELECT 'hourly' AS component, expected, found, CAST(NOT ok AS BIGINT) AS flagged, ok FROM status
 UNION ALL SELECT 'daily', 7, (SELECT COUNT(*) FROM df WHERE {RECENT}), (SELECT COUNT(*) FROM health WHERE {RECENT} AND NOT ok),
  (SELECT COUNT(*) FROM df WHERE {RECENT}) > 0
 UNION ALL SELECT 'weekly', 1, (SELECT COUNT(DISTINCT {week_ending('capture_date')}) FROM daily), 0, (SELECT COUNT(*) FROM daily) > 0)
SELECT * FROM parts
UNION ALL SELECT 'overall', CAST(SUM(expected) AS BIGINT), CAST(SUM(found) AS BIGINT), CAST(SUM(flagged) AS BIGINT), bool_and(ok) FROM parts""",
                                 "daily", "files_with_gaps"))
def _pipeline_status(spark, sf):
    # the daily level is folded once, to one row a date, from which both listings follow
    counts = staged(Q.level_counts(daily(spark, sf)), "daily-counts")
    sizes = counts.select("capture_date", (F.col("rows") * 41).alias("size"))
    weeks = sizes.groupBy(week_ending_of("capture_date").alias("week_ending")).agg(F.sum("size").alias("size"))
    return Q.pipeline_status(fx.files_with_gaps(spark, sf), hourly(spark, sf), counts, sizes, weeks, MONITOR_NOW)


LOG_NOW = "2024-03-01 00:00:00"


@register("log_health", sql(f"""
WITH l AS (SELECT doc_id, text, CASE WHEN text = '' THEN []::VARCHAR[]
  ELSE regexp_split_to_array(regexp_replace(text, '(\\r\\n|\\r|\\n)$', ''), '\\r\\n|\\r|\\n') END AS lines FROM documents)
SELECT doc_id, CAST(len(lines) AS INTEGER) AS n_lines,
 len(list_filter(CASE WHEN len(lines) < 5 THEN lines ELSE lines[-5:] END, lambda x: regexp_matches(x, 'ERROR|Error|Traceback'))) > 0 AS has_error,
 date_diff('second', TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id % 50000), TIMESTAMP '{LOG_NOW}') / 3600.0::DOUBLE AS age_hours
FROM l"""))
def _log_health(spark, sf):
    written = F.timestamp_add("MINUTE", F.col("doc_id") % 50000, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    logs = fx.table(spark, sf, "documents").select("doc_id", F.col("text").alias("content"), written.alias("mtime"))
    return Q.log_health(logs, "content", 5, "mtime", LOG_NOW).drop("mtime")


@register("publish_plan", sql(f"""
WITH f AS (SELECT name, TRY_CAST(regexp_replace(split_part(name, '_', 3), '\\.parquet$', '') AS DATE) AS file_date,
  'hourly/' || name AS object_name FROM files),
ex AS (SELECT DISTINCT 'hourly/' || name AS object_name FROM files WHERE capture_ts < TIMESTAMP '{UPLOADED_BEFORE} 00:00:00')
SELECT name, f.object_name, file_date, ex.object_name IS NOT NULL AS exists_remote,
 CASE WHEN file_date IS NULL THEN 'unparsable'
  WHEN NOT (file_date BETWEEN DATE '{PUBLISH_TODAY}' - 7 AND DATE '{PUBLISH_TODAY}' - 1) THEN 'outside-window'
  WHEN ex.object_name IS NOT NULL THEN 'skip-exists' ELSE 'upload' END AS action
FROM f LEFT JOIN ex ON f.object_name = ex.object_name""", "files"))
def _publish_plan(spark, sf):
    f = fx.files(spark, sf)
    existing = (f.where(F.col("capture_ts") < F.lit(UPLOADED_BEFORE).cast("timestamp_ntz"))
                .select(F.concat(F.lit("hourly/"), F.col("name")).alias("object_name")))
    return P.publish_plan(f, existing, "hourly", 7, PUBLISH_TODAY)


@register("retention_candidates", sql(f"""
SELECT name, mtime, date_diff('second', mtime, TIMESTAMP '{RETENTION_NOW}') / 3600.0 AS age_hours FROM files
WHERE mtime < TIMESTAMP '{RETENTION_NOW}' - INTERVAL '{RETENTION_DAYS}' DAY""", "files"))
def _retention_candidates(spark, sf):
    return P.retention_candidates(fx.files(spark, sf), RETENTION_NOW, RETENTION_DAYS)

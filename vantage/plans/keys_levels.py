"""Driver keys for sources, levels, dedup and keyed append."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from vantage.functions.columns import alt_ft, on_ground
from vantage.operators import dedup as D
from vantage.operators import keyed as K
from vantage.operators import reports as R
from vantage.operators import sketches as SK
from vantage.oracle import ALT_FT, WS, sql, week_ending
from vantage import sinks
from vantage.plans import levels as L
from vantage.plans.catalog import register
from vantage.schemas import OBSERVATION
from vantage.session import shared_dir, unique_name
from vantage.sources import fixtures as fx
from vantage.sources import levels as S
from vantage.sources import snapshots as SN
from vantage.sources import stats as ST

# Fixed parameters of the registered queries.
SUNDAYS = ["2024-01-07", "2024-01-14", "2024-01-21", "2024-01-28"]
MONTH = ("2024-01-01", "2024-01-31")
REGEN = ("2024-01-10", "2024-01-20")
DAILY_BUILT_BEFORE = "2024-01-15"
LATEST_N = 7


def hourly(spark, sf):
    return L.hourly_level(fx.captures(spark, sf))


def daily(spark, sf):
    return L.daily_level(hourly(spark, sf))


@register("capture_hourly", sql("""
SELECT capture_ts, COUNT(*) AS total_records, COUNT(DISTINCT hex) AS unique_aircraft,
 MIN(observation_time) AS earliest, MAX(observation_time) AS latest FROM hourly GROUP BY capture_ts""", "hourly"))
def _capture_hourly(spark, sf):
    return L.capture_hourly(fx.captures(spark, sf))


@register("daily_dedup", sql("SELECT * FROM daily", "daily"))
def _daily_dedup(spark, sf):
    return daily(spark, sf)


@register("dedup_counts", sql("""
WITH b AS (SELECT capture_date, COUNT(*) AS rows_before FROM hourly GROUP BY 1),
a AS (SELECT capture_date, COUNT(*) AS rows_after FROM daily GROUP BY 1)
SELECT b.capture_date, rows_before, COALESCE(rows_after, 0) AS rows_after, rows_before - COALESCE(rows_after, 0) AS removed
FROM b LEFT JOIN a USING (capture_date)""", "daily"))
def _dedup_counts(spark, sf):
    return L.dedup_effect(hourly(spark, sf))


SUMMARY = """SELECT {k}, COUNT(*) AS total_records, COUNT(DISTINCT hex) AS unique_aircraft, MIN(observation_time) AS earliest,
 MAX(observation_time) AS latest, COUNT(DISTINCT source_file) AS source_files FROM {src} GROUP BY {k}"""


@register("daily_summary_stats", sql(SUMMARY.format(k="capture_date", src="daily"), "daily"))
def _daily_summary_stats(spark, sf):
    return R.summary_by(daily(spark, sf), "capture_date")


WEEKLY = f"SELECT *, {week_ending('capture_date')} AS week_ending FROM daily"


@register("weekly_summary", sql(SUMMARY.format(k="week_ending", src="weekly"), "daily", extra=[("weekly", WEEKLY)]))
def _weekly_summary(spark, sf):
    return R.summary_by(L.weekly_level(daily(spark, sf)), "week_ending")


@register("weekly_file_info", sql("""
SELECT week_ending, COUNT(*) AS total_observations, COUNT(DISTINCT hex) AS unique_aircraft,
 MIN(observation_time) AS earliest, MAX(observation_time) AS latest FROM weekly GROUP BY week_ending""",
                                  "daily", extra=[("weekly", WEEKLY)]))
def _weekly_file_info(spark, sf):
    w = L.weekly_level(daily(spark, sf))
    return w.groupBy("week_ending").agg(F.count(F.lit(1)).alias("total_observations"),
                                        F.count_distinct("hex").alias("unique_aircraft"),
                                        F.min("observation_time").alias("earliest"),
                                        F.max("observation_time").alias("latest"))


ROLLUP = """
WITH k AS (SELECT week_ending, hex, observation_epoch, COUNT(*) AS n FROM weekly GROUP BY ALL),
d AS (SELECT week_ending, COUNT(*) FILTER (WHERE n > 1) AS duplicate_keys FROM k GROUP BY ALL),
g AS (SELECT week_ending, COUNT(*) AS total_records, COUNT(DISTINCT capture_date) AS files_used,
      COUNT(DISTINCT hex) AS unique_aircraft FROM weekly GROUP BY ALL)
SELECT g.*, d.duplicate_keys FROM g LEFT JOIN d USING (week_ending)"""


@register("weekly_rollup", sql(ROLLUP, "daily", extra=[("weekly", WEEKLY)]))
def _weekly_rollup(spark, sf):
    return L.weekly_rollup(daily(spark, sf))


@register("backfill_weeks", sql(ROLLUP + " WHERE g.week_ending IN (" + ", ".join(f"DATE '{s}'" for s in SUNDAYS) + ")",
                                "daily", extra=[("weekly", WEEKLY)]))
def _backfill_weeks(spark, sf):
    return L.backfill_weeks(daily(spark, sf), SUNDAYS)


@register("week_bounds", sql(f"""
SELECT DISTINCT CAST(observation_time AS DATE) AS date,
 {week_ending('observation_time')} - 6 AS week_start, {week_ending('observation_time')} AS week_ending FROM obs""", "obs"))
def _week_bounds(spark, sf):
    o = fx.obs(spark, sf).withColumn("d", F.to_date("observation_time"))
    return L.week_bounds(o, "d")


@register("week_members", sql(f"""
WITH p AS (SELECT DISTINCT capture_date FROM daily),
w AS (SELECT DISTINCT {week_ending('capture_date')} AS week_ending FROM p),
days AS (SELECT week_ending, CAST(unnest(generate_series(week_ending - 6, week_ending, INTERVAL 1 DAY)) AS DATE) AS capture_date FROM w)
SELECT week_ending, days.capture_date, p.capture_date IS NOT NULL AS present
FROM days LEFT JOIN p ON days.capture_date = p.capture_date""", "daily"))
def _week_members(spark, sf):
    return L.week_members(hourly(spark, sf))     # deduplication removes no date


REGEN_SQL = f"""
WITH dates AS (SELECT CAST(unnest(generate_series(DATE '{REGEN[0]}', DATE '{REGEN[1]}', INTERVAL 1 DAY)) AS DATE) AS date),
h AS (SELECT CAST(capture_ts AS DATE) AS date, COUNT(*) AS hourly_files FROM files GROUP BY 1),
d AS (SELECT DISTINCT capture_date AS date FROM daily WHERE capture_date < DATE '{DAILY_BUILT_BEFORE}'),
plan AS (SELECT dates.date, COALESCE(h.hourly_files, 0) AS hourly_files, d.date IS NOT NULL AS daily_exists,
 CASE WHEN d.date IS NOT NULL THEN 'skip-exists' WHEN COALESCE(h.hourly_files, 0) = 0 THEN 'skip-no-input' ELSE 'regenerate' END AS action
 FROM dates LEFT JOIN h ON dates.date = h.date LEFT JOIN d ON dates.date = d.date)
"""


@register("regeneration_plan", sql(REGEN_SQL + "SELECT * FROM plan", "daily", "files"))
def _regeneration_plan(spark, sf):
    built = hourly(spark, sf).where(F.col("capture_date") < F.lit(DAILY_BUILT_BEFORE).cast("date"))
    return L.regeneration_plan(fx.files(spark, sf), built, *REGEN)


@register("regenerate_daily", sql(REGEN_SQL + """
SELECT * FROM daily WHERE capture_date IN (SELECT date FROM plan WHERE action = 'regenerate')""", "daily", "files"))
def _regenerate_daily(spark, sf):
    built = hourly(spark, sf).where(F.col("capture_date") < F.lit(DAILY_BUILT_BEFORE).cast("date"))
    plan = L.regeneration_plan(fx.files(spark, sf), built, *REGEN)
    return L.regenerate_daily(hourly(spark, sf), plan)


FILE_INFO = """SELECT COUNT(*) AS total_records, COUNT(DISTINCT hex) AS unique_aircraft, COUNT(DISTINCT flight) AS unique_flights,
 MIN(observation_time) AS earliest, MAX(observation_time) AS latest FROM daily
 WHERE capture_date IN (SELECT DISTINCT capture_date FROM daily ORDER BY capture_date DESC LIMIT {n})"""


def _latest(spark, sf, n):
    """Deduplication removes no date, so the hourly level names the latest dates and only their rows
    are deduplicated."""
    return L.daily_level(S.latest_captures(hourly(spark, sf), n))


@register("file_info", sql(FILE_INFO.format(n=1), "daily"))
def _file_info(spark, sf):
    return R.file_info(_latest(spark, sf, 1))


@register("overall_stats", sql(FILE_INFO.format(n=LATEST_N), "daily"))
def _overall_stats(spark, sf):
    return R.file_info(_latest(spark, sf, LATEST_N))


@register("latest_n_days", sql(f"""
SELECT capture_date, COUNT(*) AS rows, COUNT(DISTINCT hex) AS unique_aircraft FROM daily
WHERE capture_date IN (SELECT DISTINCT capture_date FROM daily ORDER BY capture_date DESC LIMIT {LATEST_N})
GROUP BY capture_date""", "daily"))
def _latest_n_days(spark, sf):
    d = _latest(spark, sf, LATEST_N)
    return d.groupBy("capture_date").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("hex").alias("unique_aircraft"))


@register("month_range", sql(f"""
SELECT COUNT(*) AS total_observations, COUNT(DISTINCT hex) AS unique_aircraft,
 MIN(CAST(observation_time AS DATE)) AS first_date, MAX(CAST(observation_time AS DATE)) AS last_date
FROM daily WHERE capture_date BETWEEN DATE '{MONTH[0]}' AND DATE '{MONTH[1]}'""", "daily"))
def _month_range(spark, sf):
    d = daily(spark, sf).where(F.col("capture_date").between(F.lit(MONTH[0]).cast("date"), F.lit(MONTH[1]).cast("date")))
    return R.range_summary(d)


@register("union_by_name", sql(f"""
WITH a AS (SELECT * EXCLUDE (category, alt_baro), TRY_CAST(alt_baro AS DOUBLE) AS alt_baro FROM obs
           WHERE alt_baro IS NOT NULL AND alt_baro <> 'ground' AND event_id % 2 = 0),
b AS (SELECT * FROM obs WHERE NOT (alt_baro IS NOT NULL AND alt_baro <> 'ground' AND event_id % 2 = 0)),
u AS (SELECT * FROM a UNION ALL BY NAME SELECT * FROM b)
SELECT event_id, hex, observation_epoch, category, {ALT_FT} AS alt_ft, alt_baro = 'ground' AS on_ground FROM u""", "obs"))
def _union_by_name(spark, sf):
    o = fx.obs(spark, sf)
    numeric = F.col("alt_baro").isNotNull() & (F.col("alt_baro") != "ground") & (F.col("event_id") % 2 == 0)
    a = o.where(numeric).withColumn("alt_baro", F.col("alt_baro").try_cast("double")).drop("category")
    b = o.where(~numeric)
    u = S.union_by_name([a, b], OBSERVATION)
    return u.select("event_id", "hex", "observation_epoch", "category", alt_ft().alias("alt_ft"),
                    on_ground().alias("on_ground"))


_GIVEN = ("lat", "lon", "alt_baro", "gs", "track", "category", "rssi", "messages")
_BARE = {"rssi": "rssi", "alt_baro": "'ground'"}


@register("snapshot_flatten", sql(f"""
SELECT observation_time, observation_epoch, hex, CASE WHEN flight = '' THEN NULL ELSE trim(flight, {WS}) END AS flight,
 {", ".join(_GIVEN)}, {", ".join(f"{x} AS {n}" for n, x in fx.SNAPSHOT_FIELDS.items())},
 CASE event_id % 3 WHEN 0 THEN 'autopilot,vnav' WHEN 1 THEN 'tcas' END AS nav_modes, source_file FROM obs
UNION ALL SELECT observation_time, observation_epoch, '~' || hex, '',
 {", ".join(_BARE.get(n, "NULL") for n in (*_GIVEN, *fx.SNAPSHOT_FIELDS))}, NULL, source_file FROM obs""", "obs"))
def _snapshot_flatten(spark, sf):
    return SN.flatten(SN.parse_snapshot_text(fx.snapshot_docs(spark, sf), "doc", "source_file"))


def _stats_sql_periods(src: str, file_expr: str) -> str:
    from vantage.schemas import STATS_PERIODS
    parts = [f"SELECT {file_expr} AS source_file, '{p}' AS period, json_extract(doc, '$.{p}') AS v FROM {src}"
             for p in STATS_PERIODS]
    return "\nUNION ALL ".join(parts)


STATS_COLS = """
 make_timestamp(CAST(round(CAST(v->>'end' AS DOUBLE) * 1000000) AS BIGINT)) AS observation_time,
 CAST(v->>'end' AS DOUBLE) AS end_epoch, period, CAST(v->>'start' AS DOUBLE) AS start_epoch,
 CAST(json_extract_string(v, '$.local.samples_processed') AS BIGINT) AS samples_processed,
 CAST(json_extract_string(v, '$.local.samples_dropped') AS BIGINT) AS samples_dropped,
 CAST(json_extract_string(v, '$.local.modes') AS BIGINT) AS modes,
 CAST(json_extract_string(v, '$.local.bad') AS BIGINT) AS bad,
 CAST(json_extract_string(v, '$.local.unknown_icao') AS BIGINT) AS unknown_icao,
 CAST(json_extract_string(v, '$.local.accepted[0]') AS BIGINT) AS accepted_0,
 CAST(json_extract_string(v, '$.local.accepted[1]') AS BIGINT) AS accepted_1,
 CAST(json_extract_string(v, '$.local.signal') AS DOUBLE) AS signal,
 CAST(json_extract_string(v, '$.local.noise') AS DOUBLE) AS noise,
 CAST(json_extract_string(v, '$.local.peak_signal') AS DOUBLE) AS peak_signal,
 CAST(json_extract_string(v, '$.local.strong_signals') AS INTEGER) AS strong_signals,
 CAST(json_extract_string(v, '$.local.gain_db') AS DOUBLE) AS gain_db,
 CAST(json_extract_string(v, '$.messages') AS BIGINT) AS messages,
 CAST(json_extract_string(v, '$.tracks.all') AS BIGINT) AS tracks_all,
 CAST(json_extract_string(v, '$.tracks.single_message') AS BIGINT) AS tracks_single_message,
 CAST(json_extract_string(v, '$.tracks.unreliable') AS BIGINT) AS tracks_unreliable, source_file"""


def _stats(spark, sf, delivery="a"):
    d = fx.stats_docs(spark, sf).withColumn(
        "source_file", F.concat(F.lit(f"{delivery}/stats_"), F.col("s_suppkey").cast("string"), F.lit(".json")))
    return ST.parse_stats_text(d, "doc", "source_file")


STATS_A = _stats_sql_periods("stats_docs", "'a/stats_' || CAST(s_suppkey AS VARCHAR) || '.json'")
STATS_B = _stats_sql_periods("stats_docs", "'b/stats_' || CAST(s_suppkey AS VARCHAR) || '.json'")


@register("receiver_stats_unpivot", sql(f"SELECT {STATS_COLS} FROM p WHERE v IS NOT NULL", "stats_docs",
                                         extra=[("p", STATS_A)]))
def _receiver_stats_unpivot(spark, sf):
    return _stats(spark, sf, "a")


@register("keyed_append_stats", sql(f"""
WITH batch AS (SELECT {STATS_COLS} FROM p WHERE v IS NOT NULL),
target AS (SELECT * FROM batch WHERE period = 'latest' AND source_file LIKE 'a/%'),
first AS (SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY end_epoch, period ORDER BY source_file) AS rn
          FROM batch WHERE end_epoch IS NOT NULL AND period IS NOT NULL) WHERE rn = 1)
SELECT * FROM first f WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.end_epoch = f.end_epoch AND t.period = f.period)""",
                                     "stats_docs", extra=[("p", STATS_A + "\nUNION ALL " + STATS_B)]))
def _keyed_append_stats(spark, sf):
    a = _stats(spark, sf, "a")
    batch = a.unionByName(_stats(spark, sf, "b"))
    target = a.where(F.col("period") == "latest")
    return _stored(spark, target, "stats", D.STATS_KEY, "end_epoch").new_rows(batch, ("source_file",))


def _stored(spark, rows, name, keys, epoch):
    """A keyed table of this query run that holds ``rows``."""
    store = K.KeyedStore(spark, shared_dir(spark, unique_name(f"keyed-{name}")), rows.schema, keys, epoch)
    store.append(rows)
    return store


@register("keyed_append", sql("""
WITH b AS (SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY hex, observation_epoch
           ORDER BY source_file, capture_ts) AS rn FROM captures WHERE hex IS NOT NULL AND observation_epoch IS NOT NULL) WHERE rn = 1),
t AS (SELECT hex, observation_epoch FROM obs WHERE lat IS NOT NULL AND lon IS NOT NULL AND gs IS NOT NULL AND track IS NOT NULL)
SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.hex = b.hex AND t.observation_epoch = b.observation_epoch)""",
                              "captures"))
def _keyed_append(spark, sf):
    target = R.complete_only(fx.obs(spark, sf))
    store = _stored(spark, target, "observations", D.OBS_KEY, "observation_epoch")
    return store.new_rows(fx.captures(spark, sf), ("source_file", "capture_ts"))


@register("keyed_append_rejects", sql("""
SELECT missing_part, COUNT(*) AS rows FROM (SELECT CASE WHEN event_id % 53 = 0 THEN 'hex'
 WHEN event_id % 59 = 0 THEN 'observation_epoch' END AS missing_part FROM captures) WHERE missing_part IS NOT NULL GROUP BY 1""", "captures"))
def _keyed_append_rejects(spark, sf):
    """Captures of which some lost a part of their key on the way, counted as the table rejects them."""
    lost = fx.captures(spark, sf).withColumns({
        "hex": F.when(F.col("event_id") % 53 != 0, F.col("hex")),
        "observation_epoch": F.when(F.col("event_id") % 59 != 0, F.col("observation_epoch"))})
    store = _stored(spark, lost, "lossy", D.OBS_KEY, "observation_epoch")
    return store.rejects().groupBy("missing_part").agg(F.count(F.lit(1)).alias("rows"))


@register("db_summary", sql(f"""
WITH st AS (SELECT {STATS_COLS} FROM p WHERE v IS NOT NULL)
SELECT (SELECT COUNT(*) FROM obs) AS observations, (SELECT COUNT(DISTINCT hex) FROM obs) AS unique_aircraft,
 (SELECT COUNT(*) FROM st) AS stats_rows, (SELECT MIN(observation_time) FROM obs) AS earliest,
 (SELECT MAX(observation_time) FROM obs) AS latest""", "obs", "stats_docs", extra=[("p", STATS_A)]))
def _db_summary(spark, sf):
    o = fx.obs(spark, sf).select("hex", "observation_time", F.lit(1).alias("_o"), F.lit(0).alias("_s"))
    s = _stats(spark, sf, "a").select(F.lit(None).cast("string").alias("hex"),
                                      F.lit(None).cast("timestamp_ntz").alias("observation_time"),
                                      F.lit(0).alias("_o"), F.lit(1).alias("_s"))
    return (o.unionByName(s)
            .agg(F.sum("_o").alias("observations"), F.count_distinct("hex").alias("unique_aircraft"),
                 F.sum("_s").alias("stats_rows"), F.min("observation_time").alias("earliest"),
                 F.max("observation_time").alias("latest")))


@register("file_listing", sql("""
SELECT 'capture_date=' || CAST(capture_date AS VARCHAR) AS folder, 1 AS files, CAST(SUM(strlen(hex) + 1) AS BIGINT) AS size,
 TRUE AS named, TRUE AS current FROM daily GROUP BY capture_date""", "daily"))
def _file_listing(spark, sf):
    """S9 over a level written for it, one text file a date: what the listing says of name, size and
    time is held against what was written and when."""
    root = shared_dir(spark, unique_name("listing-of"))
    started = int(time.time()) - 300           # the store's clock may differ a little
    daily(spark, sf).select("hex", "capture_date").repartition("capture_date").write.partitionBy("capture_date").text(root)
    listed = S.list_tree(spark, root, "*.txt", prefixes=16)
    seconds = F.unix_seconds("mtime")
    return (listed.groupBy(F.regexp_extract("path", "(capture_date=[^/]+)/", 1).alias("folder"))
            .agg(F.count(F.lit(1)).cast("int").alias("files"), F.sum("size").alias("size"),
                 F.bool_and(F.col("name").rlike(r"^part-[^/]+\.txt$")).alias("named"),
                 F.bool_and(seconds.between(started, int(time.time()) + 300)).alias("current")))


@register("level_metadata", sql("""
SELECT capture_date, COUNT(*) AS rows, MIN(observation_epoch) AS first_epoch, MAX(observation_epoch) AS last_epoch FROM daily GROUP BY capture_date""", "daily"))
def _level_metadata(spark, sf):
    root = shared_dir(spark, unique_name("metadata"))
    path = sinks.write_level(daily(spark, sf).select("hex", "observation_epoch", "capture_date"), root, "daily")
    return S.level_metadata(spark, path)


def _sketched(spark, sf):
    """The daily level stored with its sketches; both as read back."""
    root = shared_dir(spark, unique_name("sketched"))
    path = sinks.write_level(daily(spark, sf).select("hex", "observation_time", "capture_date"), root, "daily")
    level = spark.read.parquet(path)
    SK.store_sketches(level, root)
    return level, SK.read_sketches(spark, root)


def _held(approx, exact, *by):
    """Approximate counts beside exact ones: ``within`` is true inside four standard errors."""
    error = F.abs(F.col("approx_aircraft") - F.col("exact"))
    if by:
        j = approx.join(exact, list(by))
    else:           # one row each
        both = approx.unionByName(exact, allowMissingColumns=True)
        j = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return j.select(*by, "total_records", "earliest", "latest", "dates",
                    (error <= F.greatest(F.lit(1.0), 4 * SK.standard_error() * F.col("exact"))).alias("within"))


@register("weekly_summary_sketch", sql("""
SELECT week_ending, COUNT(*) AS total_records, MIN(observation_time) AS earliest, MAX(observation_time) AS latest,
 COUNT(DISTINCT capture_date) AS dates, TRUE AS within FROM weekly GROUP BY week_ending""", "daily", extra=[("weekly", WEEKLY)]))
def _weekly_summary_sketch(spark, sf):
    """A3 from stored sketches; what they say of the aircraft is held against the exact count."""
    level, sketches = _sketched(spark, sf)
    exact = L.weekly_level(level).groupBy("week_ending").agg(F.count_distinct("hex").alias("exact"))
    return _held(SK.weekly_summary(sketches), exact, "week_ending")


@register("range_summary_sketch", sql(f"""
SELECT COUNT(*) AS total_records, MIN(observation_time) AS earliest, MAX(observation_time) AS latest,
 COUNT(DISTINCT capture_date) AS dates, TRUE AS within
FROM daily WHERE capture_date BETWEEN DATE '{MONTH[0]}' AND DATE '{MONTH[1]}'""", "daily"))
def _range_summary_sketch(spark, sf):
    level, sketches = _sketched(spark, sf)
    month = level.where(F.col("capture_date").between(F.lit(MONTH[0]).cast("date"), F.lit(MONTH[1]).cast("date")))
    return _held(SK.range_summary(sketches, *MONTH), month.agg(F.count_distinct("hex").alias("exact")))

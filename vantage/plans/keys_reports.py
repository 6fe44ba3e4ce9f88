"""Driver keys for the single-table reports."""

from __future__ import annotations

from vantage.functions.columns import clean_callsign, epoch_to_local
from vantage.operators import reports as R
from vantage.oracle import ALT_FT, WS, sql
from vantage.plans.catalog import register
from vantage.sources import fixtures as fx

# Fixed parameters of the registered queries.
TRACK_HEX = "a00007"
CLOCK_NOW = "2024-01-25 00:00:00"
CLOCK_MAX_AGE_DAYS = 20
LOCAL_TZ = "America/Chicago"


def _obs(spark, sf):
    return fx.obs(spark, sf)


@register("complete_only", sql("""
SELECT * FROM obs WHERE lat IS NOT NULL AND lon IS NOT NULL AND gs IS NOT NULL AND track IS NOT NULL""", "obs"))
def _complete_only(spark, sf):
    return R.complete_only(_obs(spark, sf))


@register("complete_counts", sql("""
SELECT COUNT(*) AS collected,
 COUNT(*) FILTER (WHERE NOT (lat IS NOT NULL AND lon IS NOT NULL AND gs IS NOT NULL AND track IS NOT NULL)) AS rejected,
 COUNT(*) FILTER (WHERE lat IS NOT NULL AND lon IS NOT NULL AND gs IS NOT NULL AND track IS NOT NULL) AS kept,
 COUNT(DISTINCT CASE WHEN lat IS NOT NULL AND lon IS NOT NULL AND gs IS NOT NULL AND track IS NOT NULL THEN hex END) AS kept_aircraft
FROM obs""", "obs"))
def _complete_counts(spark, sf):
    return R.complete_counts(_obs(spark, sf))


@register("capture_summary", sql("""
SELECT COUNT(*) AS total_records, COUNT(DISTINCT hex) AS unique_aircraft,
 MIN(observation_time) AS earliest, MAX(observation_time) AS latest
FROM obs WHERE lat IS NOT NULL AND lon IS NOT NULL AND gs IS NOT NULL AND track IS NOT NULL""", "obs"))
def _capture_summary(spark, sf):
    return R.capture_summary(R.complete_only(_obs(spark, sf)))


@register("basic_info", sql("""
SELECT COUNT(*) AS total_records, COUNT(DISTINCT hex) AS unique_aircraft, COUNT(DISTINCT flight) AS unique_flights,
 COUNT(DISTINCT observation_epoch) AS unique_timestamps, MIN(observation_time) AS earliest,
 MAX(observation_time) AS latest, MAX(observation_epoch) - MIN(observation_epoch) AS span_seconds
FROM obs""", "obs"))
def _basic_info(spark, sf):
    return R.basic_info(_obs(spark, sf))


@register("unique_aircraft", sql("SELECT COUNT(DISTINCT hex) AS unique_aircraft FROM obs", "obs"))
def _unique_aircraft(spark, sf):
    return R.unique_aircraft(_obs(spark, sf))


@register("category_counts", sql("""
SELECT category, COUNT(*) AS observations FROM obs WHERE category IS NOT NULL GROUP BY category""", "obs"))
def _category_counts(spark, sf):
    return R.category_counts(_obs(spark, sf))


@register("category_aircraft", sql("""
SELECT category, COUNT(DISTINCT hex) AS unique_aircraft, COUNT(*) AS observations
FROM obs WHERE category IS NOT NULL GROUP BY category""", "obs"))
def _category_aircraft(spark, sf):
    return R.category_aircraft(_obs(spark, sf))


@register("category_share", sql("""
SELECT COALESCE(category, '(unknown)') AS category, COUNT(*) AS count, COUNT(DISTINCT hex) AS unique_aircraft,
 ROUND(100.0::DOUBLE * COUNT(*) / SUM(COUNT(*)) OVER (), 2) AS percentage
FROM obs GROUP BY category ORDER BY count DESC, category NULLS LAST LIMIT 10""", "obs"))
def _category_share(spark, sf):
    return R.category_share(_obs(spark, sf))


@register("signal_stats", sql(f"""
SELECT AVG(rssi) AS avg_rssi, MIN(rssi) AS min_rssi, MAX(rssi) AS max_rssi,
 AVG(messages) AS avg_messages FROM obs WHERE rssi IS NOT NULL""", "obs"))
def _signal_stats(spark, sf):
    return R.signal_stats(_obs(spark, sf))


@register("signal_stats_full", sql(f"""
SELECT COUNT(*) AS records_with_rssi, AVG(rssi) AS avg_rssi, MIN(rssi) AS min_rssi, MAX(rssi) AS max_rssi,
 AVG(messages) AS avg_messages, MAX(messages) AS max_messages FROM obs WHERE rssi IS NOT NULL""", "obs"))
def _signal_stats_full(spark, sf):
    return R.signal_stats_full(_obs(spark, sf))


@register("top_flights", sql("""
SELECT flight, hex, COUNT(*) AS observations, MIN(observation_time) AS first_seen, MAX(observation_time) AS last_seen
FROM obs WHERE flight IS NOT NULL GROUP BY flight, hex
ORDER BY observations DESC, flight, hex LIMIT 10""", "obs"))
def _top_flights(spark, sf):
    return R.top_flights(_obs(spark, sf))


@register("top_aircraft", sql("""
SELECT hex, flight, COUNT(*) AS observations, MIN(observation_time) AS first_seen, MAX(observation_time) AS last_seen
FROM obs GROUP BY hex, flight ORDER BY observations DESC, hex NULLS LAST, flight NULLS LAST LIMIT 10""", "obs"))
def _top_aircraft(spark, sf):
    return R.top_aircraft(_obs(spark, sf))


@register("top_aircraft_dates", sql("""
SELECT hex, flight, COUNT(*) AS observations, MIN(CAST(observation_time AS DATE)) AS first_seen,
 MAX(CAST(observation_time AS DATE)) AS last_seen
FROM obs GROUP BY hex, flight ORDER BY observations DESC, hex NULLS LAST, flight NULLS LAST LIMIT 10""", "obs"))
def _top_aircraft_dates(spark, sf):
    return R.top_aircraft_dates(_obs(spark, sf))


@register("most_observed", sql("""
SELECT hex, flight, COUNT(*) AS total_observations, COUNT(DISTINCT CAST(observation_time AS DATE)) AS days_observed,
 MIN(observation_time) AS first_seen, MAX(observation_time) AS last_seen
FROM obs WHERE flight IS NOT NULL GROUP BY hex, flight ORDER BY total_observations DESC, hex, flight LIMIT 15""", "obs"))
def _most_observed(spark, sf):
    return R.most_observed(_obs(spark, sf))


# Fixed values of the altitude reports, written out on their own: where each band begins (feet).
AIRBORNE_BANDS = [(None, "< 5,000 ft"), (5000, "5,000-10,000 ft"), (10000, "10,000-20,000 ft"), (20000, "20,000-30,000 ft"), (30000, "30,000-40,000 ft"), (40000, "> 40,000 ft")]
GROUND_BANDS = [(None, "0-5k ft"), (5000, "5k-10k ft"), (10000, "10k-20k ft"), (20000, "20k-30k ft"), (30000, "30k-40k ft"), (40000, "40k+ ft")]


def bands(name: str, rows) -> str:
    """A table of bands (place, lowest foot or NULL, label) to which an altitude is joined as of."""
    values = ", ".join(f"({k}, {'-2147483648' if lo is None else lo}, '{lab}')" for k, (lo, lab) in enumerate(rows, 1))
    return f"{name}(place, lowest, label) AS (VALUES {values})"


@register("altitude_bands", sql(f"""
WITH {bands("band", AIRBORNE_BANDS)}, heights AS (SELECT {ALT_FT} AS ft FROM obs WHERE alt_baro <> 'ground')
SELECT label AS altitude_range, COUNT(*) AS count FROM heights ASOF JOIN band ON ft >= lowest GROUP BY place, label ORDER BY place""", "obs"))
def _altitude_bands(spark, sf):
    return R.altitude_bands(_obs(spark, sf))


@register("altitude_bands_ground", sql(f"""
WITH {bands("band", GROUND_BANDS)},
heights AS (SELECT alt_baro = 'ground' AS grounded, {ALT_FT} AS ft FROM obs WHERE alt_baro IS NOT NULL),
placed AS (SELECT 0 AS place, 'Ground' AS label FROM heights WHERE grounded
 UNION ALL SELECT place, label FROM heights ASOF JOIN band ON ft >= lowest WHERE NOT grounded)
SELECT label AS altitude_range, COUNT(*) AS observations, place AS sort_rank,
 ROUND(100.0::DOUBLE * COUNT(*) / (SELECT COUNT(*) FROM heights), 1) AS percentage FROM placed GROUP BY place, label""", "obs"))
def _altitude_bands_ground(spark, sf):
    return R.altitude_bands_ground(_obs(spark, sf))


@register("daily_activity", sql("""
WITH days AS (SELECT CAST(observation_time AS DATE) AS date, *, lat IS NOT NULL AND lon IS NOT NULL AS placed FROM obs)
SELECT date, COUNT(*) AS observations, COUNT(DISTINCT hex) AS aircraft, COUNT(DISTINCT flight) AS flights,
 AVG(gs) AS avg_ground_speed, COUNT(*) FILTER (WHERE placed) AS with_position FROM days GROUP BY date""", "obs"))
def _daily_activity(spark, sf):
    return R.daily_activity(_obs(spark, sf))


@register("hourly_activity", sql("""
SELECT CAST(hour(observation_time) AS INTEGER) AS hour, COUNT(*) AS observations, COUNT(DISTINCT hex) AS unique_aircraft
FROM obs GROUP BY 1 ORDER BY hour""", "obs"))
def _hourly_activity(spark, sf):
    return R.hourly_activity(_obs(spark, sf))


# What each line of the profile calls missing.
ABSENT = {"hex": "hex IS NULL", "position": "lat IS NULL OR lon IS NULL", "ground_speed": "gs IS NULL", "track": "track IS NULL",
          "altitude": "alt_baro IS NULL"}


@register("null_profile", sql("SELECT COUNT(*) AS total_records, " + ", ".join(
    f"COUNT(*) FILTER (WHERE {c}) AS missing_{n}, ROUND(100.0::DOUBLE * COUNT(*) FILTER (WHERE {c}) / NULLIF(COUNT(*), 0), 2) AS missing_{n}_pct"
    for n, c in ABSENT.items()) + " FROM obs", "obs"))
def _null_profile(spark, sf):
    return R.null_profile(_obs(spark, sf))


@register("centroid", sql(f"""
SELECT AVG(lat) AS center_lat, AVG(lon) AS center_lon
FROM obs WHERE lat IS NOT NULL AND lon IS NOT NULL""", "obs"))
def _centroid(spark, sf):
    return R.centroid(_obs(spark, sf))


@register("time_extent", sql("""
SELECT MIN(observation_epoch) AS min_epoch, MAX(observation_epoch) AS max_epoch
FROM obs WHERE lat IS NOT NULL AND lon IS NOT NULL""", "obs"))
def _time_extent(spark, sf):
    return R.time_extent(_obs(spark, sf))


@register("recent_positions", sql("""
SELECT hex, flight, lat, lon, alt_baro, gs, track, observation_time FROM obs
WHERE lat IS NOT NULL AND lon IS NOT NULL ORDER BY observation_time DESC NULLS LAST, hex NULLS LAST LIMIT 10""", "obs"))
def _recent_positions(spark, sf):
    return R.recent_positions(_obs(spark, sf))


@register("track_aircraft", sql(f"""
SELECT observation_time, hex, flight, lat, lon, alt_baro, gs, track FROM obs
WHERE hex = '{TRACK_HEX}' ORDER BY observation_time""", "obs"))
def _track_aircraft(spark, sf):
    return R.track_aircraft(_obs(spark, sf), TRACK_HEX)


@register("distinct_callsigns", sql("""
SELECT DISTINCT flight, hex FROM obs WHERE flight IS NOT NULL ORDER BY flight, hex LIMIT 20""", "obs"))
def _distinct_callsigns(spark, sf):
    return R.distinct_callsigns(_obs(spark, sf))


@register("position_coverage", sql("""
WITH g AS (SELECT COUNT(*) AS total,
 CAST(SUM(CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS with_position,
 CAST(SUM(CASE WHEN lat IS NULL OR lon IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS without_position FROM obs)
SELECT *, ROUND(100.0::DOUBLE * with_position / NULLIF(total, 0), 2) AS coverage_pct FROM g""", "obs"))
def _position_coverage(spark, sf):
    return R.position_coverage(_obs(spark, sf))


@register("altitude_coverage", sql("""
WITH g AS (SELECT COUNT(*) AS total,
 CAST(SUM(CASE WHEN alt_baro IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS with_alt_baro,
 CAST(SUM(CASE WHEN alt_baro = 'ground' THEN 1 ELSE 0 END) AS BIGINT) AS on_ground FROM obs)
SELECT *, ROUND(100.0::DOUBLE * with_alt_baro / NULLIF(total, 0), 2) AS altitude_coverage_pct,
 ROUND(100.0::DOUBLE * on_ground / NULLIF(total, 0), 2) AS ground_pct FROM g""", "obs"))
def _altitude_coverage(spark, sf):
    return R.altitude_coverage(_obs(spark, sf))


@register("timestamp_sanity", sql(f"""
SELECT COUNT(*) FILTER (WHERE observation_time > TIMESTAMP '{CLOCK_NOW}') AS future_rows,
 COUNT(*) FILTER (WHERE observation_time < TIMESTAMP '{CLOCK_NOW}' - INTERVAL '{CLOCK_MAX_AGE_DAYS}' DAY) AS old_rows
FROM obs""", "obs"))
def _timestamp_sanity(spark, sf):
    return R.timestamp_sanity(_obs(spark, sf), CLOCK_NOW, CLOCK_MAX_AGE_DAYS)


@register("per_source_file", sql("""
SELECT source_file, COUNT(*) AS records, COUNT(DISTINCT hex) AS aircraft, MIN(observation_time) AS earliest,
 MAX(observation_time) AS latest FROM obs GROUP BY source_file ORDER BY earliest DESC""", "obs"))
def _per_source_file(spark, sf):
    return R.per_source_file(_obs(spark, sf))


@register("callsign_clean", sql(f"""
SELECT event_id, hex, CASE WHEN flight IS NULL OR flight = '' THEN NULL ELSE trim(flight, {WS}) END AS flight
FROM obs""", "obs"))
def _callsign_clean(spark, sf):
    o = _obs(spark, sf)
    return o.select("event_id", "hex", clean_callsign("flight").alias("flight"))


@register("epoch_to_local", sql(f"""
SELECT event_id, observation_epoch,
 CAST(timezone('{LOCAL_TZ}', timezone('UTC', make_timestamp(CAST(round(observation_epoch * 1000000) AS BIGINT)))) AS TIMESTAMP) AS local_time,
 make_timestamp(CAST(round(observation_epoch * 1000000) AS BIGINT)) AS utc_time
FROM obs""", "obs"))
def _epoch_to_local(spark, sf):
    o = _obs(spark, sf)
    return o.select("event_id", "observation_epoch", epoch_to_local("observation_epoch", LOCAL_TZ).alias("local_time"),
                    epoch_to_local("observation_epoch", "UTC").alias("utc_time"))

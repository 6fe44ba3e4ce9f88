"""Driver keys for flight paths, segments and GeoJSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from vantage.operators import paths as PA
from vantage.oracle import WS, sql
from vantage.plans.catalog import register
from vantage.sources import fixtures as fx

MIN_OBS = 5
LABEL = f"CASE WHEN length(trim(flight, {WS})) > 0 THEN trim(flight, {WS}) ELSE hex END"
ORDER = "p.observation_time, p.observation_epoch NULLS FIRST, p.source_file, p.lat, p.lon, p.alt_baro NULLS FIRST, p.gs NULLS FIRST, p.track NULLS FIRST, p.rssi"
POINTS = f"""
pos AS (SELECT * FROM tied WHERE lat IS NOT NULL AND lon IS NOT NULL),
c AS (SELECT hex, flight FROM pos WHERE flight IS NOT NULL GROUP BY hex, flight HAVING COUNT(*) >= {MIN_OBS}),
pts AS (SELECT p.*, ROW_NUMBER() OVER (PARTITION BY p.hex, p.flight ORDER BY {ORDER}) AS seq
        FROM pos p JOIN c ON p.hex = c.hex AND p.flight = c.flight)"""
TIED = """SELECT * FROM obs UNION ALL
 SELECT * REPLACE (observation_time + INTERVAL '1' SECOND AS observation_time, lat + 1 AS lat, NULL AS observation_epoch) FROM obs WHERE event_id % 10 = 3
 UNION ALL SELECT * REPLACE (date_trunc('hour', observation_time) AS observation_time, lon + 2 AS lon) FROM obs WHERE event_id % 7 = 5"""


def tied(spark, sf):
    """Observations with equal times within a path and with NULL epochs."""
    o = fx.obs(spark, sf)
    later = (o.where("event_id % 10 = 3")
             .withColumns({"observation_time": F.col("observation_time") + F.expr("INTERVAL 1 SECOND"), "lat": F.col("lat") + 1,
                           "observation_epoch": F.lit(None).cast("double")}))
    hour = (o.where("event_id % 7 = 5")
            .withColumns({"observation_time": F.date_trunc("hour", "observation_time").cast("timestamp_ntz"), "lon": F.col("lon") + 2}))
    return o.unionByName(later).unionByName(hour)


@register("flight_candidates", sql(f"""
SELECT hex, flight, COUNT(*) AS points FROM obs WHERE lat IS NOT NULL AND lon IS NOT NULL
GROUP BY hex, flight HAVING COUNT(*) >= {MIN_OBS}""", "obs"))
def _flight_candidates(spark, sf):
    return PA.flight_candidates(fx.obs(spark, sf), MIN_OBS)


def path_sql(body: str) -> str:
    return sql("WITH " + POINTS + body, "obs", extra=[("tied", TIED)])


@register("flight_paths", path_sql(f"""
SELECT hex, flight, {LABEL} AS label, seq, observation_time, observation_epoch, lat, lon, alt_baro, gs, track, rssi FROM pts"""))
def _flight_paths(spark, sf):
    return PA.flight_paths(tied(spark, sf), MIN_OBS)


@register("path_segments", path_sql(f"""
SELECT a.hex, a.flight, CASE WHEN length(trim(a.flight, {WS})) > 0 THEN trim(a.flight, {WS}) ELSE a.hex END AS label, a.seq,
 a.observation_time AS from_time, a.lat AS from_lat, a.lon AS from_lon, a.alt_baro AS from_alt, a.gs AS from_speed, a.track AS from_track,
 b.observation_time AS to_time, b.lat AS to_lat, b.lon AS to_lon, b.alt_baro AS to_alt, b.gs AS to_speed, b.track AS to_track
FROM pts a JOIN pts b ON a.hex = b.hex AND a.flight = b.flight AND b.seq = a.seq + 1"""))
def _path_segments(spark, sf):
    return PA.path_segments(tied(spark, sf), MIN_OBS)


@register("path_endpoints", path_sql(f"""
SELECT hex, flight, {LABEL} AS label, COUNT(*) AS points,
 arg_min(observation_time, seq) AS start_time, arg_min(lat, seq) AS start_lat, arg_min(lon, seq) AS start_lon,
 arg_max(observation_time, seq) AS end_time, arg_max(lat, seq) AS end_lat, arg_max(lon, seq) AS end_lon
FROM pts GROUP BY hex, flight"""))
def _path_endpoints(spark, sf):
    return PA.path_endpoints(tied(spark, sf), MIN_OBS)


@register("path_altitude", path_sql(""",
g AS (SELECT hex, flight,
  COUNT(*) FILTER (WHERE alt_baro IS NOT NULL AND alt_baro <> 'ground') AS u,
  COUNT(*) FILTER (WHERE alt_baro IS NOT NULL AND alt_baro <> 'ground' AND NOT regexp_matches(alt_baro, '^\\s*[+-]?[0-9]+\\s*$')) AS bad,
  MIN(CASE WHEN alt_baro IS NOT NULL AND alt_baro <> 'ground' AND regexp_matches(alt_baro, '^\\s*[+-]?[0-9]+\\s*$') THEN CAST(trim(alt_baro) AS INTEGER) END) AS mn,
  MAX(CASE WHEN alt_baro IS NOT NULL AND alt_baro <> 'ground' AND regexp_matches(alt_baro, '^\\s*[+-]?[0-9]+\\s*$') THEN CAST(trim(alt_baro) AS INTEGER) END) AS mx
 FROM pts GROUP BY hex, flight)
SELECT hex, flight, CASE WHEN u = 0 THEN 'ground' WHEN bad > 0 THEN 'varies' ELSE CAST(mn AS VARCHAR) || '-' || CAST(mx AS VARCHAR) || ' ft' END AS alt_info,
 CASE WHEN bad = 0 THEN mn END AS min_alt, CASE WHEN bad = 0 THEN mx END AS max_alt FROM g"""))
def _path_altitude(spark, sf):
    return PA.path_altitude(tied(spark, sf), MIN_OBS)


@register("path_totals", path_sql("""
SELECT COUNT(DISTINCT (hex, flight)) AS paths, COUNT(*) AS points FROM pts"""))
def _path_totals(spark, sf):
    return PA.path_totals(tied(spark, sf), MIN_OBS)


ISO = "CASE WHEN {t} = date_trunc('second', {t}) THEN strftime({t}, '%Y-%m-%dT%H:%M:%S') ELSE strftime({t}, '%Y-%m-%dT%H:%M:%S.%f') END"


@register("path_features", path_sql(f""",
named AS (SELECT *, {LABEL} AS label, {ISO.format(t='observation_time')} AS iso FROM pts)
SELECT 'point' AS kind, hex, flight, label, seq, alt_baro AS altitude, gs AS speed, track, iso AS time, NULL AS to_time, lon, lat,
 NULL AS to_lon, NULL AS to_lat FROM named
UNION ALL
SELECT 'segment', a.hex, a.flight, a.label, a.seq, a.alt_baro, a.gs, a.track, a.iso, b.iso, a.lon, a.lat, b.lon, b.lat
FROM named a JOIN named b ON a.hex = b.hex AND a.flight = b.flight AND b.seq = a.seq + 1"""))
def _path_features(spark, sf):
    f = PA.path_features(tied(spark, sf), MIN_OBS)
    at = lambda i, k: F.get(F.get("coordinates", F.lit(i)), F.lit(k))
    return f.select("kind", "hex", "flight", "label", "seq", "altitude", "speed", "track", F.get("times", F.lit(0)).alias("time"),
                    F.get("times", F.lit(1)).alias("to_time"), at(0, 0).alias("lon"), at(0, 1).alias("lat"),
                    at(1, 0).alias("to_lon"), at(1, 1).alias("to_lat"))


@register("geojson_features", path_sql(f""",
named AS (SELECT *, {LABEL} AS label, {ISO.format(t='observation_time')} AS iso FROM pts),
found AS (SELECT 'point' AS kind, hex, flight, count(*) AS n, sum(lon) AS lon, sum(lat) AS lat, min(iso) AS first FROM named GROUP BY ALL
 UNION ALL SELECT 'segment', a.hex, a.flight, count(*), sum(a.lon + b.lon), sum(a.lat + b.lat), min(a.iso)
 FROM named a JOIN named b ON a.hex = b.hex AND a.flight = b.flight AND b.seq = a.seq + 1 GROUP BY ALL)
SELECT kind, hex, flight, n, round(lon, 4) AS lon, round(lat, 4) AS lat, first FROM found"""))
def _geojson_features(spark, sf):
    """The GeoJSON text is parsed back, and each path's features are summed."""
    f = PA.geojson_features(tied(spark, sf), MIN_OBS)
    point = F.from_json("feature", "geometry struct<coordinates: array<double>>, properties struct<time: string>")
    line = F.from_json("feature", "geometry struct<coordinates: array<array<double>>>, properties struct<time: string>")
    flat = F.when(F.col("kind") == "point", F.array(point["geometry"]["coordinates"])).otherwise(line["geometry"]["coordinates"])
    sums = lambda k: F.aggregate(F.transform("c", lambda x: x[k]), F.lit(0.0), lambda a, x: a + x)
    return (f.select("kind", "hex", "flight", flat.alias("c"), F.get_json_object("feature", "$.properties.time").alias("t"))
            .groupBy("kind", "hex", "flight")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(sums(0)), 4).alias("lon"), F.round(F.sum(sums(1)), 4).alias("lat"),
                 F.min("t").alias("first")))

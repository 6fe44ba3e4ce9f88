"""Driver keys for the weather rollup."""

from __future__ import annotations

from pyspark.sql import functions as F

from vantage.operators import weather as W
from vantage.oracle import sql, week_ending
from vantage.plans.catalog import register
from vantage.sources import fixtures as fx

# Fixed values of the routing rules, written out here on their own (see operators/weather.py).
DAY_IN_NAME = r"(\d{4}-\d{2}-\d{2})"
USABLE_UNTIL, USABLE_FROM = "2025-09-16", "2026-03-13"
GEOJSON_UNTIL = "2023-11-30"

ROUTED = f"""
dated AS (SELECT *, NULLIF(regexp_extract(name, '{DAY_IN_NAME}', 1), '') AS day FROM weather_objects),
routed AS (SELECT * EXCLUDE (day), TRY_CAST(day AS DATE) AS obs_date,
 CASE WHEN day IS NULL THEN 'no-date' WHEN obs_date IS NULL THEN 'bad-date'
  WHEN obs_date > DATE '{USABLE_UNTIL}' AND obs_date < DATE '{USABLE_FROM}' THEN 'gap' WHEN name LIKE '%.txt' THEN 'metar'
  WHEN name LIKE '%:15%.json' AND obs_date >= DATE '{USABLE_FROM}' THEN 'json'
  WHEN name LIKE '%.json' AND obs_date <= DATE '{GEOJSON_UNTIL}' THEN 'geojson' ELSE 'other' END AS route
 FROM dated)"""
# The same for METAR text: the group that holds the temperature (sign, tenths), the line ends and the
# announcement that a file is none.
T_GROUP, LINE_END, MOVED = r"T([01])(\d{3})([01])(\d{3})", r"\r\n|\r|\n", "API endpoint has moved"
READING = (f"CASE WHEN regexp_extract(line, '{T_GROUP}', 1) = '1' THEN -1 ELSE 1 END"
           f" * CAST(regexp_extract(line, '{T_GROUP}', 2) AS INTEGER) / 10.0::DOUBLE")
METAR = f"""
ml AS (SELECT name, obs_date, unnest(regexp_split_to_array(content, '{LINE_END}')) AS line FROM routed
       WHERE route = 'metar' AND NOT contains(content, '{MOVED}')),
mt AS (SELECT name, obs_date, {READING} AS temp_c FROM ml WHERE regexp_matches(line, '{T_GROUP}'))"""
GEO = """
gj AS (SELECT name, obs_date, unnest(from_json(content, '{"features":[{"properties":{"temp":"VARCHAR"}}]}').features) AS f
       FROM routed WHERE route = 'geojson' AND json_valid(content)),
gt AS (SELECT name, obs_date, TRY_CAST(f.properties.temp AS DOUBLE) AS temp_c FROM gj WHERE TRY_CAST(f.properties.temp AS DOUBLE) IS NOT NULL)"""
JS = """
jj AS (SELECT name, obs_date, unnest(CASE WHEN json_type(content) = 'ARRAY' THEN from_json(content, '[{"temp_c":"VARCHAR"}]')
        ELSE [from_json(content, '{"temp_c":"VARCHAR"}')] END) AS r
       FROM routed WHERE route = 'json' AND json_valid(content)),
jt AS (SELECT name, obs_date, TRY_CAST(r.temp_c AS DOUBLE) AS temp_c FROM jj WHERE TRY_CAST(r.temp_c AS DOUBLE) IS NOT NULL)"""


def _routed(spark, sf):
    return W.weather_route(fx.weather_objects(spark, sf))


@register("weather_route", sql("WITH " + ROUTED + """ SELECT route, COUNT(*) AS objects,
 COUNT(*) FILTER (WHERE route IN ('metar', 'json', 'geojson') AND content IS NOT NULL) AS processed,
 COUNT(*) FILTER (WHERE route = 'bad-date' OR (content IS NULL AND route IN ('metar', 'json', 'geojson'))) AS errors
FROM routed GROUP BY route""",
                               "weather_objects"))
def _weather_route(spark, sf):
    return W.route_counts(_routed(spark, sf))


@register("metar_temps", sql("WITH " + ROUTED + "," + METAR + " SELECT * FROM mt", "weather_objects"))
def _metar_temps(spark, sf):
    return W.metar_temps(_routed(spark, sf))


LINES = f"""
fl AS (SELECT name, obs_date, unnest(regexp_split_to_array(content, '{LINE_END}')) AS line FROM routed WHERE route = 'metar'),
gone AS (SELECT DISTINCT name FROM fl WHERE contains(line, '{MOVED}')),
lt AS (SELECT name, obs_date, {READING} AS temp_c FROM fl WHERE regexp_matches(line, '{T_GROUP}') AND name NOT IN (SELECT name FROM gone))"""


@register("metar_temps_by_line", sql("WITH " + ROUTED + "," + LINES + " SELECT * FROM lt", "weather_objects"))
def _metar_temps_by_line(spark, sf):
    """All objects of one name are the lines of one file here, so that files differ in length."""
    objects = fx.weather_objects(spark, sf)
    return W.metar_temps_by_line(objects.select("name", F.explode(F.split("content", W.LINE_BREAK)).alias("line")))


@register("geojson_temps", sql("WITH " + ROUTED + "," + GEO + " SELECT * FROM gt", "weather_objects"))
def _geojson_temps(spark, sf):
    return W.geojson_temps(_routed(spark, sf))


@register("json_temps", sql("WITH " + ROUTED + "," + JS + " SELECT * FROM jt", "weather_objects"))
def _json_temps(spark, sf):
    return W.json_temps(_routed(spark, sf))


@register("weather_weekly", sql("WITH " + ROUTED + "," + METAR + "," + GEO + "," + JS + f""",
t AS (SELECT * FROM mt UNION ALL SELECT * FROM gt UNION ALL SELECT * FROM jt),
g AS (SELECT {week_ending('obs_date')} AS week_ending, SUM(CAST(round(temp_c * 1000000) AS HUGEINT)) AS s,
      COUNT(*) AS obs_count FROM t GROUP BY 1),
q1 AS (SELECT *, obs_count * 10000 AS d, ((s % (obs_count * 10000)) + obs_count * 10000) % (obs_count * 10000) AS r FROM g),
q2 AS (SELECT *, (s - r) // d AS q0 FROM q1),
q3 AS (SELECT *, CAST(q0 + CASE WHEN 2 * r > d OR (2 * r = d AND q0 % 2 <> 0) THEN 1 ELSE 0 END AS BIGINT) AS q FROM q2),
f1 AS (SELECT *, 9 * q + 16000 AS fs, ((9 * q + 16000) % 50 + 50) % 50 AS fr FROM q3),
f2 AS (SELECT *, (fs - fr) // 50 AS fq0 FROM f1)
SELECT week_ending, q / 100.0::DOUBLE AS avg_temp_c,
 CAST(fq0 + CASE WHEN 2 * fr > 50 OR (2 * fr = 50 AND fq0 % 2 <> 0) THEN 1 ELSE 0 END AS BIGINT) / 10.0::DOUBLE AS avg_temp_f,
 obs_count FROM f2""",
                                "weather_objects"))
def _weather_weekly(spark, sf):
    return W.weather_weekly(W.all_temps(fx.weather_objects(spark, sf)))

"""DuckDB statements used as an independent check of the Spark operators.

The driver registers the generated tables as views; the adapter views below rebuild the
reference's input shapes from them with the same formulas as ``vantage.sources.fixtures``.
``sql(body, *views)`` prefixes a statement with the CTEs it needs (dependencies included).
"""

from __future__ import annotations

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "obs": ((), """
SELECT ts AS observation_time, epoch_us(ts)/1e6 AS observation_epoch,
 CASE WHEN user_id%10=0 THEN 'b' ELSE 'a' END || lpad(CAST(user_id AS VARCHAR),5,'0') AS hex,
 CASE WHEN event_id%7=0 THEN NULL WHEN event_id%11=0 THEN '' ELSE upper(substr(event_type,1,3)) || CAST(user_id%40 AS VARCHAR) END AS flight,
 CASE WHEN event_id%5=0 THEN NULL ELSE 44 + CAST(event_id%1000 AS DOUBLE)/1000 END AS lat,
 CASE WHEN event_id%5=0 OR event_id%13=0 THEN NULL ELSE -94 + CAST(event_id%777 AS DOUBLE)/777 END AS lon,
 CASE WHEN event_id%9=0 THEN NULL WHEN event_type='error' AND event_id%4=0 THEN 'ground'
      WHEN event_id%3=0 THEN CAST(CAST(floor(value*100) AS BIGINT) AS VARCHAR) || '.0'
      ELSE CAST(CAST(floor(value*100) AS BIGINT)-50 AS VARCHAR) END AS alt_baro,
 CASE WHEN event_id%6=0 THEN NULL ELSE value END AS gs,
 CASE WHEN event_id%6=0 OR event_id%17=0 THEN NULL ELSE CAST(event_id%360 AS DOUBLE) END AS track,
 CASE WHEN event_id%8=0 THEN NULL ELSE 'A' || CAST(user_id%8 AS VARCHAR) END AS category,
 -1*CAST(event_id%30 AS DOUBLE)-0.5 AS rssi, CAST(json_extract_string(props,'$.k') AS BIGINT) AS messages,
 'history_' || CAST(event_id%120 AS VARCHAR) || '.json' AS source_file, event_id
FROM events"""),
    "airframes": ((), """
SELECT 'a' || lpad(CAST(c_custkey AS VARCHAR),5,'0') AS icao,
 CASE WHEN c_custkey%17=0 THEN NULL ELSE 'N' || CAST(c_custkey AS VARCHAR) END AS registration,
 substr(c_mktsegment,1,4) AS icao_type,
 CASE WHEN c_custkey%23=0 THEN '19xx' WHEN c_custkey%19=0 THEN NULL WHEN c_custkey%29=0 THEN '1850' ELSE CAST(1946+(c_custkey*37)%80 AS VARCHAR) END AS manufacture_year,
 n_name AS manufacturer, c_mktsegment AS model,
 CASE c_custkey%8 WHEN 0 THEN 'North LIFE LINK Air' WHEN 1 THEN 'Lakeside Medical Flight' WHEN 2 THEN 'Prairie Air Ambulance' ELSE c_name END AS owner_operator,
 CASE c_custkey%11 WHEN 0 THEN 'L1P' WHEN 1 THEN 'L2J' WHEN 2 THEN 'L4J' WHEN 3 THEN 'L2T' WHEN 4 THEN 'L1T' WHEN 5 THEN 'H2T' WHEN 6 THEN 'H1T' WHEN 7 THEN 'L3J' WHEN 8 THEN 'G1P' WHEN 9 THEN 'L0-' ELSE NULL END AS short_type,
 c_custkey%31=0 AS military
FROM customer JOIN nation ON c_nationkey=n_nationkey"""),
    "captures": (("obs",), """
SELECT o.*, date_trunc('hour', observation_time) + INTERVAL '1' HOUR AS capture_ts FROM obs o
UNION ALL SELECT o.*, date_trunc('hour', observation_time) + INTERVAL '2' HOUR FROM obs o
UNION ALL SELECT o.*, date_trunc('hour', observation_time) + INTERVAL '480' HOUR FROM obs o WHERE event_id%97=0"""),
    "files": (("captures",), """
SELECT 'flights_hourly_' || substr(CAST(capture_ts AS VARCHAR),1,10) || '_' || substr(CAST(capture_ts AS VARCHAR),12,2) || '00.parquet' AS name,
 'hourly' AS level, capture_ts, COUNT(*)*37 AS size, capture_ts + INTERVAL '1' MINUTE AS mtime
FROM captures GROUP BY capture_ts"""),
    "files_with_gaps": (("files",), "SELECT * FROM files WHERE hour(capture_ts)%5<>0"),
    "weather_objects": ((), """
SELECT o_orderkey, 'wx/' || substr(CAST(o_orderdate + INTERVAL '25' YEAR AS VARCHAR),1,10)
   || CASE o_orderkey%3 WHEN 0 THEN '_metar.txt' WHEN 1 THEN '_geo.json' ELSE 'T12:15.json' END AS name,
 CASE o_orderkey%3
  WHEN 0 THEN CASE WHEN o_orderkey%50=0 THEN 'API endpoint has moved' WHEN o_orderkey%9=0 THEN 'METAR KMSP AUTO RMK AO2'
       ELSE 'METAR KMSP AUTO RMK AO2 T' || CASE WHEN o_orderkey%4=0 THEN '1' ELSE '0' END || lpad(CAST(o_orderkey%400 AS VARCHAR),3,'0') || '1' || lpad(CAST(o_orderkey%200 AS VARCHAR),3,'0') END
  WHEN 1 THEN CASE WHEN o_orderkey%40=0 THEN 'not json' ELSE '{"features":[{"properties":{"temp":' || CASE WHEN o_orderkey%4=1 THEN '"' ELSE '' END || CAST(o_orderkey%30 AS VARCHAR) || CASE WHEN o_orderkey%4=1 THEN '"' ELSE '' END || '}},{"properties":{}}]}' END
  ELSE CASE WHEN o_orderkey%2=0 THEN '{"temp_c":' || CASE WHEN o_orderkey%4=1 THEN '"' ELSE '' END || CAST(o_orderkey%25 AS VARCHAR) || '.5' || CASE WHEN o_orderkey%4=1 THEN '"' ELSE '' END || '}' ELSE '[{"temp_c":' || CAST(o_orderkey%25 AS VARCHAR) || '.5},{"x":1}]' END
 END AS content
FROM orders"""),
    "stats_docs": ((), """
SELECT s_suppkey, '{"latest":{"start":' || CAST(s_suppkey*60 AS VARCHAR) || ',"end":' || CAST(s_suppkey*60 AS VARCHAR)
 || ',"local":{"modes":' || CAST(s_suppkey%7 AS VARCHAR) || ',"accepted":[' || CAST(s_suppkey%5 AS VARCHAR) || ',' || CAST(s_suppkey%3 AS VARCHAR) || ']},"messages":0,"tracks":{"all":0}},"total":{"start":0,"end":'
 || CAST(s_suppkey*60 AS VARCHAR) || ',"local":{},"messages":' || CAST(s_suppkey*11 AS VARCHAR) || ',"tracks":{"all":' || CAST(s_suppkey AS VARCHAR) || ',"single_message":1,"unreliable":2}}}' AS doc
FROM supplier"""),
    "hourly": (("captures",), """
SELECT *, CAST(capture_ts AS DATE) AS capture_date, CAST(hour(capture_ts) AS INTEGER) AS capture_hour FROM captures
WHERE lat IS NOT NULL AND lon IS NOT NULL AND gs IS NOT NULL AND track IS NOT NULL"""),
    "daily": (("hourly",), """
SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY capture_date, hex, observation_epoch
 ORDER BY observation_time, source_file, capture_ts) AS rn FROM hourly) WHERE rn = 1"""),
}

# Shared DuckDB expressions (mirror vantage.functions.columns).
ALT_FT = "CAST(round(TRY_CAST(alt_baro AS DOUBLE)) AS INTEGER)"
YEAR = "TRY_CAST(manufacture_year AS INTEGER)"
WS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"


def week_ending(d: str) -> str:
    """Sunday ending the Monday-Sunday week of date d (DuckDB isodow: Monday=1 .. Sunday=7)."""
    return f"(CAST({d} AS DATE) + CAST(7 - isodow(CAST({d} AS DATE)) AS INTEGER))"


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for dep in VIEWS[n][0]:
            visit(dep)
        out.append(n)

    for n in names:
        visit(n)
    return out


def sql(body: str, *views: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Statement ``body`` preceded by the adapter CTEs ``views`` (+ ``extra`` named CTEs)."""
    parts = [f"{n} AS ({VIEWS[n][1]}\n)" for n in _closure(views)]
    parts += [f"{n} AS ({q}\n)" for n, q in (extra or [])]
    if not parts:
        return body
    b = body.lstrip()
    if b[:4].upper() == "WITH":
        return "WITH " + ",\n".join(parts) + ",\n" + b[4:].lstrip()
    return "WITH " + ",\n".join(parts) + "\n" + body

"""Weekly temperature rollup from three generations of weather files.

Objects are (name, content) rows -- e.g. ``sources.levels.read_text_objects`` -- and every
object is parsed inside its own row (no object is split or collected); the only shuffle is
the final group by week.  Parsing is built-in Spark: ``split``/``regexp_extract`` for METAR
text, ``from_json`` for both JSON layouts (a lone object parses as a one-element array)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantage.functions.columns import half_even_div, week_ending

# Fixed values of the routing rules and parsers.
DATE_IN_NAME = r"(\d{4}-\d{2}-\d{2})"
GAP = ("2025-09-16", "2026-03-13")          # exclusive both ends: no usable files in between
NEW_JSON_FROM = "2026-03-13"                 # flat JSON ("temp_c"), names containing ':15'
GEOJSON_UNTIL = "2023-11-30"                 # GeoJSON features[].properties.temp
API_MOVED = "API endpoint has moved"
T_GROUP = r"T([01])(\d{3})([01])(\d{3})"     # METAR: sign (1 = negative), tenths of degC, dew point
LINE_BREAK = r"\r\n|\r|\n"


def weather_route(objects: DataFrame, name: str = "name") -> DataFrame:
    """Date from the name and the parser route: metar / json / geojson, or why the
    object is skipped (no-date, bad-date, gap, other)."""
    n = F.col(name)
    ds = F.regexp_extract(n, DATE_IN_NAME, 1)
    d = F.when(ds != "", ds)
    parsed = d.try_cast("date")
    route = (F.when(d.isNull(), F.lit("no-date"))
             .when(parsed.isNull(), F.lit("bad-date"))
             .when((d > GAP[0]) & (d < GAP[1]), F.lit("gap"))
             .when(n.endswith(".txt"), F.lit("metar"))
             .when(n.contains(":15") & n.endswith(".json") & (d >= NEW_JSON_FROM), F.lit("json"))
             .when(n.endswith(".json") & (d <= GEOJSON_UNTIL), F.lit("geojson"))
             .otherwise(F.lit("other")))
    return objects.withColumn("obs_date", parsed).withColumn("route", route)


def route_counts(routed: DataFrame, content: str = "content") -> DataFrame:
    """T4 counters per route: objects, how many were processed (given to a parser) and how many
    failed (a date that is none, or content that could not be read)."""
    parsed = F.col("route").isin("metar", "json", "geojson")
    unread = F.col(content).isNull() & ~F.col("route").isin("no-date", "gap", "other")
    error = (F.col("route") == "bad-date") | unread
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("objects"), F.count_if(parsed & ~unread).alias("processed"),
                                       F.count_if(error).alias("errors"))


def metar_temps(routed: DataFrame, content: str = "content") -> DataFrame:
    """Every line's T-group temperature; objects announcing the moved API give none.

    The route test sits inside the projection (``when(route == ...)``) rather than in a
    filter: a filter on ``route`` would be pushed below the routing projection and the
    optimizer would inline the whole routing expression (regex + date parse) into it."""
    take = (F.col("route") == "metar") & ~F.col(content).contains(API_MOVED)
    lines = routed.select("name", "obs_date", F.explode(F.when(take, F.split(F.col(content), LINE_BREAK))).alias("line"))
    return (lines.where(F.col("line").rlike(T_GROUP))
            .select("name", "obs_date", _t_group(F.col("line")).alias("temp_c")))


def metar_temps_by_line(lines: DataFrame) -> DataFrame:
    """T1 over (name, line) rows, as ``sources.levels.read_lines`` gives them: a file is split over as
    many tasks as its size asks for, and none is ever one row.  Files of which any line announces the
    moved API are left out by an anti join on the name."""
    metar = weather_route(lines).where(F.col("route") == "metar")
    moved = metar.where(F.col("line").contains(API_MOVED)).select("name").distinct()
    read = metar.where(F.col("line").rlike(T_GROUP)).join(moved, "name", "left_anti")
    return read.select("name", "obs_date", _t_group(F.col("line")).alias("temp_c"))


def _t_group(line: Column) -> Column:
    sign = F.when(F.regexp_extract(line, T_GROUP, 1) == "1", F.lit(-1)).otherwise(F.lit(1))
    return sign * F.regexp_extract(line, T_GROUP, 2).cast("int") / F.lit(10.0)


def _geojson(content: Column) -> Column:
    """Temperatures of ``features[].properties.temp``: numbers, or text that reads as a number."""
    found = F.from_json(content, "struct<features: array<struct<properties: struct<temp: string>>>>")
    return F.transform(found["features"], lambda f: f["properties"]["temp"].try_cast("double"))


def _flat_json(content: Column) -> Column:
    found = F.from_json(content, "array<struct<temp_c: string>>")
    return F.transform(found, lambda x: x["temp_c"].try_cast("double"))


def geojson_temps(routed: DataFrame, content: str = "content") -> DataFrame:
    """``features[].properties.temp``; unparsable content gives no rows."""
    r = routed.select("name", "obs_date", F.explode(F.when(F.col("route") == "geojson", _geojson(F.col(content)))).alias("temp_c"))
    return r.where(F.col("temp_c").isNotNull())


def json_temps(routed: DataFrame, content: str = "content") -> DataFrame:
    """``temp_c`` of an object or of each object of a list."""
    r = routed.select("name", "obs_date", F.explode(F.when(F.col("route") == "json", _flat_json(F.col(content)))).alias("temp_c"))
    return r.where(F.col("temp_c").isNotNull())


def all_temps(objects: DataFrame, content: str = "content") -> DataFrame:
    """T1-T3 in one pass: each object is routed once and parsed by its route into an array
    of temperatures (higher-order ``filter``/``transform``), exploded once."""
    r = weather_route(objects)
    c = F.col(content)
    metar = F.transform(F.filter(F.split(c, LINE_BREAK), lambda ln: ln.rlike(T_GROUP)), _t_group)
    temps = (F.when((F.col("route") == "metar") & ~c.contains(API_MOVED), metar)
             .when(F.col("route") == "geojson", _geojson(c)).when(F.col("route") == "json", _flat_json(c)))
    return (r.select("name", "obs_date", F.explode(temps).alias("temp_c"))
            .where(F.col("temp_c").isNotNull()))


def weather_weekly(temps: DataFrame) -> DataFrame:
    """T5: per Monday-Sunday week: mean degC to 2 dp, degF from the *rounded* mean to 1 dp,
    and the number of readings.  Both roundings are half-to-even on the exact decimal
    value: readings are summed as integer micro-degrees and the quotient is rounded with
    integer arithmetic, so the result does not depend on summation order or on how a
    binary double happens to sit next to a tie."""
    micro = F.round(F.col("temp_c") * 1000000).cast("decimal(38,0)")
    g = (temps.groupBy(week_ending("obs_date").alias("week_ending"))
         .agg(F.sum(micro).alias("_s"), F.count(F.lit(1)).alias("obs_count")))
    q = half_even_div(F.col("_s"), F.col("obs_count").cast("decimal(38,0)") * 10000)
    qf = half_even_div((q * 9 + 16000).cast("decimal(38,0)"), F.lit(50).cast("decimal(38,0)"))
    return g.select("week_ending", (q / F.lit(100.0)).alias("avg_temp_c"), (qf / F.lit(10.0)).alias("avg_temp_f"),
                    "obs_count").orderBy("week_ending")

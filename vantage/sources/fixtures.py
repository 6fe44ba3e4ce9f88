"""Adapters that give the reference's input shapes over the driver's generated tables.

Every adapter is a lazy DataFrame derived from the given parquet tables, so its size grows
with them.  The DuckDB twins of these views live in ``vantage.oracle`` (same formulas).

obs              one row per observation (36-column model, the columns the reports use)
airframes        registry rows (customer x nation)
captures         obs rows as seen by hourly captures (overlap of two hours + stale copies)
files            hourly file listing (``files_with_gaps``: every 5th hour missing)
level_files      listing of a stored level, one file per date
weather_objects  weather files: METAR text, GeoJSON, flat JSON
stats_docs       receiver stats JSON documents
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.functions.columns import epoch_seconds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(x):
    return x.cast("string")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs_from_events(table(spark, sf_dir, "events"))


def obs_from_events(e: DataFrame) -> DataFrame:
    """The observation adapter over any events frame (batch or streaming)."""
    eid, uid = F.col("event_id"), F.col("user_id")
    fl = F.floor(F.col("value") * 100).cast("bigint")
    return e.select(
        F.col("ts").alias("observation_time"),
        epoch_seconds("ts").alias("observation_epoch"),
        F.concat(F.when(uid % 10 == 0, F.lit("b")).otherwise(F.lit("a")), F.lpad(_s(uid), 5, "0")).alias("hex"),
        F.when(eid % 7 == 0, F.lit(None).cast("string"))
         .when(eid % 11 == 0, F.lit(""))
         .otherwise(F.concat(F.upper(F.substring("event_type", 1, 3)), _s(uid % 40))).alias("flight"),
        F.when(eid % 5 == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(44.0) + (eid % 1000).cast("double") / 1000).alias("lat"),
        F.when((eid % 5 == 0) | (eid % 13 == 0), F.lit(None).cast("double"))
         .otherwise(F.lit(-94.0) + (eid % 777).cast("double") / 777).alias("lon"),
        F.when(eid % 9 == 0, F.lit(None).cast("string"))
         .when((F.col("event_type") == "error") & (eid % 4 == 0), F.lit("ground"))
         .when(eid % 3 == 0, F.concat(_s(fl), F.lit(".0")))
         .otherwise(_s(fl - 50)).alias("alt_baro"),
        F.when(eid % 6 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("gs"),
        F.when((eid % 6 == 0) | (eid % 17 == 0), F.lit(None).cast("double"))
         .otherwise((eid % 360).cast("double")).alias("track"),
        F.when(eid % 8 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("A"), _s(uid % 8))).alias("category"),
        (F.lit(-1.0) * (eid % 30).cast("double") - 0.5).alias("rssi"),
        F.get_json_object("props", "$.k").cast("bigint").alias("messages"),
        F.concat(F.lit("history_"), _s(eid % 120), F.lit(".json")).alias("source_file"),
        eid.alias("event_id"),
    )


# Snapshot fields that the tables do not give, as expressions that both engines read.
SNAPSHOT_FIELDS = {
    "type": "CASE WHEN event_id % 4 = 0 THEN 'adsb_icao' END",
    "alt_geom": "CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 40000 AS STRING) END",
    "baro_rate": "CAST(event_id % 128 - 64 AS INT)", "geom_rate": "CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 96 AS INT) END",
    "squawk": "CAST(event_id % 7777 AS STRING)", "emergency": "CASE WHEN event_id % 50 = 0 THEN 'none' END",
    "nav_qnh": "CASE WHEN event_id % 5 = 1 THEN CAST(event_id % 40 AS DOUBLE) + 990.5 END",
    "nav_altitude_mcp": "CASE WHEN event_id % 5 = 2 THEN CAST(event_id % 30000 AS INT) END",
    "nav_altitude_fms": "CASE WHEN event_id % 5 = 3 THEN CAST(event_id % 31000 AS INT) END",
    "nav_heading": "CASE WHEN event_id % 5 = 4 THEN CAST(event_id % 360 AS DOUBLE) / 2 END",
    "seen": "CAST(event_id % 10 AS DOUBLE) / 2", "seen_pos": "CASE WHEN event_id % 5 <> 0 THEN CAST(event_id % 20 AS DOUBLE) / 4 END",
    "nic": "CAST(event_id % 9 AS INT)", "rc": "CAST(event_id % 500 AS INT)", "nic_baro": "CAST(event_id % 2 AS INT)",
    "nac_p": "CAST(event_id % 11 AS INT)", "nac_v": "CAST(event_id % 4 AS INT)", "sil": "CAST(event_id % 3 AS INT)",
    "sil_type": "CASE WHEN event_id % 6 = 0 THEN 'perhour' END", "gva": "CAST(event_id % 2 AS INT)",
    "sda": "CAST(event_id % 3 AS INT)", "version": "CASE WHEN event_id % 3 <> 0 THEN CAST(event_id % 3 AS INT) END",
}


def with_snapshot_fields(o: DataFrame) -> DataFrame:
    modes = (F.when(F.col("event_id") % 3 == 0, F.array(F.lit("autopilot"), F.lit("vnav")))
             .when(F.col("event_id") % 3 == 1, F.array(F.lit("tcas"))))
    return o.withColumns({n: F.expr(x) for n, x in SNAPSHOT_FIELDS.items()}).withColumn("nav_modes", modes)


def snapshot_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs_of(with_snapshot_fields(obs(spark, sf_dir)))


def docs_of(o: DataFrame, *keep: str) -> DataFrame:
    """Snapshot documents of two aircraft each: the observation with all its fields, and one of a
    non-standard address that has hardly any."""
    from vantage.schemas import AIRCRAFT
    from vantage.sources.snapshots import to_snapshot_docs
    full = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in AIRCRAFT.fields])
    bare = {"hex": F.concat(F.lit("~"), F.col("hex")), "flight": F.lit("   "), "rssi": F.col("rssi"), "alt_baro": F.lit("ground")}
    other = F.struct(*[bare.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in AIRCRAFT.fields])
    return to_snapshot_docs(o, [full, other], *keep)


def airframe_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry under the field names of its files."""
    a = airframes(spark, sf_dir)
    return a.select("icao", F.col("registration").alias("reg"), F.col("icao_type").alias("icaotype"),
                    F.col("manufacture_year").alias("year"), "manufacturer", "model", F.col("owner_operator").alias("ownop"),
                    F.lit(None).cast("boolean").alias("faa_pia"), F.lit(None).cast("boolean").alias("faa_ladd"), "short_type",
                    F.col("military").alias("mil"))


def airframes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = table(spark, sf_dir, "customer")
    na = table(spark, sf_dir, "nation")
    k = F.col("c_custkey")
    short = F.when(k % 11 == 0, "L1P")
    for i, code in enumerate(["L2J", "L4J", "L2T", "L1T", "H2T", "H1T", "L3J", "G1P", "L0-"], start=1):
        short = short.when(k % 11 == i, code)
    owner = (F.when(k % 8 == 0, "North LIFE LINK Air").when(k % 8 == 1, "Lakeside Medical Flight")
             .when(k % 8 == 2, "Prairie Air Ambulance").otherwise(F.col("c_name")))
    return (cu.join(na, cu.c_nationkey == na.n_nationkey)
            .select(
                F.concat(F.lit("a"), F.lpad(_s(k), 5, "0")).alias("icao"),
                F.when(k % 17 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("N"), _s(k))).alias("registration"),
                F.substring("c_mktsegment", 1, 4).alias("icao_type"),
                F.when(k % 23 == 0, F.lit("19xx")).when(k % 19 == 0, F.lit(None).cast("string"))
                 .when(k % 29 == 0, F.lit("1850")).otherwise(_s(F.lit(1946) + (k * 37) % 80)).alias("manufacture_year"),
                F.col("n_name").alias("manufacturer"),
                F.col("c_mktsegment").alias("model"),
                owner.alias("owner_operator"),
                short.otherwise(F.lit(None).cast("string")).alias("short_type"),
                (k % 31 == 0).alias("military"),
            ))


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each observation is captured by its own hour's file and the next one; every 97th row
    is captured again 20 days later (a stale copy).  One scan: the capture times of a row
    are an array that is exploded (same rows as the three-way UNION ALL of the definition)."""
    o = obs(spark, sf_dir)
    hour = F.date_trunc("hour", "observation_time").cast("timestamp_ntz")
    times = F.array(hour + F.expr("INTERVAL 1 HOUR"), hour + F.expr("INTERVAL 2 HOUR"),
                    F.when(F.col("event_id") % 97 == 0, hour + F.expr("INTERVAL 480 HOUR")))
    return (o.withColumn("capture_ts", F.explode(F.filter(times, lambda x: x.isNotNull())))
            .withColumn("capture_ts", F.col("capture_ts").cast("timestamp_ntz")))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly file listing: name, level, capture_ts, size, mtime."""
    cap = captures(spark, sf_dir)
    ts = F.col("capture_ts").cast("string")
    return (cap.groupBy("capture_ts").agg(F.count(F.lit(1)).alias("n"))
            .select(F.concat(F.lit("flights_hourly_"), F.substring(ts, 1, 10), F.lit("_"),
                             F.substring(ts, 12, 2), F.lit("00.parquet")).alias("name"),
                    F.lit("hourly").alias("level"), "capture_ts",
                    (F.col("n") * 37).alias("size"),
                    (F.col("capture_ts") + F.expr("INTERVAL 1 MINUTE")).alias("mtime")))


def files_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing of a pipeline that misses every fifth hour: input of the reports on missing slots."""
    return files(spark, sf_dir).where(F.hour("capture_ts") % 5 != 0)


def level_files(level: DataFrame, col: str, bytes_per_row: int = 41) -> DataFrame:
    """Listing of a daily or weekly level: one file per value of ``col``, with its own size."""
    return level.groupBy(col).agg((F.count(F.lit(1)) * bytes_per_row).alias("size"))


def weather_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    d = F.substring((F.col("o_orderdate") + F.expr("INTERVAL 25 YEAR")).cast("string"), 1, 10)
    suffix = F.when(k % 3 == 0, "_metar.txt").when(k % 3 == 1, "_geo.json").otherwise("T12:15.json")
    metar = (F.when(k % 50 == 0, F.lit("API endpoint has moved"))
             .when(k % 9 == 0, F.lit("METAR KMSP AUTO RMK AO2"))
             .otherwise(F.concat(F.lit("METAR KMSP AUTO RMK AO2 T"), F.when(k % 4 == 0, "1").otherwise("0"),
                                 F.lpad(_s(k % 400), 3, "0"), F.lit("1"), F.lpad(_s(k % 200), 3, "0"))))
    quote = F.when(k % 4 == 1, F.lit('"')).otherwise(F.lit(""))      # numbers as text are numbers too
    geo = (F.when(k % 40 == 0, F.lit("not json"))
           .otherwise(F.concat(F.lit('{"features":[{"properties":{"temp":'), quote, _s(k % 30), quote,
                               F.lit('}},{"properties":{}}]}'))))
    flat = (F.when(k % 2 == 0, F.concat(F.lit('{"temp_c":'), quote, _s(k % 25), F.lit(".5"), quote, F.lit("}")))
            .otherwise(F.concat(F.lit('[{"temp_c":'), _s(k % 25), F.lit('.5},{"x":1}]'))))
    content = F.when(k % 3 == 0, metar).when(k % 3 == 1, geo).otherwise(flat)
    return o.select("o_orderkey", F.concat(F.lit("wx/"), d, suffix).alias("name"), content.alias("content"))


def stats_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    doc = F.concat(
        F.lit('{"latest":{"start":'), _s(k * 60), F.lit(',"end":'), _s(k * 60),
        F.lit(',"local":{"modes":'), _s(k % 7), F.lit(',"accepted":['), _s(k % 5), F.lit(","), _s(k % 3),
        F.lit(']},"messages":0,"tracks":{"all":0}},"total":{"start":0,"end":'), _s(k * 60),
        F.lit(',"local":{},"messages":'), _s(k * 11), F.lit(',"tracks":{"all":'), _s(k),
        F.lit(',"single_message":1,"unreliable":2}}}'))
    return s.select("s_suppkey", doc.alias("doc"))

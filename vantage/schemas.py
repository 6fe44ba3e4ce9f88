"""Fixed schemas (no inference pass over the data)."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType)

AIRCRAFT = StructType([
    StructField("hex", StringType()), StructField("flight", StringType()), StructField("type", StringType()),
    StructField("lat", DoubleType()), StructField("lon", DoubleType()),
    StructField("alt_baro", StringType()), StructField("alt_geom", StringType()),
    StructField("baro_rate", IntegerType()), StructField("geom_rate", IntegerType()),
    StructField("gs", DoubleType()), StructField("track", DoubleType()),
    StructField("squawk", StringType()), StructField("emergency", StringType()), StructField("category", StringType()),
    StructField("nav_qnh", DoubleType()), StructField("nav_altitude_mcp", IntegerType()),
    StructField("nav_altitude_fms", IntegerType()), StructField("nav_heading", DoubleType()),
    StructField("nav_modes", ArrayType(StringType())),
    StructField("rssi", DoubleType()), StructField("messages", LongType()), StructField("seen", DoubleType()),
    StructField("seen_pos", DoubleType()),
    StructField("nic", IntegerType()), StructField("rc", IntegerType()), StructField("nic_baro", IntegerType()),
    StructField("nac_p", IntegerType()), StructField("nac_v", IntegerType()), StructField("sil", IntegerType()),
    StructField("sil_type", StringType()), StructField("gva", IntegerType()), StructField("sda", IntegerType()),
    StructField("version", IntegerType()),
])

SNAPSHOT = StructType([
    StructField("now", DoubleType()), StructField("messages", LongType()),
    StructField("aircraft", ArrayType(AIRCRAFT)),
])



def snapshot_schema(fields=None) -> StructType:
    """SNAPSHOT with the aircraft struct narrowed to ``fields`` (in schema order): the JSON
    parser then materialises only the columns a job uses."""
    if not fields:
        return SNAPSHOT
    keep = StructType([f for f in AIRCRAFT.fields if f.name in set(fields)])
    return StructType([StructField("now", DoubleType()), StructField("messages", LongType()),
                       StructField("aircraft", ArrayType(keep))])


_LOCAL = StructType([
    StructField("samples_processed", LongType()), StructField("samples_dropped", LongType()),
    StructField("modes", LongType()), StructField("bad", LongType()), StructField("unknown_icao", LongType()),
    StructField("accepted", ArrayType(LongType())), StructField("signal", DoubleType()),
    StructField("noise", DoubleType()), StructField("peak_signal", DoubleType()),
    StructField("strong_signals", IntegerType()), StructField("gain_db", DoubleType()),
])
_TRACKS = StructType([StructField("all", LongType()), StructField("single_message", LongType()),
                      StructField("unreliable", LongType())])
STATS_PERIOD = StructType([
    StructField("start", DoubleType()), StructField("end", DoubleType()), StructField("local", _LOCAL),
    StructField("messages", LongType()), StructField("tracks", _TRACKS),
])
# Periods of the receiver stats document (fixed values, in document order).
STATS_PERIODS = ["latest", "last1min", "last5min", "last15min", "total"]
STATS_DOC = StructType([StructField(p, STATS_PERIOD) for p in STATS_PERIODS])

AIRFRAME_RAW = StructType([
    StructField("icao", StringType()), StructField("reg", StringType()), StructField("icaotype", StringType()),
    StructField("year", StringType()), StructField("manufacturer", StringType()), StructField("model", StringType()),
    StructField("ownop", StringType()), StructField("faa_pia", BooleanType()), StructField("faa_ladd", BooleanType()),
    StructField("short_type", StringType()), StructField("mil", BooleanType()),
])

# Canonical observation model (36 columns) written by our sinks.
OBSERVATION = StructType([
    StructField("observation_time", TimestampNTZType()), StructField("observation_epoch", DoubleType()),
    StructField("hex", StringType()), StructField("flight", StringType()), StructField("type", StringType()),
    StructField("lat", DoubleType()), StructField("lon", DoubleType()),
    StructField("alt_baro", StringType()), StructField("alt_geom", StringType()),
    StructField("baro_rate", IntegerType()), StructField("geom_rate", IntegerType()),
    StructField("gs", DoubleType()), StructField("track", DoubleType()),
    StructField("squawk", StringType()), StructField("emergency", StringType()), StructField("category", StringType()),
    StructField("nav_qnh", DoubleType()), StructField("nav_altitude_mcp", IntegerType()),
    StructField("nav_altitude_fms", IntegerType()), StructField("nav_heading", DoubleType()),
    StructField("nav_modes", StringType()), StructField("rssi", DoubleType()), StructField("messages", LongType()),
    StructField("seen", DoubleType()), StructField("seen_pos", DoubleType()),
    StructField("nic", IntegerType()), StructField("rc", IntegerType()), StructField("nic_baro", IntegerType()),
    StructField("nac_p", IntegerType()), StructField("nac_v", IntegerType()), StructField("sil", IntegerType()),
    StructField("sil_type", StringType()), StructField("gva", IntegerType()), StructField("sda", IntegerType()),
    StructField("version", IntegerType()), StructField("source_file", StringType()),
])

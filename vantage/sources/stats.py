"""Receiver stats documents -> one row per present period (21-column table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.functions.columns import epoch_to_local, split_pair
from vantage.schemas import STATS_DOC, STATS_PERIODS


def read_receiver_stats(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.schema(STATS_DOC).option("multiLine", "true").json(path)
    return unpivot(df.select("*", F.col("_metadata.file_name").alias("source_file")))


def parse_stats_text(docs: DataFrame, text_col: str = "doc", file_col: str = "source_file") -> DataFrame:
    p = F.from_json(F.col(text_col), STATS_DOC)
    return unpivot(docs.select(p.alias("_d"), F.col(file_col).alias("source_file")).select("_d.*", "source_file"))


def unpivot(doc: DataFrame, tz: str = "UTC") -> DataFrame:
    """``inline`` over an array of (period, struct); periods missing from a document are skipped."""
    arr = F.array(*[F.struct(F.lit(p).alias("period"), F.col(p).alias("v")) for p in STATS_PERIODS])
    rows = doc.select("source_file", F.inline(arr)).where(F.col("v").isNotNull())
    v = F.col("v")
    return rows.select(
        epoch_to_local("v.end", tz).alias("observation_time"),
        F.col("v.end").alias("end_epoch"), "period", F.col("v.start").alias("start_epoch"),
        F.col("v.local.samples_processed").alias("samples_processed"), F.col("v.local.samples_dropped").alias("samples_dropped"),
        F.col("v.local.modes").alias("modes"), F.col("v.local.bad").alias("bad"), F.col("v.local.unknown_icao").alias("unknown_icao"),
        split_pair(F.col("v.local.accepted"), 0).alias("accepted_0"), split_pair(F.col("v.local.accepted"), 1).alias("accepted_1"),
        F.col("v.local.signal").alias("signal"), F.col("v.local.noise").alias("noise"), F.col("v.local.peak_signal").alias("peak_signal"),
        F.col("v.local.strong_signals").alias("strong_signals"), F.col("v.local.gain_db").alias("gain_db"),
        F.col("v.messages").alias("messages"), F.col("v.tracks.all").alias("tracks_all"),
        F.col("v.tracks.single_message").alias("tracks_single_message"), F.col("v.tracks.unreliable").alias("tracks_unreliable"),
        "source_file")

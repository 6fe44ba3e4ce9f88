"""Driver keys for the streaming operators (R1-R3), drained with ``availableNow`` and read
back from their sinks; the oracle is the equivalent batch statement."""

from __future__ import annotations

from pyspark.sql import functions as F

from vantage.operators.keyed import KeyedStore
from vantage.oracle import sql
from vantage.plans.catalog import register
from vantage.session import shared_dir, unique_name
from vantage.sources import fixtures as fx
from vantage.sources import snapshots as SN
from vantage.streaming import stream as ST


def _stream_obs(spark, sf):
    # a pattern that names one table, be it a file or a folder of files
    return fx.obs_from_events(ST.read_stream(spark, f"{sf.rstrip('/')}/events.parque[t]"))


def _folders(spark, name: str) -> tuple[str, str]:
    """A sink and a checkpoint of this query run."""
    base = shared_dir(spark, unique_name(name))
    return f"{base}/data", f"{base}/checkpoint"


@register("stream_capture", sql("""
SELECT * FROM obs WHERE lat IS NOT NULL AND lon IS NOT NULL AND gs IS NOT NULL AND track IS NOT NULL""", "obs"))
def _stream_capture(spark, sf):
    out = ST.run_append(ST.stream_capture(_stream_obs(spark, sf)), *_folders(spark, "stream_capture"))
    return spark.read.parquet(out)


@register("stream_dedup", sql("SELECT DISTINCT * EXCLUDE (capture_ts) FROM captures", "captures"))
def _stream_dedup(spark, sf):
    o = _stream_obs(spark, sf)
    hour = F.date_trunc("hour", "observation_time").cast("timestamp_ntz")
    # The captures of the fixture as a stream: each row delivered by its own hour's capture,
    # the next hour's, and (every 97th) a stale one 20 days later.
    copies = (o.withColumn("capture_ts", hour + F.expr("INTERVAL 1 HOUR"))
              .unionByName(o.withColumn("capture_ts", hour + F.expr("INTERVAL 2 HOUR")))
              .unionByName(o.where(F.col("event_id") % 97 == 0).withColumn("capture_ts", hour + F.expr("INTERVAL 480 HOUR"))))
    out = ST.run_append(ST.stream_dedup(copies).drop("capture_ts", "event_ts"), *_folders(spark, "stream_dedup"))
    return spark.read.parquet(out)


@register("stream_tumbling", sql("""
SELECT 'hour' AS grain, date_trunc('hour', observation_time) AS window_start,
 date_trunc('hour', observation_time) + INTERVAL 1 HOUR AS window_end, COUNT(*) AS observations FROM obs GROUP BY 2, 3
UNION ALL SELECT 'day', date_trunc('day', observation_time), date_trunc('day', observation_time) + INTERVAL 1 DAY, COUNT(*)
 FROM obs GROUP BY 2, 3
UNION ALL SELECT 'week', date_trunc('week', observation_time), date_trunc('week', observation_time) + INTERVAL 7 DAY, COUNT(*)
 FROM obs GROUP BY 2, 3""", "obs"))
def _stream_tumbling(spark, sf):
    sink = ST.run_update(ST.stream_tumbling(_stream_obs(spark, sf), "hour"), *_folders(spark, "stream_tumbling"))
    now = ST.rolled_up(ST.latest(spark.read.parquet(sink), ["window_start", "window_end"], ["observations"]))
    return now.select("grain", ST.ntz_of(F.col("window_start")).alias("window_start"),
                      ST.ntz_of(F.col("window_end")).alias("window_end"), "observations")


@register("stream_capture_counts", sql("""
WITH d AS (SELECT event_id % 101 <> 0 AS readable, lat IS NOT NULL AND lon IS NOT NULL AND gs IS NOT NULL AND track IS NOT NULL AS complete FROM obs)
SELECT COUNT(*) AS documents, COUNT(*) FILTER (NOT readable) AS unreadable, 2 * COUNT(*) FILTER (readable) AS collected,
 2 * COUNT(*) FILTER (readable) - COUNT(*) FILTER (readable AND complete) AS rejected, COUNT(*) FILTER (readable AND complete) AS kept FROM d""", "obs"))
def _stream_capture_counts(spark, sf):
    """Documents of two aircraft, the second of which is never complete; some arrive damaged."""
    o = fx.with_snapshot_fields(_stream_obs(spark, sf))
    docs = fx.docs_of(o.withColumn("damaged", F.col("event_id") % 101 == 0), "damaged")
    doc = F.when(F.col("damaged"), F.concat(F.lit("!"), F.col("doc"))).otherwise(F.col("doc"))
    parsed = SN.parse_snapshot_text(docs.withColumn("doc", doc))
    sink = ST.run_capture(parsed, *_folders(spark, "stream_counts"))
    return ST.capture_counts(spark, sink).agg(*[F.sum(n).alias(n) for n in ST.COUNT_NAMES])


@register("stream_redelivery", sql("SELECT DISTINCT * EXCLUDE (capture_ts) FROM captures", "captures"))
def _stream_redelivery(spark, sf):
    """The captures delivered in the order they were made, a quarter a batch.  The next hour's capture
    repeats each row; its copy 20 days later comes long after the stream's state is gone."""
    landing = shared_dir(spark, unique_name("redelivery"))
    captures = fx.captures(spark, sf)
    span = captures.agg(F.min("capture_ts").alias("a"), F.max("capture_ts").alias("b")).first()
    step = (span["b"] - span["a"]) / 4 if span["a"] is not None else None
    table, point = _folders(spark, "stream_redelivery")
    for k in range(4 if step is not None else 1):
        part = captures
        if step is not None:
            part = captures.where((F.col("capture_ts") >= span["a"] + k * step) if k else F.lit(True))
            part = part.where((F.col("capture_ts") < span["a"] + (k + 1) * step) if k < 3 else F.lit(True))
        part.write.mode("append").parquet(landing)
        ST.run_deduplicated(ST.read_stream(spark, landing).drop("capture_ts"), table, point)
    return KeyedStore(spark, table).rows()

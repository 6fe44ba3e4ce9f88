"""Structured Streaming.

The reference emulated a stream with cron jobs and overlapping captures; here the same
behaviour is a file-source stream:

R1  ingest + flatten + completeness filter, appended to a Parquet sink, with counters per batch
    (``observe``);
R2  duplicate removal on (hex, observation_epoch) with a 2-hour event-time watermark
    (``dropDuplicatesWithinWatermark``), the streaming form of the overlap dedup, and against the
    stored level for what comes later;
R3  tumbling hour / day / Monday-aligned week counts (``window``; all three from one stream of hours);
R4  idempotent upsert of each micro-batch into a keyed table (``foreachBatch`` + anti join).

Every runner takes its sink and its checkpoint folder: started again with the same two, it resumes
after the last committed batch.  On a cluster both belong on shared storage.  Event time is a
TIMESTAMP built from epoch microseconds (a watermark needs TIMESTAMP, and this keeps it independent
of the session time zone).  Runners drain what has arrived and return, so a scheduler may call them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vantage.operators import dedup as D
from vantage.operators.keyed import KeyedStore
from vantage.session import observed, path_exists
from vantage.sources.snapshots import flatten

WATERMARK = "2 hours"
# Tumbling windows (fixed values): name -> (duration, start offset).  The epoch began on a
# Thursday, so a 7-day window shifted by 4 days runs Monday..Sunday.
WINDOWS = {"hour": ("1 hour", None), "day": ("1 day", None), "week": ("7 days", "4 days")}


GRAIN_HOURS = {"hour": 1, "day": 24, "week": 168}

COUNT_NAMES = ["documents", "unreadable", "collected", "rejected", "kept"]
COUNTS = ", ".join(f"{n} bigint" for n in COUNT_NAMES)
BATCH_NAMES = ["read", "rejected", "repeated", "appended"]
BATCHES = ", ".join(f"{n} bigint" for n in BATCH_NAMES)
LATE = "batch_id bigint, late bigint"


def event_ts(epoch: str = "observation_epoch") -> Column:
    return F.timestamp_micros(F.round(F.col(epoch) * 1000000).cast("long"))


def ntz_of(ts: Column) -> Column:
    """TIMESTAMP instant -> UTC wall time as TIMESTAMP_NTZ (no session-zone dependence)."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def read_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, max_files: int | None = None,
                glob: str | None = None) -> DataFrame:
    """File-source stream over a directory (``glob`` selects file names); files must land
    under new names (a rewritten file is not re-read)."""
    if schema is None:
        schema = (spark.read.format(fmt).option("pathGlobFilter", glob).load(path) if glob
                  else spark.read.format(fmt).load(path)).schema
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def snapshot_stream(spark: SparkSession, landing: str, tz: str = "UTC", max_files: int | None = None) -> DataFrame:
    """R1 source: snapshot JSON files landing under unique names (e.g. ``capture=<ts>/history_17.json``),
    parsed with the fixed schema and flattened to observations (same code as the batch path)."""
    from vantage.schemas import snapshot_schema
    r = (spark.readStream.schema(snapshot_schema()).option("multiLine", "true").option("recursiveFileLookup", "true")
         .option("pathGlobFilter", "*.json"))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    raw = r.json(landing)
    return flatten(raw.select("*", F.col("_metadata.file_name").alias("source_file")), tz)


def run_append(df: DataFrame, sink: str, checkpoint: str, partition_cols=()) -> str:
    """Drain a stream into a Parquet folder (exactly-once file sink)."""
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", sink))
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.trigger(availableNow=True).start().awaitTermination()
    return sink


def run_update(df: DataFrame, sink: str, checkpoint: str) -> str:
    """Drain an aggregating stream in update mode: each batch writes the groups that it changed
    under its own ``batch_id``, so a replayed batch replaces its own rows only and readers never
    meet a half-written result.  ``latest`` reads the current state."""

    def write(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    (df.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
       .foreachBatch(write).trigger(availableNow=True).start().awaitTermination())
    return sink


def latest(updates: DataFrame, keys, values) -> DataFrame:
    """The last written values of each group of ``run_update``'s sink."""
    newest = F.max_by(F.struct(*values), "batch_id").alias("v")
    return updates.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"v.{v}").alias(v) for v in values])


def stream_capture(stream_obs: DataFrame, cols=("lat", "lon", "gs", "track")) -> DataFrame:
    """Completeness filter on the stream (stateless, append)."""
    return stream_obs.dropna(subset=list(cols))


def stream_dedup(stream_obs: DataFrame, keys=D.OBS_KEY, delay: str = WATERMARK) -> DataFrame:
    """R2: drop repeats of a key delivered within ``delay`` of event time."""
    return (stream_obs.withColumn("event_ts", event_ts())
            .withWatermark("event_ts", delay).dropDuplicatesWithinWatermark(list(keys)))


def stream_tumbling(stream_obs: DataFrame, grain: str, delay: str = WATERMARK) -> DataFrame:
    """Rows per tumbling window of the given grain; windows older than the watermark leave the
    state."""
    dur, start = WINDOWS[grain]
    w = F.window("event_ts", dur, startTime=start) if start else F.window("event_ts", dur)
    return (stream_obs.withColumn("event_ts", event_ts()).withWatermark("event_ts", delay)
            .groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("observations"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "observations"))


def rolled_up(hours: DataFrame) -> DataFrame:
    """R3 for all grains from one stream: hour counts (``latest`` of the hour grain's sink) as they
    are, and summed to days and to weeks, whose windows are whole hours."""
    grains = F.array(*[F.struct(F.lit(g).alias("grain"), _window_start(F.col("window_start"), g).alias("s"), F.lit(n).alias("hours"))
                       for g, n in GRAIN_HOURS.items()])
    rows = hours.select(F.explode(grains).alias("g"), "observations")
    return (rows.groupBy("g.grain", "g.s", "g.hours").agg(F.sum("observations").alias("observations"))
            .select("grain", F.col("s").alias("window_start"),
                    F.timestamp_add("HOUR", F.col("hours"), F.col("s")).alias("window_end"), "observations"))


def _window_start(hour: Column, grain: str) -> Column:
    """Start of the window of ``grain`` that holds the (UTC) hour."""
    seconds = GRAIN_HOURS[grain] * 3600
    offset = 4 * 86400 if grain == "week" else 0        # the epoch began on a Thursday
    return F.timestamp_seconds(F.floor((F.unix_seconds(hour) - offset) / seconds) * seconds + offset)


def run_capture(documents: DataFrame, sink: str, checkpoint: str, tz: str = "UTC", cols=("lat", "lon", "gs", "track")) -> str:
    """R1 with its counters: a stream of parsed snapshots (as ``read_snapshots`` gives them) is
    flattened and filtered batch by batch.  Each batch writes ``<sink>/batch_id=..`` and, observed in
    the same pass, its counters to ``<sink>/_counts``: documents, those that could not be read, rows
    collected, rejected (incomplete) and kept.  A replayed batch replaces its own files."""
    spark = documents.sparkSession

    def write(batch: DataFrame, batch_id: int):
        docs, rows = Observation(), Observation()
        unreadable = F.col("now").isNull() | F.col("aircraft").isNull()
        read = batch.observe(docs, F.count(F.lit(1)).alias("documents"), F.count_if(unreadable).alias("unreadable"))
        ok = F.lit(True)
        for c in cols:
            ok = ok & F.col(c).isNotNull()
        flat = flatten(read, tz).observe(rows, F.count(F.lit(1)).alias("collected"), F.count_if(~ok).alias("rejected"))
        flat.where(ok).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
        n = {**dict.fromkeys(COUNT_NAMES, 0), **observed(docs), **observed(rows)}
        n["kept"] = n["collected"] - n["rejected"]
        row = tuple(n[c] for c in COUNT_NAMES)
        spark.createDataFrame([row], COUNTS).coalesce(1).write.mode("overwrite").parquet(f"{sink}/_counts/batch_id={batch_id}")

    (documents.writeStream.option("checkpointLocation", checkpoint)
     .foreachBatch(write).trigger(availableNow=True).start().awaitTermination())
    return sink


def capture_counts(spark: SparkSession, sink: str) -> DataFrame:
    """(batch_id, documents, unreadable, collected, rejected, kept) of ``run_capture``."""
    return spark.read.schema(f"{COUNTS}, batch_id bigint").parquet(f"{sink}/_counts").select("batch_id", *COUNT_NAMES)


def upsert_batches(stream_obs: DataFrame, table_path: str, checkpoint: str, keys=D.OBS_KEY,
                   order=("source_file",), epoch: str = "observation_epoch", drop=()) -> str:
    """Insert-or-ignore every micro-batch into the keyed table at ``table_path``, made where there
    is none.  A batch reads the stored keys of its own periods only and leaves them where they lie.
    Rows with a NULL key part are kept with the rejects.  Each batch's counts go to ``_batches``.  A
    replayed batch finds its keys present and appends nothing, so the sink stays exactly-once.

    ``drop`` names columns that only the stream needs.  Where the stream holds state, the rows that
    its watermark refused are counted too (``late``)."""
    spark = stream_obs.sparkSession
    schema = stream_obs.drop(*drop).schema
    store = KeyedStore(spark, table_path, schema, keys, epoch)

    def upsert(batch: DataFrame, batch_id: int):
        rows = batch.drop(*drop).persist()
        try:
            n = store.append(rows, order, batch_id=str(batch_id))
        finally:
            rows.unpersist()
        row = (n["read"], n["rejected"], n["repeated"], n["appended"])
        spark.createDataFrame([row], BATCHES).coalesce(1).write.mode("overwrite").parquet(f"{table_path}/_batches/batch_id={batch_id}")

    query = (stream_obs.writeStream.option("checkpointLocation", checkpoint)
             .foreachBatch(upsert).trigger(availableNow=True).start())
    query.awaitTermination()
    late = [(int(p["batchId"]), int(sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"])))
            for p in query.recentProgress if p["stateOperators"]]
    if late:
        spark.createDataFrame(late, LATE).coalesce(1).write.mode("append").parquet(f"{table_path}/_late")
    store.close()
    return table_path


def run_deduplicated(stream_obs: DataFrame, table_path: str, checkpoint: str, keys=D.OBS_KEY, order=("source_file",),
                     delay: str = WATERMARK) -> str:
    """R2 against the stored level: repeats inside the watermark fall in the stream's state; what
    comes again after its state is gone, or in another run, falls in the anti join with the stored
    keys; rows that the watermark refuses are counted (``late_rows``)."""
    return upsert_batches(stream_dedup(stream_obs, keys, delay), table_path, checkpoint, keys, order, drop=("event_ts",))


def batch_counts(spark: SparkSession, table_path: str) -> DataFrame:
    """(batch_id, read, rejected, repeated, appended) of ``upsert_batches``."""
    return spark.read.schema(f"{BATCHES}, batch_id bigint").parquet(f"{table_path}/_batches").select("batch_id", *BATCH_NAMES)


def late_rows(spark: SparkSession, table_path: str) -> DataFrame:
    """(batch_id, late): rows that arrived behind the watermark and were refused."""
    if not path_exists(spark, f"{table_path}/_late"):
        return spark.createDataFrame([], LATE)
    return spark.read.schema(LATE).parquet(f"{table_path}/_late").groupBy("batch_id").agg(F.max("late").alias("late"))

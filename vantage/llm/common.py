"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.session import shared_dir, unique_name

# One Arrow batch carries at most this much text to a Python worker.
BATCH_BYTES = 8 * 1024 * 1024


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*cols) if cols else df


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, so a worker's memory does not follow the length of the texts.
    Tightens the session's setting, never loosens it."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = str(spark.conf.get(key, "64m")).lower()
    unit = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    digits, suffix = now.rstrip("bkmg"), now[len(now.rstrip("bkmg")):].rstrip("b") or "b"
    if int(digits) * unit[suffix] > BATCH_BYTES or int(digits) <= 0:
        spark.conf.set(key, str(BATCH_BYTES))


def give_back() -> None:
    """Hand freed memory of this worker back to the system.  The allocators keep it for later, batch after
    batch and in the idle worker too, where it counts as the executor's and nobody else can have it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # not in every C library
    if trim is not None:
        trim(0)


def text_bytes(col: str = "text") -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(col), F.lit("")).cast("binary")


def id_remainder(mod: int, col: str = "doc_id") -> Column:
    """crc32 of the identifier's decimal text, modulo ``mod`` (a null identifier reads as '')."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % mod


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int, max_bytes: int, per_label: bool = False,
                    text: str = "text", label: str = "label", key: str = "doc_id") -> list:
    """About ``max_rows`` rows (t, y) of labelled texts, or as many of each label, on the driver.

    Labels are chosen by a hash of ``key`` against the share that is wanted, at most twice as many;
    they are few, so they are broadcast and the texts are read without a shuffle.  Only texts of at
    most ``max_bytes`` count."""
    known = labels.where(F.col(label).isNotNull()).select(F.col(key).alias("k"), F.col(label).cast("int").alias("y"))
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not per_label:
        totals = {y: sum(totals.values()) for y in totals}
    slot = F.pmod(F.xxhash64("k"), F.lit(1 << 30))
    wanted = F.lit(False)
    for y, n in totals.items():
        wanted = wanted | ((F.col("y") == y) & (slot < int((1 << 30) * min(1.0, max_rows / n))))
    most = 2 * max_rows * (len(totals) or 1) if per_label else 2 * max_rows
    chosen = known.where(wanted).limit(most)
    texts = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    found = (texts.where(F.octet_length("t") <= max_bytes).join(F.broadcast(chosen), "k")
             .select(F.xxhash64("k").alias("h"), "t", "y").limit(most).collect())
    return sorted(found, key=lambda r: (r["h"], r["t"]))


HOT_KEYS = 50_000


def join_unique(rows: DataFrame, entries: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of their entry; ``entries`` has each ``key`` once.

    Keys of very many rows would each be one task of the join.  They are counted, by partial sums,
    and their entries broadcast: as all counts add up to the number of rows, at most HOT_KEYS keys
    lie above the bound.  All others are joined by key.  ``rows`` is read four times."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    bound = max(64, rows.count() // HOT_KEYS)
    hot = counts.where(F.col("_n") > bound).select(F.col(key).alias("_h"), F.lit(True).alias("_hot"))
    entries = entries.withColumnRenamed(key, "_e")
    marked = rows.join(F.broadcast(hot), F.col(key) == F.col("_h"), "left")
    few = entries.join(F.broadcast(hot), F.col("_e") == F.col("_h"), "left_semi")
    same = F.col(key) == F.col("_e")
    found = marked.where("_hot").join(F.broadcast(few), same)
    rest = marked.where("_hot IS NULL").join(entries, same)
    return found.drop("_h", "_hot", "_e").unionByName(rest.drop("_h", "_hot", "_e"))


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that does not clash with those of ``df``."""
    taken = {c.lower() for c in df.columns}
    name = f"_{base}"
    while name.lower() in taken:
        name = "_" + name
    return name


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return shared_dir(spark, unique_name(f"llm-{name}"))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and computes it once;
    the files outlive any executor."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

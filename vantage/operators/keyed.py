"""Keyed tables (K3, K4, J6, R4): insert or ignore into a table that is bucketed and sorted by key.

A stored row carries two more columns: ``row_key``, the key parts as one text, by which the table is
bucketed and sorted, and ``key_period``, the time part of the key in whole periods (days), by which it
is partitioned.  A key holds its time, so a row can only repeat one of its own period:

* the periods of a batch, read from the batch itself, prune the table before the join; history
  outside them is neither listed nor read;
* the batch is shuffled once, to the table's buckets; the table is read where it lies, its key column
  alone.  The same shuffle serves the choice of the first row per key.

Rows with a NULL key part are rejected: counted, and kept beside the table with the part that is
missing.  The settings (keys, buckets, period) are stored with the table; one that is there is opened
with its own.  Appending a batch again changes nothing.  One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vantage.operators.dedup import OBS_KEY, dedup
from vantage.session import observed, path_exists, unique_name

SETTINGS = "row_keys string, epoch string, period_seconds int, buckets int, columns string"
#: above so many periods a batch prunes the table by their range instead of one by one
LISTED_PERIODS = 1000


def missing_part(keys) -> Column:
    """Name of the first key part that is NULL, NULL where none is."""
    return F.coalesce(*[F.when(F.col(k).isNull(), F.lit(k)) for k in keys])


def row_key(keys) -> Column:
    """The key parts as one text, each behind its length, so that different keys differ."""
    texts = [F.col(k).cast("string") for k in keys]
    return F.concat(*[F.concat(F.char_length(t).cast("string"), F.lit(":"), t) for t in texts])


class KeyedStore:
    """The table at ``path``, a folder that all machines see; made where there is none (``schema``: of
    the rows it will hold)."""

    def __init__(self, spark: SparkSession, path: str, schema=None, keys=OBS_KEY, epoch: str = "observation_epoch",
                 buckets: int | None = None, period_seconds: int = 86400):
        self.spark, self.path = spark, path.rstrip("/")
        if path_exists(spark, f"{self.path}/_settings"):
            found = spark.read.schema(SETTINGS).parquet(f"{self.path}/_settings").first()
            self.keys, self.epoch = tuple(found["row_keys"].split(",")), found["epoch"]
            self.period_seconds, self.buckets, self.columns = found["period_seconds"], found["buckets"], found["columns"]
        else:
            if schema is None:
                raise ValueError(f"no table at {path}: a schema is needed to make one")
            self.keys, self.epoch, self.period_seconds = tuple(keys), epoch, period_seconds
            self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            self.columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            row = (",".join(self.keys), self.epoch, self.period_seconds, self.buckets, self.columns)
            spark.createDataFrame([row], SETTINGS).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_settings")
        self.table = unique_name("keyed").replace("-", "_")
        spark.sql(f"CREATE TABLE {self.table} ({self.columns}, row_key string, key_period bigint) USING parquet "
                  f"PARTITIONED BY (key_period) CLUSTERED BY (row_key) SORTED BY (row_key) INTO {self.buckets} BUCKETS "
                  f"LOCATION '{self.path}'")
        spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")

    def rows(self) -> DataFrame:
        """All rows, as they were appended."""
        return self.spark.table(self.table).drop("row_key", "key_period")

    def rejects(self) -> DataFrame:
        """Rejected rows with their ``missing_part`` and the ``batch_id`` they came in."""
        path = f"{self.path}/_rejects"
        schema = f"{self.columns}, missing_part string, batch_id string"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def _period(self) -> Column:
        return F.floor(F.col(self.epoch) / self.period_seconds)

    def _pruned(self, batch: DataFrame) -> DataFrame:
        """The stored keys of the periods that ``batch`` touches."""
        target = self.spark.table(self.table)
        found = (batch.where(missing_part(self.keys).isNull()).select(self._period().alias("p")).distinct()
                 .orderBy("p").limit(LISTED_PERIODS + 1).collect())
        if len(found) <= LISTED_PERIODS:
            return target.where(F.col("key_period").isin([r["p"] for r in found])).select("row_key")
        span = batch.where(missing_part(self.keys).isNull()).agg(F.min(self._period()).alias("a"), F.max(self._period()).alias("b")).first()
        return target.where(F.col("key_period").between(span["a"], span["b"])).select("row_key")

    def _fresh(self, batch: DataFrame, order) -> DataFrame:
        keyed = (batch.where(missing_part(self.keys).isNull())
                 .withColumn("row_key", row_key(self.keys)).withColumn("key_period", self._period()))
        first = dedup(keyed.repartition(self.buckets, "row_key"), ("row_key",), order)
        return first.join(self._pruned(batch).hint("merge"), "row_key", "left_anti")

    def new_rows(self, batch: DataFrame, order=("source_file",)) -> DataFrame:
        """Rows of ``batch`` that ``append`` would add: the first per key (``order``: load order) of
        the keys that are not stored yet."""
        return self._fresh(batch, order).select(*[F.col(f"`{c}`") for c in batch.columns])

    def append(self, batch: DataFrame, order=("source_file",), batch_id: str = "0") -> dict:
        """Add the new rows, keep the rejected ones under ``batch_id`` and return the counts ``read``,
        ``rejected``, ``repeated`` and ``appended``."""
        spark = self.spark
        names = [n.strip("`") for n in (c.split(" ")[0] for c in self.columns.split(", `"))]
        rejected = batch.withColumn("missing_part", missing_part(self.keys)).where("missing_part IS NOT NULL")
        kept = Observation()
        (rejected.observe(kept, F.count(F.lit(1)).alias("n")).select(*[F.col(f"`{n}`") for n in names], "missing_part")
            .write.mode("overwrite").parquet(f"{self.path}/_rejects/batch_id={batch_id}"))
        read, added = Observation(), Observation()
        fresh = self._fresh(batch.observe(read, F.count(F.lit(1)).alias("n")), order)
        (fresh.observe(added, F.count(F.lit(1)).alias("n")).select(*[F.col(f"`{n}`") for n in names], "row_key", "key_period")
            .write.format("parquet").mode("append").partitionBy("key_period").bucketBy(self.buckets, "row_key")
            .sortBy("row_key").option("path", self.path).saveAsTable(self.table))
        spark.catalog.refreshTable(self.table)
        n, out, new = (observed(m).get("n", 0) for m in (read, kept, added))
        return {"read": n, "rejected": out, "repeated": n - out - new, "appended": new}

    def close(self) -> None:
        """Forget the table's name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


"""Exact deduplication against a persistent digest index (operator 4; DataFrame functions only).

The index is a table of SHA-256 digests bucketed and sorted by digest; its number of buckets is
stored with it and holds for every session.  A batch is reduced to one row per digest, kept apart from
the index by a sort-merge anti join that leaves the index where it lies, and what is new is appended;
the texts themselves are shuffled by no query here but ``deduplicated``.  Adding a batch again changes
nothing, so a job that died may be run again.  Digests of very many rows are joined by broadcast
(``common.join_unique``), so none is one task.

Among equal texts of a batch the row with the largest ``doc_id`` stays; a text that was indexed
before has no row that stays.  Defined cases: null text counts as empty; a null ``doc_id`` is
smaller than any other; of rows that repeat both text and ``doc_id`` one stays; ``group_size``
counts rows; an empty batch adds nothing; other columns, whatever their names, are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vantage.llm.common import fresh_name, join_unique, scratch, stage, unique_name
from vantage.session import path_exists

SCHEMA = "digest BINARY, keep_id BIGINT, group_size BIGINT, batch BIGINT"


def text_digest(text: str = "text") -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


class DigestIndex:
    """The index stored at ``path``, a folder that all machines see; made where there is none, with
    ``buckets`` (by default as many as the session's shuffle partitions).  One that is there keeps its
    own number; asking for another is refused."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path
        if path_exists(spark, f"{path}/_settings"):
            self.buckets = spark.read.schema("buckets int").parquet(f"{path}/_settings").first()["buckets"]
            if buckets not in (None, self.buckets):
                raise ValueError(f"the index at {path} has {self.buckets} buckets, not {buckets}")
        else:
            self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.createDataFrame([(self.buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(f"{path}/_settings")
        self.table = unique_name("digest_index").replace("-", "_")
        spark.sql(f"CREATE TABLE {self.table} ({SCHEMA}) USING parquet CLUSTERED BY (digest) "
                  f"SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'")

    def entries(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, rows: DataFrame, batch: int) -> None:
        """Append the digests that are not in the index yet.  ``rows``: digest, doc_id, n."""
        groups = rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))
        placed = groups.repartition(self.buckets, "digest")
        known = self.entries().select(F.col("digest").alias("d"))
        # the second condition keeps the join above the sums: below them every row would be shuffled
        new = placed.join(known.hint("merge"), (F.col("digest") == F.col("d")) & (F.col("group_size") > 0), "left_anti")
        (new.select("digest", "keep_id", "group_size", F.lit(batch).cast("long").alias("batch"))
            .write.format("parquet").mode("append").bucketBy(self.buckets, "digest").sortBy("digest")
            .option("path", self.path).saveAsTable(self.table))
        self.spark.catalog.refreshTable(self.table)

    def verdicts(self, rows: DataFrame, batch: int) -> DataFrame:
        """Per distinct (digest, doc_id) of an added batch: keep_id, group_size, stays (one of its
        ``n`` rows stays)."""
        joined = join_unique(rows, self.spark.read.schema(SCHEMA).parquet(self.path), "digest")
        here = F.col("batch") == F.lit(batch)
        return joined.select("digest", "doc_id", "n", "keep_id", "group_size",
                             (here & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("stays"))

    def close(self) -> None:
        """Forget the table's name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def digest_rows(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per distinct (digest, doc_id) with its number of rows: equal texts of one batch are
    spread by ``doc_id`` before they are brought together by partial sums."""
    return (df.select(text_digest(text).alias("digest"), F.col(doc_id).cast("long").alias("doc_id"))
              .groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("n")))


def _each_row(verdicts: DataFrame) -> DataFrame:
    return (verdicts.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
                    .select("doc_id", "keep_id", "group_size", (F.col("stays") & (F.col("_k") == 1)).alias("kept"),
                            F.lower(F.hex("digest")).alias("text_sha256")))


def mark_duplicates(df: DataFrame, index: DigestIndex, batch: int = 0, text: str = "text",
                    doc_id: str = "doc_id") -> DataFrame:
    """Add a batch and return one row per row of it: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = stage(digest_rows(df, text, doc_id), "digest-rows")
    index.add(rows, batch)
    return _each_row(index.verdicts(rows, batch))


def mark_in_batches(df: DataFrame, index: DigestIndex, batches: int = 2, text: str = "text",
                    doc_id: str = "doc_id") -> DataFrame:
    """``mark_duplicates`` of a table that comes in ``batches``, by falling ranges of ``doc_id``: the
    first batch that holds a text holds its largest id, later copies fall in the anti join.  Group
    sizes are added up over all batches."""
    rows = stage(digest_rows(df, text, doc_id), "digest-rows")
    span = rows.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).first()
    low, high = span["a"] or 0, span["b"] or 0
    edges = [high - (high - low + 1) * k // batches for k in range(1, batches)]
    for b in range(batches):
        part = rows
        if b:
            part = part.where(F.coalesce(F.col("doc_id") <= edges[b - 1], F.lit(True)))
        if b < batches - 1:
            part = part.where(F.col("doc_id") > edges[b])
        index.add(part, b)
    sizes = rows.groupBy("digest").agg(F.sum("n").alias("group_size"))
    entries = index.spark.read.schema(SCHEMA).parquet(index.path).select("digest", "keep_id").join(sizes, "digest")
    joined = join_unique(rows, entries, "digest")
    return _each_row(joined.withColumn("stays", F.col("doc_id").eqNullSafe(F.col("keep_id"))))


def deduplicated(df: DataFrame, index: DigestIndex, batch: int = 0, text: str = "text",
                 doc_id: str = "doc_id") -> DataFrame:
    """Add a batch and return those of its rows that stay, all columns as they were."""
    rows = stage(digest_rows(df, text, doc_id), "digest-rows")
    index.add(rows, batch)
    key, rank, d, i = (fresh_name(df, x) for x in ("digest", "rank", "stay_digest", "stay_id"))
    stays = index.verdicts(rows, batch).where("stays").select(F.col("digest").alias(d), F.col("doc_id").alias(i))
    keyed = df.withColumn(key, text_digest(text))
    kept = keyed.join(stays, (F.col(key) == F.col(d)) & F.col(doc_id).eqNullSafe(F.col(i)), "left_semi")
    one = Window.partitionBy(key, doc_id).orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    return kept.withColumn(rank, F.row_number().over(one)).where(F.col(rank) == 1).drop(key, rank)


def fresh_index(spark: SparkSession) -> DigestIndex:
    """An empty index in a new folder under the shared checkpoint folder."""
    return DigestIndex(spark, scratch(spark, "digests"))

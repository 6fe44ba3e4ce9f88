"""Reversible line deduplication: sharded cuckoo filters over exact reference counts (operator 11).

The index is a folder that all machines see:

    refs      (digest, doc_id): one reference per document and distinct line key, a folder an addition
    gone      references that a deletion took back, a folder a deletion
    counts    (shard, digest, n_docs, keep_id): the exact reference counts, a folder a version
    filters   (shard, items, slots): one cuckoo filter a shard, of the keys that ``min_docs`` documents
              or more hold, a folder a version
    commits   one row a version with the settings; a version without its row does not count

Adding documents raises counts, and keys that reach ``min_docs`` enter their shard's filter; removing
documents lowers them again, and keys that fall below leave it: the index is then as if those documents
had never come.  ``clean`` probes the lines of documents against the filters; only the few that hit are
compared with the exact counts, so false hits of a filter cost a look-up and change no result.

A key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z in lower case; keys shorter than
``min_chars`` code points are never counted.  Of a key that ``min_docs`` documents hold only the
lines of the document with the largest ``doc_id`` stay.

Skew: references are unique per (key, document) and counted by partial sums, so a key that a third of
all documents holds is spread; the few keys with more references than a bound that grows with their
total are broadcast (their number is at most HOT_KEYS), the others joined by digest.

Defined cases: null or empty text is one empty line; rows of one ``doc_id`` are one document (a null
one is an id smaller than any); adding a document again changes nothing, removing one that is not
there neither; repeated rows are all returned; an empty table adds nothing and cleans to nothing;
other columns, whatever their names, are left alone.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.llm.common import fresh_name, scratch, small_batches, stage
from vantage.llm.cuckoo import CuckooFilter

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\x0c\r"
HOT_KEYS = 50_000
#: filters up to this many bytes in all are sent to every task; larger ones stay in their shards
SENT_BYTES = 32 * 1024 * 1024
#: a shard is split when it holds more keys than this on average
SHARD_KEYS = 1_000_000
#: lines that meet their shard's filter in one group
GROUP_LINES = 1_000_000

REFS = "digest binary, doc_id bigint"
COUNTS = "shard int, digest binary, n_docs bigint, keep_id bigint"
FILTERS = "shard int, items bigint, slots binary"
COMMITS = "version bigint, shards int, min_docs int, min_chars int, kind string"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def bare(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def line_key(line: Column) -> Column:
    return F.translate(bare(line), UPPER, LOWER)


def key_digest(key: Column) -> Column:
    """The first 16 bytes of the key's SHA-256."""
    return F.substring(F.unhex(F.sha2(key.cast("binary"), 256)), 1, 16)


def hashes_of(digests) -> np.ndarray:
    """The first 8 bytes of each digest of an Arrow column or a list as a number."""
    data = digests.to_pylist() if hasattr(digests, "to_pylist") else list(digests)
    return np.frombuffer(b"".join(data), dtype="<u8")[::2] if data else np.zeros(0, dtype="<u8")


def _shard(shards: int) -> Column:
    """The last 4 bytes of the digest, as a number, modulo ``shards``."""
    return F.pmod(F.conv(F.hex(F.substring("digest", 13, 4)), 16, 10).cast("long"), F.lit(shards)).cast("int")


def shards_of(digests, shards: int) -> np.ndarray:
    """``_shard`` of an Arrow column of digests."""
    data = digests.to_pylist()
    return (np.frombuffer(b"".join(data), dtype=">u4")[3::4] % shards).astype(np.int64) if data else np.zeros(0, dtype=np.int64)


def build_filter(pdf: pd.DataFrame) -> pd.DataFrame:
    """The filter of one shard from all its keys."""
    hashes, room = hashes_of(pdf["digest"]), max(64, 2 * len(pdf))
    while True:
        made = CuckooFilter.sized(room)
        if made.insert(hashes):
            return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "items": [len(hashes)], "slots": [made.to_bytes()]})
        room *= 2


def change_filter(old: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
    """The filter of one shard after keys left and entered; no slots where it has become too full."""
    if len(old):
        now = CuckooFilter.from_bytes(old["slots"].iloc[0])
        items, shard = int(old["items"].iloc[0]), old["shard"].iloc[0]
    else:
        now, items, shard = CuckooFilter.sized(max(64, 2 * len(changes))), 0, changes["shard"].iloc[0]
    enters = changes["enters"].to_numpy(dtype=bool)
    now.remove(hashes_of(changes["digest"][~enters]))
    fits = now.insert(hashes_of(changes["digest"][enters]))
    items += int(enters.sum()) - int((~enters).sum())
    return pd.DataFrame({"shard": [shard], "items": [items], "slots": [now.to_bytes() if fits else None]})


class LineIndex:
    """The index at ``path``.  One that is there keeps the settings it was made with."""

    def __init__(self, spark: SparkSession, path: str, min_docs: int = 3, min_chars: int = 20, shards: int = 64):
        self.spark, self.path = spark, path
        small_batches(spark)
        # the newest committed version names the settings; none is there before the first addition
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/commits")
        there = at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
        found = spark.read.schema(COMMITS).parquet(f"{path}/commits").orderBy("version").collect() if there else []
        self.commits = [(r["version"], r["kind"]) for r in found]
        self.version = found[-1]["version"] if found else 0
        self.shards = found[-1]["shards"] if found else shards
        self.min_docs = found[-1]["min_docs"] if found else min_docs
        self.min_chars = found[-1]["min_chars"] if found else min_chars

    def _read(self, name: str, schema: str, *versions: int) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{name}/{v}" for v in versions])

    def counts(self) -> DataFrame:
        return self._read("counts", COUNTS, *([self.version] if self.version else []))

    def filters(self) -> DataFrame:
        return self._read("filters", FILTERS, *([self.version] if self.version else []))

    def references(self) -> DataFrame:
        """The (digest, doc_id) that stand: added and not taken back since."""
        if all(kind == "add" for _, kind in self.commits):
            return self._read("refs", REFS, *[v for v, _ in self.commits])
        events = None
        for v, kind in self.commits:
            name = "refs" if kind == "add" else "gone"
            one = self._read(name, REFS, v).withColumn("v", F.lit(v)).withColumn("there", F.lit(kind == "add"))
            events = one if events is None else events.unionByName(one)
        last = events.groupBy("digest", "doc_id").agg(F.max_by("there", "v").alias("there"))
        return last.where("there").select("digest", "doc_id")

    def _lines(self, docs: DataFrame, text: str, doc_id: str) -> DataFrame:
        """(digest, doc_id, place) of the lines that count; ``same`` tells rows of one id apart."""
        # the text itself must not be copied to each of its lines
        base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("same"),
                           lines_of(F.col(text)).alias("lines"))
        lines = base.select("doc_id", "same", F.posexplode("lines").alias("place", "line"))
        # lower case changes no length, so it is made only of the lines that count
        return lines.where(F.char_length(bare(F.col("line"))) >= self.min_chars).select(
            key_digest(line_key(F.col("line"))).alias("digest"), "doc_id", "same", "place")

    def add(self, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> "LineIndex":
        """Count the lines of ``docs``."""
        refs = self._lines(docs, text, doc_id).select("digest", "doc_id").distinct()
        if self.version:
            known = self.references().select(F.col("digest").alias("d"), F.col("doc_id").alias("i"))
            refs = refs.join(known, (F.col("digest") == F.col("d")) & F.col("doc_id").eqNullSafe(F.col("i")), "left_anti")
        v = self.version + 1
        refs.write.mode("overwrite").parquet(f"{self.path}/refs/{v}")
        new = self._read("refs", REFS, v)
        delta = new.groupBy("digest").agg(F.count(F.lit(1)).alias("more"), F.max("doc_id").alias("newest"))
        both = self.counts().withColumnRenamed("digest", "d").join(delta, F.col("d") == F.col("digest"), "full")
        before = F.coalesce("n_docs", F.lit(0))
        return self._commit("add", both.select(
            F.coalesce("digest", "d").alias("digest"), before.alias("before"),
            (before + F.coalesce("more", F.lit(0))).alias("n_docs"),
            F.greatest("keep_id", "newest").alias("keep_id")))          # skips nulls

    def remove(self, ids: DataFrame, doc_id: str = "doc_id") -> "LineIndex":
        """Take the documents of ``ids`` back."""
        if not self.version:
            return self
        standing = self.references()
        out = ids.select(F.col(doc_id).cast("long").alias("i")).distinct()
        mine = F.col("doc_id").eqNullSafe(F.col("i"))
        v = self.version + 1
        standing.join(out, mine, "left_semi").write.mode("overwrite").parquet(f"{self.path}/gone/{v}")
        less = (self._read("gone", REFS, v).groupBy("digest")
                .agg(F.count(F.lit(1)).alias("less"), F.max("doc_id").alias("latest_gone"))
                .withColumnRenamed("digest", "d"))
        lowered = (self.counts().join(less, F.col("digest") == F.col("d"), "left")
                   .select("digest", F.col("n_docs").alias("before"), (F.col("n_docs") - F.coalesce("less", F.lit(0))).alias("n_docs"),
                           "keep_id", (F.col("d").isNotNull() & F.col("keep_id").eqNullSafe(F.col("latest_gone"))).alias("open"))
                   .where("n_docs > 0"))
        # the largest id of the keys that lost theirs, from the references that stay
        headless = lowered.where("open").select("digest", "n_docs")
        stay = standing.join(out, mine, "left_anti")
        heads = (self._with_entries(stay, headless, "n_docs").groupBy("digest")
                 .agg(F.max("doc_id").alias("head")).withColumnRenamed("digest", "h"))
        return self._commit("remove", lowered.join(heads, F.col("digest") == F.col("h"), "left").select(
            "digest", "before", "n_docs", F.when(F.col("open"), F.col("head")).otherwise(F.col("keep_id")).alias("keep_id")))

    def _commit(self, kind: str, counts: DataFrame) -> "LineIndex":
        """Write the counts (with those ``before``) and the filters of a new version, then its row."""
        v = self.version + 1
        path = f"{self.path}/counts/{v}"
        counts.select(_shard(self.shards).alias("shard"), "digest", "n_docs", "keep_id", "before").write.mode("overwrite").parquet(path)
        now = self.spark.read.schema(COUNTS + ", before bigint").parquet(path)
        shards = self.shards
        held = F.col("n_docs") >= self.min_docs
        active = now.where(held).count()
        while active > shards * SHARD_KEYS:
            shards *= 2
        if shards == self.shards and self.version:
            changes = now.where(held != (F.col("before") >= self.min_docs))
            fallen = self.counts().where(held).join(now.select(F.col("digest").alias("d")), F.col("digest") == F.col("d"), "left_anti") \
                if kind == "remove" else None
            changes = changes.select("shard", "digest", held.alias("enters"))
            if fallen is not None:      # keys that no document holds any more have no row now
                changes = changes.unionByName(fallen.select("shard", "digest", F.lit(False).alias("enters")))
            touched = (self.filters().groupBy("shard").cogroup(changes.groupBy("shard"))
                       .applyInPandas(change_filter, FILTERS))
            draft = f"{self.path}/filters/{v}-draft"
            touched.write.mode("overwrite").parquet(draft)
            drafted = self.spark.read.schema(FILTERS).parquet(draft)
            full = [r["shard"] for r in drafted.where("slots IS NULL").select("shard").collect()]
            filters = drafted.where("slots IS NOT NULL")
            if full:
                filters = filters.unionByName(now.where(held & F.col("shard").isin(full)).select("shard", "digest")
                                              .groupBy("shard").applyInPandas(build_filter, FILTERS))
        else:
            if shards != self.shards:
                now = now.withColumn("shard", _shard(shards))
                now.write.mode("overwrite").parquet(f"{path}-dealt")
                now = self.spark.read.schema(COUNTS + ", before bigint").parquet(f"{path}-dealt")
                now.write.mode("overwrite").parquet(path)
                now = self.spark.read.schema(COUNTS + ", before bigint").parquet(path)
            filters = now.where(held).select("shard", "digest").groupBy("shard").applyInPandas(build_filter, FILTERS)
        filters.write.mode("overwrite").parquet(f"{self.path}/filters/{v}")
        row = (v, shards, self.min_docs, self.min_chars, kind)
        self.spark.createDataFrame([row], COMMITS).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        self.version, self.shards = v, shards
        self.commits.append((v, kind))
        return self

    def _with_entries(self, rows: DataFrame, entries: DataFrame, n: str) -> DataFrame:
        """``rows`` that have their digest among ``entries`` (unique digests; ``n``: how many
        references each has), with the entry's columns.  Entries of many references are broadcast:
        as references add up to their total, at most HOT_KEYS exceed the bound."""
        total = entries.agg(F.sum(n).alias("n")).first()["n"] or 0
        bound = max(64, total // HOT_KEYS)
        entries = entries.withColumnRenamed("digest", "d")
        hot, rest = entries.where(F.col(n) > bound), entries.where(F.col(n) <= bound)
        same = F.col("digest") == F.col("d")
        marked = rows.join(F.broadcast(hot.withColumn("hot", F.lit(True))), same, "left")
        found = marked.where("hot").drop("hot", "d")
        plain = marked.where("hot IS NULL").drop("hot", "d", *[c for c in entries.columns if c != "d"])
        return found.unionByName(plain.join(rest, same).drop("d"))

    def _hits(self, lines: DataFrame) -> DataFrame:
        """Those of ``lines`` (with digest) that the filters hold."""
        filters = self.filters()
        size = filters.agg(F.sum(F.octet_length("slots")).alias("b"), F.sum("items").alias("n")).first()
        if not size["n"]:
            return lines.where(F.lit(False))
        if size["b"] <= SENT_BYTES:
            tables = {r["shard"]: bytes(r["slots"]) for r in filters.collect()}
            return lines.where(_probe(tables, self.shards)("digest"))
        return self._hits_in_shards(lines, filters)

    def _hits_in_shards(self, lines: DataFrame, filters: DataFrame) -> DataFrame:
        """Filters too large to send: lines go to their shards, each shard's lines in as many groups
        as keep a group near GROUP_LINES, with a copy of the filter each.  Lines of the few hottest
        keys need no filter and stay out of the groups."""
        counted = self.counts().agg(F.sum("n_docs").alias("n")).first()["n"] or 0
        lines = lines.withColumn("shard", _shard(self.shards))
        groups = max(1, -(-counted // (self.shards * GROUP_LINES)))
        bound = max(64, counted // HOT_KEYS)
        hot = self.counts().where(F.col("n_docs") > bound).select(F.col("digest").alias("d"), F.lit(True).alias("hot"))
        marked = lines.join(F.broadcast(hot), F.col("digest") == F.col("d"), "left")
        kept = marked.where("hot").select(*lines.columns)
        salted = marked.where("hot IS NULL").select(*lines.columns).withColumn(
            "salt", F.pmod(F.xxhash64("doc_id", "same", "place"), F.lit(groups)))
        copies = filters.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))

        def probe(rows, table):
            if not len(rows) or not len(table):
                return rows.iloc[:0]
            return rows[CuckooFilter.from_bytes(table["slots"].iloc[0]).contains(hashes_of(rows["digest"]))]

        rest = (salted.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt"))
                .applyInPandas(probe, salted.schema))
        return kept.unionByName(rest.drop("salt")).drop("shard")

    def clean(self, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
        """All rows and columns of ``docs``, ``text`` without the lines that go, and ``n_lines`` (before),
        ``n_dropped`` (both replaced where ``docs`` has them)."""
        lines = stage(self._hits(self._lines(docs, text, doc_id)), "line-hits")     # probed once
        active = self.counts().where(F.col("n_docs") >= self.min_docs).select("digest", "n_docs", "keep_id")
        repeated = self._with_entries(lines, active, "n_docs")
        drop = (repeated.where(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("doc_id", "same")
                .agg(F.collect_set("place").alias("places")))
        i, s, p, all_lines = (fresh_name(docs, x) for x in ("drop_id", "drop_same", "drop_places", "lines"))
        drop = drop.select(F.col("doc_id").alias(i), F.col("same").alias(s), F.col("places").alias(p))
        joined = docs.join(drop, F.col(doc_id).cast("long").eqNullSafe(F.col(i)) & (F.xxhash64(F.col(text)) == F.col(s)), "left")
        places = F.coalesce(F.col(p), F.array().cast("array<int>"))
        kept = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), places)
        cut = joined.withColumn(all_lines, lines_of(F.col(text)))
        return (cut.withColumn("n_lines", F.size(all_lines).cast("long"))
                   .withColumn("n_dropped", F.size(places).cast("long"))
                   .withColumn(text, F.concat_ws("\n", F.transform(kept, lambda k: F.get(F.col(all_lines), k))))
                   .drop(i, s, p, all_lines))


def _probe(tables: dict, shards: int):
    opened = {}

    @F.arrow_udf("boolean")
    def probe(digests: pa.Array) -> pa.Array:
        numbers, hashes = shards_of(digests, shards), hashes_of(digests)
        found = np.zeros(len(numbers), dtype=bool)
        for shard in np.unique(numbers):
            if shard in tables:
                if shard not in opened:
                    opened[shard] = CuckooFilter.from_bytes(tables[shard])
                mine = np.flatnonzero(numbers == shard)
                found[mine] = opened[shard].contains(hashes[mine])
        return pa.array(found)

    return probe


def fresh_index(spark: SparkSession, **settings) -> LineIndex:
    """An empty index in a new folder under the shared checkpoint folder."""
    return LineIndex(spark, scratch(spark, "lines"), **settings)

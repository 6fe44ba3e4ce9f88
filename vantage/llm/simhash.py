"""SimHash near-duplicates through a byte-position inverted index (operator 8).

Two 64-bit fingerprints that differ in at most 2 bits agree in at least 6 of their 8 bytes, and in
at least 2 of the 4 pairs of neighbouring bytes.  The index therefore holds each distinct
fingerprint under 6 keys, each made of four byte values and their positions.  Fingerprints that
meet under a key are tallied (how many positions hold equal bytes), pairs with fewer equal bytes
than the guarantee go, and the rest are verified bit by bit.

A list of more than ``LIST`` fingerprints is not paired.  Its members agree in the key's 32 bits,
so each is put under itself and the 32 fingerprints one flipped bit away; any two that differ in
at most 2 bits meet under one of these, and any two that meet differ in at most 2 bits.  Each
meeting links its members to the smallest: all links of the list, in linear work.

Components are found on distinct fingerprints by alternating large-star and small-star rounds,
each written to the shared folder; joins on hot keys are left to adaptive skew splitting.

Defined cases: a text of no words, null or empty has fingerprint 0, linked like any other; fewer
words than the shingle length make one shingle; rows that share a fingerprint are linked; a null
``doc_id`` never names a component unless all of its ids are null; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations, islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vantage.llm.common import fresh_name, small_batches, stage, text_bytes

LIST = 32          # longest list whose members are paired
SHINGLES = 1 << 16  # shingles hashed at a time


def fingerprint(text: bytes, words: int = 3) -> int:
    """Signed 64-bit fingerprint of a UTF-8 text: majority of each bit over the XXH64 hashes
    (seed 42) of its word shingles, repeats included."""
    found = text.lower().split()
    if not found:
        return 0
    if len(found) < words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[k:] for k in range(words)), strict=False))
    shingles = iter(shingles)
    digest = xxhash.xxh64_digest
    counts = np.zeros(64, np.int64)
    total = 0
    while True:
        part = [digest(s, 42) for s in islice(shingles, SHINGLES)]
        if not part:
            break
        total += len(part)
        bits = np.unpackbits(np.frombuffer(b"".join(part), np.uint8).reshape(-1, 8), axis=1)
        counts += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big", signed=True)


def with_fingerprints(df: DataFrame, text: str = "text", out: str = "fingerprint", words: int = 3) -> DataFrame:
    """``df`` with the signed 64-bit fingerprint of ``text``."""
    small_batches(df.sparkSession)

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    return df.withColumn(out, prints(text_bytes(text)))


def _byte_pair(fp: Column, k: int) -> Column:
    return F.shiftrightunsigned(fp, 16 * k).bitwiseAND(F.lit(0xFFFF))


def _keys(fp: Column, max_bits: int) -> list[tuple[tuple[int, ...], Column]]:
    """(byte pairs of the key, key): one for each choice of untouched byte pairs."""
    out = []
    for n, chosen in enumerate(combinations(range(4), 4 - max_bits)):
        key = F.lit(n).cast("long")
        for k in chosen:
            key = F.shiftleft(key, 16).bitwiseOR(_byte_pair(fp, k)) if len(chosen) < 4 else fp
        out.append((chosen, F.struct(F.lit(n).alias("lst"), key.alias("key"))))
    return out


def equal_bytes(a: Column, b: Column) -> Column:
    """In how many of the 8 positions two fingerprints hold the same byte."""
    differ = a.bitwiseXOR(b)
    return sum((F.when(F.shiftrightunsigned(differ, 8 * k).bitwiseAND(F.lit(0xFF)) == 0, 1).otherwise(0)
                for k in range(1, 8)), F.when(differ.bitwiseAND(F.lit(0xFF)) == 0, 1).otherwise(0))


def links(prints: DataFrame, max_bits: int = 2, longest: int = LIST) -> DataFrame:
    """Links (a, b), a > b, whose components are those of all pairs of distinct fingerprints in
    ``prints.fp`` with at most ``max_bits`` differing bits."""
    if max_bits not in (1, 2):
        raise ValueError("the maximum bit distance is 1 or 2")
    keys = _keys(F.col("fp"), max_bits)
    entries = prints.select("fp", F.explode(F.array(*[k for _, k in keys])).alias("_e")).select("_e.lst", "_e.key", "fp")
    lists = stage(entries.groupBy("lst", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "lists")
    short = entries.join(lists.where(F.col("n") <= longest).select("lst", "key"), ["lst", "key"])
    # the members of a short list, at most ``longest`` of them, by partial collection
    members = short.groupBy("lst", "key").agg(F.collect_list("fp").alias("fps"))
    one = members.select("fps", F.explode("fps").alias("a")).select("a", F.explode("fps").alias("b"))
    tallied = one.where("a > b").where(equal_bytes(F.col("a"), F.col("b")) >= 8 - max_bits)
    pairs = tallied.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b")
    long = entries.join(lists.where(F.col("n") > longest).select("lst", "key"), ["lst", "key"])
    flipped = None
    for n, (chosen, _) in enumerate(keys):
        free = [16 * k + b for k in range(4) if k not in chosen for b in range(16)]
        mine = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << b))) for b in free])
        flipped = F.when(F.col("lst") == n, mine) if flipped is None else flipped.when(F.col("lst") == n, mine)
    near = long.select("fp", F.explode(flipped).alias("m")).distinct()
    if max_bits == 1:   # one flipped bit leads from one to the other
        others = prints.select(F.col("fp").alias("m"))
        stars = near.join(others, "m").where("fp > m").select(F.col("fp").alias("a"), F.col("m").alias("b"))
    else:               # at most 33 meet at one point
        met = near.groupBy("m").agg(F.min("fp").alias("b"), F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
        stars = met.select(F.explode("fps").alias("a"), "b").where("a <> b")
    return pairs.unionByName(stars).distinct()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is the smallest node of its component.
    Alternating large-star and small-star rounds; a round only takes minima and joins them back."""
    now = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    seen = None
    while True:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        now = stage(small, "small")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def near_duplicates(prints: DataFrame, doc_id: str = "doc_id", out: str = "fingerprint", max_bits: int = 2) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint: the smallest fingerprint and the
    smallest ``doc_id`` in its component."""
    distinct = stage(prints.groupBy(F.col(out).alias("fp")).agg(F.min(doc_id).alias("first_id")), "prints")
    found = components(links(distinct.select("fp"), max_bits))
    rooted = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left") \
                     .select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.select("fp", "root").join(names, "root").select("fp", "root", "component_id")


def mark_components(df: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """Per row of ``df``: doc_id, fingerprint (16 hex digits), component_id."""
    prints = stage(with_fingerprints(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_t")), "_t", "fingerprint", words)
                   .select("doc_id", "fingerprint"), "fingerprints")
    named = near_duplicates(prints, max_bits=max_bits)
    return (prints.join(named, prints["fingerprint"] == named["fp"])
                  .select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"))


def deduplicated(df: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 3,
                 max_bits: int = 2) -> DataFrame:
    """The rows of ``df`` that stay, one of each component, all columns as they were: the row of the
    smallest ``doc_id``, and among rows that share it one by fingerprint and row hash."""
    fp, digest, rank = (fresh_name(df, x) for x in ("fp", "row", "rank"))
    rows = stage(with_fingerprints(df, text, fp, words)
                 .withColumn(digest, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])), "rows")
    named = near_duplicates(rows, doc_id, fp, max_bits)
    slim = rows.select(F.col(doc_id).alias("_i"), F.col(fp).alias("fp"), F.col(digest).alias("_h"))
    best = F.min(F.struct(F.col("_i").isNull().alias("_n"), "_i", "fp", "_h")).alias("_b")
    stays = slim.join(named, "fp").groupBy("root").agg(best).select("_b._i", "_b.fp", "_b._h")
    kept = rows.join(stays, (rows[fp] == stays["fp"]) & rows[digest].eqNullSafe(stays["_h"])
                     & rows[doc_id].eqNullSafe(stays["_i"]), "left_semi")
    one = Window.partitionBy(fp, digest, doc_id).orderBy(doc_id)
    return kept.withColumn(rank, F.row_number().over(one)).where(F.col(rank) == 1).drop(fp, digest, rank)

"""Hard-negative mining with spanning-tree bounds (operator 13).

Anchors are dealt into blocks by a hash.  In a block the anchors of one label form a minimum spanning
tree over their distances, built in a task.  The blocks are then taken one after the other: a block of
at most about ``block`` anchors (the bound of what is sent to tasks) meets all rows where they lie,
first those of its labels for the positives, then the others for the negatives.

A task scores its rows against the root of a tree; for a child,

    score(parent) - edge * norm  <=  score(child)  <=  score(parent) + edge * norm

with ``edge`` the distance of the two anchors and ``norm`` the length of the row's vector.  Only rows
whose bounds meet the child's window are scored again, the others pass widened bounds on to the
child's own children.  The window of positives opens at the last of the best positives so far; that of
negatives spans the shares of the positives' scores, and narrows as places fill.  Each task emits its
best few rows per anchor; the final choice is made by Spark.  The bounds only spare work: no row that
could enter a result is passed over, and all scores are exact integers.

Defined cases: a row whose key, label or vector is null, or whose vector is empty, holds null, NaN or
infinite entries, entries so large that a score could pass 64 bits, or has not the most frequent
length (of ties the longest) takes no part; rows that repeat key, label and vector count once; a row that has the anchor's key is no positive of it; an
anchor without positives, or a positive without negatives, gives no rows; an empty table gives an
empty result; other columns are left alone, whatever their names.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vantage.llm.common import scratch, small_batches, stage
from vantage.llm.vectors import dimension, exact_dtype, finite, integers, magnitude, matrix

BLOCK = 2048
CHUNK = 2048
SLACK = 1e-9
RESULT = ("anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
          "negative_score bigint")


def vector_rows(df: DataFrame, label: Column, vec: str = "embedding", key: str = "vec_id", scale: int = 256) -> DataFrame:
    """(id, label, x) of the rows that take part, each once."""
    width = dimension(df, vec)
    most = math.isqrt((1 << 62) // max(width, 1))
    usable = df.where(finite(vec) & (F.size(vec) == width)).where(
        F.forall(integers(vec, scale), lambda c: F.abs(c) <= F.lit(most)))
    rows = usable.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"),
                         integers(vec, scale).alias("x"))
    return rows.where(F.col("id").isNotNull() & F.col("label").isNotNull()).distinct()


def spanning_trees(pdf: pd.DataFrame) -> pd.DataFrame:
    """The anchors of one block, parents before children: ``parent`` is the place of an anchor's
    parent in its tree (-1 for a root), ``edge`` their distance.  One tree a label (Prim)."""
    pdf = pdf.sort_values(["label", "id"], kind="stable").reset_index(drop=True)
    x = np.array(pdf["x"].tolist(), dtype=np.float64).reshape(len(pdf), -1)
    labels = pdf["label"].to_numpy()
    order, parents, edges = [], [], []
    for label in np.unique(labels):
        members = np.flatnonzero(labels == label)
        near = np.full(len(members), np.inf)
        link = np.full(len(members), -1)
        place = {}
        left = np.ones(len(members), dtype=bool)
        now = int(np.argmin(((x[members] - x[members].mean(axis=0)) ** 2).sum(axis=1)))
        while True:
            left[now] = False
            place[now] = len(order)
            parents.append(place[link[now]] if link[now] >= 0 else -1)
            edges.append(float(np.sqrt(near[now])) if link[now] >= 0 else 0.0)
            order.append(members[now])
            if not left.any():
                break
            apart = ((x[members] - x[members[now]]) ** 2).sum(axis=1)
            closer = left & (apart < near)
            near[closer], link[closer] = apart[closer], now
            now = int(np.where(left, near, np.inf).argmin())
    out = pdf.iloc[order].reset_index(drop=True)
    out["place"], out["parent"], out["edge"] = np.arange(len(out)), parents, edges
    return out


class Forest:
    """The trees of a block, level by level."""

    def __init__(self, pdf: pd.DataFrame):
        pdf = pdf.sort_values("place")
        self.ids = pdf["id"].to_numpy(dtype=np.int64)
        self.labels = pdf["label"].to_numpy(dtype=np.int64)
        self.x = np.array(pdf["x"].tolist(), dtype=np.int64).reshape(len(pdf), -1)
        self.reach = magnitude(self.x)
        self.edges = pdf["edge"].to_numpy(dtype=np.float64) * (1 + SLACK)
        self.parents = pdf["parent"].to_numpy(dtype=np.int64)
        depth = np.zeros(len(pdf), dtype=np.int64)
        for k, p in enumerate(self.parents):
            depth[k] = depth[p] + 1 if p >= 0 else 0
        #: label -> its anchors, a list for each depth
        self.trees = {int(label): [np.flatnonzero((self.labels == label) & (depth == d))
                                   for d in range(depth[self.labels == label].max() + 1)]
                      for label in np.unique(self.labels)}


class Best:
    """The first ``k`` (score falling, id rising) of what was offered."""

    __slots__ = ("k", "items")

    def __init__(self, k: int):
        self.k, self.items = k, []

    def least(self):
        """What a score must reach to enter; None while there are places."""
        return self.items[-1][0] * -1 if len(self.items) == self.k else None

    def offer(self, scores, ids) -> None:
        found = zip((-s for s in scores.tolist()), ids.tolist())
        self.items = heapq.nsmallest(self.k, [*self.items, *found])


def descend(forest: Forest, levels: list, x: np.ndarray, windows, take) -> int:
    """Walk one tree over the rows ``x`` and return how many scores were computed.

    ``windows(a)`` gives the lowest and highest score that can still count for anchor ``a`` (None
    where nothing can); ``take(a, scores, where)`` gets the exact scores of the rows at ``where``."""
    m = len(x)
    if not m:
        return 0
    far = max(magnitude(x), forest.reach, 1)
    dtype = exact_dtype(far * far * x.shape[1])
    floats = dtype in (np.float32, np.float64)
    rows, anchors = x.astype(dtype), forest.x.astype(dtype)
    norms = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)) * (1 + SLACK)
    scored = 0
    low = high = None
    at = {}
    for depth, level in enumerate(levels):
        if depth:
            above = [at[p] for p in forest.parents[level]]
            stretch = forest.edges[level][:, None] * norms[None, :] + SLACK if floats else np.inf
            low, high = low[above] - stretch, high[above] + stretch
        else:
            low, high = np.full((len(level), m), -np.inf), np.full((len(level), m), np.inf)
        for k, a in enumerate(level):
            if depth:
                window = windows(a)
                if window is None:
                    continue
                where = np.flatnonzero((high[k] >= window[0]) & (low[k] <= window[1]))
            else:
                where = np.arange(m)
            if not len(where):
                continue
            scores = (rows if len(where) == m else rows[where]) @ anchors[a]
            scored += len(where)
            if floats:
                low[k, where] = high[k, where] = scores
                scores = scores.astype(np.int64)
            take(a, scores, where)
        at = {a: k for k, a in enumerate(level)}
    return scored


def _batches(batches, width):
    for batch in batches:
        ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
        x = matrix(batch.column(2), width)
        for start in range(0, len(ids), CHUNK):
            part = slice(start, start + CHUNK)
            yield ids[part], labels[part], x[part]


def _emitted(found: list) -> pa.RecordBatch:
    columns = list(zip(*found)) or [[], [], [], []]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], ["place", "turn", "score", "id"])


def positives_of(forest: Forest, k: int):
    """Task function: the best ``k`` rows of the same label for each anchor of the forest."""
    def run(batches):
        best = [Best(k) for _ in forest.ids]
        for ids, labels, x in _batches(batches, forest.x.shape[1]):
            for label, levels in forest.trees.items():
                mine = labels == label
                if not mine.any():
                    continue
                own = ids[mine]

                def windows(a):
                    least = best[a].least()
                    return (-np.inf if least is None else least), np.inf

                def take(a, scores, where):
                    others = own[where] != forest.ids[a]
                    least = best[a].least()
                    if least is not None:
                        others &= scores >= least
                    if others.any():
                        best[a].offer(scores[others], own[where][others])

                descend(forest, levels, x[mine], windows, take)
        yield _emitted([(a, 0, -s, i) for a, b in enumerate(best) for s, i in b.items])
    return run


def negatives_of(forest: Forest, wanted: list, k: int):
    """Task function: for each anchor and each of its score windows (``wanted``: a list of (low, high)
    an anchor) the best ``k`` rows of other labels inside."""
    def run(batches):
        best = [[Best(k) for _ in w] for w in wanted]

        def open_windows(a):
            for turn, (low, high) in enumerate(wanted[a]):
                least = best[a][turn].least()
                if low <= high and (least is None or least <= high):
                    yield turn, (low if least is None else max(low, least)), high

        def windows(a):
            spans = list(open_windows(a))
            return (min(s[1] for s in spans), max(s[2] for s in spans)) if spans else None

        for ids, labels, x in _batches(batches, forest.x.shape[1]):
            for label, levels in forest.trees.items():
                other = labels != label
                if not other.any():
                    continue
                theirs = ids[other]

                def take(a, scores, where):
                    for turn, low, high in open_windows(a):
                        inside = np.flatnonzero((scores >= low) & (scores <= high))
                        if len(inside):
                            best[a][turn].offer(scores[inside], theirs[where[inside]])

                descend(forest, levels, x[other], windows, take)
        yield _emitted([(a, t, -s, i) for a, turns in enumerate(best) for t, b in enumerate(turns) for s, i in b.items])
    return run


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         block: int = BLOCK) -> DataFrame:
    """For each row of ``rows`` (id, label, x; from ``vector_rows``) that ``anchor`` selects and each of
    its first ``positives`` rows of the same label, the first ``negatives`` rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score.  Higher scores come first,
    ties by smaller id."""
    spark = rows.sparkSession
    small_batches(spark)
    rows = stage(rows, "vectors")
    chosen = rows.where(anchor)
    blocks = -(-chosen.count() // block)
    if not blocks:
        return spark.createDataFrame([], RESULT)
    dealt = chosen.withColumn("block", F.pmod(F.xxhash64("id", "label", "x"), F.lit(blocks)).cast("int"))
    trees = stage(dealt.groupBy("block").applyInPandas(
        spanning_trees, "id bigint, label bigint, x array<bigint>, block int, place int, parent int, edge double"), "trees")
    out = scratch(spark, "negatives")
    found = "place int, turn int, score bigint, id bigint"
    first = Window.partitionBy("place", "turn").orderBy(F.desc("score"), "id")
    for b in range(blocks):
        members = trees.where(F.col("block") == b).toPandas()
        if not len(members):
            continue
        forest = Forest(members)
        same = rows.where(F.col("label").isin([int(v) for v in forest.trees])).mapInArrow(positives_of(forest, positives), found)
        kept = same.withColumn("turn", F.row_number().over(first)).where(F.col("turn") <= positives).collect()
        wanted = [[] for _ in forest.ids]
        pairs = []
        for r in sorted(kept, key=lambda r: (r["place"], r["turn"])):
            p = r["score"]
            pairs.append((r["place"], len(wanted[r["place"]]), int(forest.ids[r["place"]]), r["id"], p))
            wanted[r["place"]].append((-(-low * p // 100), high * p // 100))
        pairs = spark.createDataFrame(pairs, "place int, turn int, anchor_id bigint, positive_id bigint, positive_score bigint")
        others = rows.mapInArrow(negatives_of(forest, wanted, negatives), found)
        ranked = others.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
        (ranked.join(F.broadcast(pairs), ["place", "turn"])
               .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                       "positive_score", F.col("score").alias("negative_score"))
               .write.mode("overwrite").parquet(f"{out}/block={b}"))
    return spark.read.schema(RESULT).option("basePath", out).parquet(out).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

"""Benchmark decontamination with training suffix arrays (operator 7).

Every Arrow batch of documents is one shard.  Its words become numbers of the benchmark's
vocabulary; the suffixes that start with enough benchmark words to hold a window are sorted into a
suffix array (a suffix that does not can match none, so it is left out), and all test suffixes are
binary-searched in it word by word together, which gives how far each one matches and where.
Occurrences on one diagonal of document and item join into maximal verbatim matches.

The benchmark is a stated query set: it is held against all rows in blocks of bounded size, one
pass over the documents for each, and hits of the passes are united.

Words are maximal runs of characters other than ASCII non-alphanumerics, A-Z lower-cased.  A window
is ``WINDOW`` consecutive words of an item; an item of fewer, but not none, is one window.
Defined cases: null and empty texts have no words and no hits; an item without words has no window;
a null item id reads as ''; rows that repeat give a row each; all columns pass unchanged, whatever
their names; an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import BATCH_BYTES, fresh_name, small_batches, stage, text_bytes

WINDOW = 10
BLOCK_BYTES = 8 * 1024 * 1024    # benchmark text that is held at once
SHARD_BYTES = 4 * 1024 * 1024    # document text that makes a shard, at least one document
NONE = 1 << 30

_KEEP = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_STATE = "n_words long, spans array<int>, items array<string>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_KEEP).split()


class TestSet:
    """Windows of a block of items, numbered by content, and the vocabulary they are made of."""

    __test__ = False  # not a test case

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        number, self.ids = self.vocabulary, [i for i, _ in items]
        found: dict[tuple, int] = {}
        places = []                                        # (window, item, offset)
        for k, (_, text) in enumerate(items):
            codes = [number.setdefault(w, len(number) + 1) for w in words_of(text)]
            for at in range(max(1, len(codes) - window + 1) if codes else 0):
                w = found.setdefault(tuple(codes[at:at + window]), len(found))
                places.append((w, k, at))
        self.windows = np.zeros((len(found), window), np.int32)
        self.lengths = np.zeros(len(found), np.int64)
        for codes, w in found.items():
            self.windows[w, :len(codes)] = codes
            self.lengths[w] = len(codes)
        places.sort()
        table = np.array(places, np.int64).reshape(-1, 3)
        self.place_item, self.place_at = table[:, 1], table[:, 2]
        self.place_from = np.searchsorted(table[:, 0], np.arange(len(found) + 1))
        # fewest words a suffix must share with the vocabulary, by its first word
        self.least = np.full(len(number) + 1, NONE, np.int64)
        np.minimum.at(self.least, self.windows[:, 0], self.lengths)

    def search(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All occurrences (window, position) in a shard of word numbers: 0 is a word outside the
        vocabulary, -1 stands between documents."""
        none = np.zeros(0, np.int64)
        if not len(codes) or not len(self.windows):
            return none, none
        outside = np.concatenate([np.flatnonzero(codes <= 0), [len(codes)]])
        inside = np.flatnonzero(codes > 0)
        run = outside[np.searchsorted(outside, inside)] - inside
        starts = inside[run >= self.least[codes[inside]]]
        if not len(starts):
            return none, none
        padded = np.concatenate([codes, np.full(self.window, -1, codes.dtype)])
        matrix = padded[starts[:, None] + np.arange(self.window)]
        order = np.lexsort(matrix.T[::-1])                 # the suffix array, as deep as a window
        matrix, starts = np.ascontiguousarray(matrix[order].T), starts[order]
        low = np.zeros(len(self.windows), np.int64)
        high = np.full(len(self.windows), len(starts), np.int64)
        for depth in range(self.window):
            live = np.flatnonzero((self.lengths > depth) & (low < high))
            if not len(live):
                break
            want, column = self.windows[live, depth], matrix[depth]
            low[live], high[live] = (_bound(column, want, low[live], high[live], right) for right in (False, True))
        count = high - low
        which = np.repeat(np.arange(len(count)), count)
        at = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        return which, starts[at]


def _bound(column, want, low, high, right: bool) -> np.ndarray:
    """Binary search of each ``want`` in its own sorted range of ``column``."""
    low, high = low.copy(), high.copy()
    while True:
        live = low < high
        if not live.any():
            return low
        middle = (low + high) >> 1
        value = column[np.minimum(middle, len(column) - 1)]
        up = live & ((value <= want) if right else (value < want))
        low = np.where(up, middle + 1, low)
        high = np.where(live & ~up, middle, high)


def _shards(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    a = size = 0
    for b, t in enumerate(texts):
        if b > a and size + len(t) > SHARD_BYTES:
            yield a, b
            a, size = b, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


def _numbers(text: bytes, number: dict[bytes, int]) -> np.ndarray:
    """Word numbers of a text.  A long one is cut between words, so that only a part's words are
    Python objects at a time."""
    clean, parts, a = text.translate(_KEEP), [], 0
    while a < len(clean):
        b = len(clean) if len(clean) - a <= BATCH_BYTES else clean.find(b" ", a + BATCH_BYTES)
        b = len(clean) if b < 0 else b
        found = clean[a:b].split()
        parts.append(np.fromiter((number.get(w, 0) for w in found), np.int32, len(found)))
        a = b
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def _codes(texts: list[bytes], number: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers of all texts with -1 after each, where each text begins)."""
    parts, begins, at = [], [], 0
    for t in texts:
        found = _numbers(t, number)
        parts += [found, np.array([-1], np.int32)]
        begins.append(at)
        at += len(found) + 1
    return np.concatenate(parts) if parts else np.zeros(0, np.int32), np.array([*begins, at], np.int64)


def _runs(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of true values."""
    edge = np.diff(np.concatenate([[0], marks.astype(np.int8), [0]]))
    return np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)


def _scan_shard(texts: list[bytes], tests: TestSet) -> list[tuple[int, list[int], list[str]]]:
    """Per text: words, hit runs (begin, end, ...) and the items that have an occurring window."""
    codes, begins = _codes(texts, tests.vocabulary)
    window, at = tests.search(codes)
    n_words = np.diff(begins) - 1
    if not len(at):
        return [(int(n), [], []) for n in n_words]
    cover = np.zeros(len(codes) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + tests.lengths[window], -1)
    a, b = _runs(np.cumsum(cover[:-1]) > 0)
    owner = np.searchsorted(begins, a, "right") - 1
    spans: list[list[int]] = [[] for _ in texts]
    for k, x, y in zip(owner.tolist(), (a - begins[owner]).tolist(), (b - begins[owner]).tolist(), strict=True):
        spans[k] += [x, y]
    doc = np.searchsorted(begins, at, "right") - 1
    seen = np.unique(doc * len(tests.windows) + window)
    doc, window = seen // len(tests.windows), seen % len(tests.windows)
    items: list[set] = [set() for _ in texts]
    for k, w in zip(doc.tolist(), window.tolist(), strict=True):
        items[k].update(tests.ids[i] for i in tests.place_item[tests.place_from[w]:tests.place_from[w + 1]].tolist())
    return [(int(n), s, sorted(i)) for n, s, i in zip(n_words, spans, items, strict=True)]


def _united(spans: list[int], more: list[int]) -> list[int]:
    out: list[int] = []
    pairs = sorted([*zip(spans[::2], spans[1::2], strict=True), *zip(more[::2], more[1::2], strict=True)])
    for a, b in pairs:
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark in blocks of about BLOCK_BYTES, one at a time on the driver."""
    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"), text_bytes(text).alias("t"))
    total = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_BYTES))   # an empty benchmark is one empty block
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        yield [(r["i"], bytes(r["t"])) for r in part.collect()]


def _scanner(held):
    """The function of a column of texts and of what earlier blocks found, for one block."""

    @F.pandas_udf(_STATE)
    def scan(texts: pd.Series, spans: pd.Series, known: pd.Series) -> pd.DataFrame:
        rows, all_texts = [], texts.tolist()
        for a, b in _shards(all_texts):
            rows += _scan_shard(all_texts[a:b], held.value)
        out = []
        for (n, s, i), s0, i0 in zip(rows, spans, known, strict=True):
            if s0 is not None and len(s0):
                s, i = _united(s0.tolist(), s), sorted({*i0, *i})
            out.append((n, s, i))
        return pd.DataFrame(out, columns=["n_words", "spans", "items"])

    return scan


def with_matches(df: DataFrame, benchmark: DataFrame, out: str, text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``df`` with the struct ``out``: n_words, spans (begin and end of each hit run of words, one
    after the other) and items (ids with an occurring window)."""
    small_batches(df.sparkSession)
    found = df.withColumn(out, F.lit(None).cast("struct<n_words:bigint,spans:array<int>,items:array<string>>"))
    for k, items in enumerate(_blocks(benchmark, item_id, item_text)):
        if k:
            found = stage(found, "decontaminate")
        scan = _scanner(df.sparkSession.sparkContext.broadcast(TestSet(items, window)))
        found = found.withColumn(out, scan(text_bytes(text), F.col(out)["spans"], F.col(out)["items"]))
    return found


def _hit_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda acc, x: x.cast("long") - acc)


def mark_contaminated(df: DataFrame, benchmark: DataFrame, text: str = "text", **names) -> DataFrame:
    """``df`` with n_words, n_hit, n_items, items_sha256, contaminated.  The benchmark's columns are
    item_id and text unless named."""
    state = fresh_name(df, "matches")
    found = with_matches(df, benchmark, state, text, **names)
    # ends minus begins: the sign alternates along the array, which has an even length
    return found.withColumns({
        "n_words": F.col(state)["n_words"], "n_hit": _hit_words(F.col(state)["spans"]),
        "n_items": F.size(F.col(state)["items"]).cast("long"),
        "items_sha256": F.sha2(F.array_join(F.array_sort(F.col(state)["items"]), ",").cast("binary"), 256),
        "contaminated": F.size(F.col(state)["spans"]) > 0}).drop(state)


def decontaminated(df: DataFrame, benchmark: DataFrame, text: str = "text", **names) -> DataFrame:
    """The rows of ``df`` that hold no window of the benchmark, all columns as they were."""
    state = fresh_name(df, "matches")
    return with_matches(df, benchmark, state, text, **names).where(F.size(F.col(state)["spans"]) == 0).drop(state)


def verbatim_matches(df: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id",
                     item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Maximal verbatim matches of at least a window: doc_id, item_id, doc_from, item_from, n_words
    (positions in words)."""
    small_batches(df.sparkSession)
    schema = "doc_id long, item_id string, doc_from long, item_from long, n_words long"
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), text_bytes(text).alias("t"))
    out = None
    for items in _blocks(benchmark, item_id, item_text):
        held = df.sparkSession.sparkContext.broadcast(TestSet(items, window))

        def matches(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            for batch in batches:
                ids, texts = batch["doc_id"].astype("Int64").tolist(), batch["t"].tolist()
                for a, b in _shards(texts):
                    found = _maximal(texts[a:b], held.value)
                    table = pd.DataFrame(found, columns=["doc_id", "item_id", "doc_from", "item_from", "n_words"])
                    table["doc_id"] = pd.array([ids[a + k] for k in table["doc_id"]], dtype="Int64")
                    yield table

        part = rows.mapInPandas(matches, schema)
        out = part if out is None else out.unionByName(part)
    return out


def _maximal(texts: list[bytes], tests: TestSet) -> list[tuple]:
    codes, begins = _codes(texts, tests.vocabulary)
    window, at = tests.search(codes)
    count = tests.place_from[window + 1] - tests.place_from[window]
    which = np.repeat(np.arange(len(window)), count)
    place = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(tests.place_from[window], count)
    doc = np.searchsorted(begins, at, "right") - 1
    doc, at, length = doc[which], (at - begins[doc])[which], tests.lengths[window][which]
    item, offset = tests.place_item[place], tests.place_at[place]
    order = np.lexsort((at, at - offset, item, doc))
    doc, at, length, item, offset = (x[order] for x in (doc, at, length, item, offset))
    out: list[tuple] = []
    for d, p, n, i, q in zip(doc.tolist(), at.tolist(), length.tolist(), item.tolist(), offset.tolist(), strict=True):
        last = out[-1] if out else None
        if last and last[0] == d and last[1] == i and p - q == last[2] - last[3] and p == last[2] + last[4] - n + 1:
            out[-1] = (d, i, last[2], last[3], last[4] + 1)
        else:
            out.append((d, i, p, q, n))
    return [(d, tests.ids[i], p, q, n) for d, i, p, q, n in out]

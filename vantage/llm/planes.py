"""Token-id files of shuffled bit or byte planes (operator 1).

A file set is a folder of Parquet parts; each row is one block of a shard: a run of documents in
ascending ``doc_id`` order, whose ids stand end to end in blocks of fixed size.  A block's ids are
transposed into byte planes (or bit planes), each plane is one zstandard frame, and the row is the
chunk index entry: shard, block, position of its first id within the shard, number of ids, where
each plane's frame ends, and which documents have how many ids in it.  Any run of ids is read from
the blocks that hold it.  Spark's writer commits the parts, so a lost executor leaves no half file.

Defined cases: a null or empty text has the end id alone; a null ``doc_id`` sorts first; rows that
share a ``doc_id`` are kept apart and sorted by text; an empty table gives files without rows.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from functools import lru_cache
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vantage.llm.common import give_back, small_batches, stage

BLOCK = 1 << 16        # ids in a block
LEVEL = 3              # zstandard level
REMEMBER = 1_000_000     # remembered words a worker holds at most
LONGEST = 64           # longer words are encoded each time
PICK = 1 << 16         # words whose ids are put together at a time
MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"     # marks that no special token or contraction is made of

FILE_SCHEMA = ("shard int, block int, first long, n_ids int, kind string, planes binary, plane_ends array<int>, "
               "doc_nos array<long>, doc_ids array<long>, doc_n_ids array<int>")


def shuffle_block(ids: np.ndarray, kind: str = "byte", level: int = LEVEL) -> tuple[bytes, list[int]]:
    """Planes of little-endian unsigned 32-bit ids, compressed one by one: (frames, their ends)."""
    by_byte = np.ascontiguousarray(np.asarray(ids, "<u4").view(np.uint8).reshape(-1, 4).T)
    if kind == "bit":
        bits = np.unpackbits(by_byte[:, :, None], axis=2, bitorder="little")
        by_byte = np.packbits(bits.transpose(0, 2, 1).reshape(32, -1), axis=1, bitorder="little")
    elif kind != "byte":
        raise ValueError(f"planes are of bits or bytes, not {kind}")
    compress = zstandard.ZstdCompressor(level=level).compress
    frames = [compress(plane.tobytes()) for plane in by_byte]
    return b"".join(frames), np.cumsum([len(f) for f in frames]).tolist()


def restore_block(planes: bytes, ends, n_ids: int, kind: str = "byte") -> np.ndarray:
    """The ids of a block."""
    expand = zstandard.ZstdDecompressor().decompress
    starts = [0, *ends[:-1]]
    raw = [np.frombuffer(expand(planes[a:b]), np.uint8) for a, b in zip(starts, ends, strict=True)]
    by_byte = np.stack(raw)
    if kind == "bit":
        bits = np.unpackbits(by_byte, axis=1, bitorder="little")[:, :n_ids]
        by_byte = np.packbits(bits.reshape(4, 8, n_ids).transpose(0, 2, 1), axis=2, bitorder="little")[:, :, 0]
    return np.ascontiguousarray(by_byte.T).view("<u4").ravel()


class WordEncoder:
    """A tokenizers file whose ids never cross a space or line end: each text is cut there, and a
    word's ids, as the tokenizers library gives them, are remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {"": b""}
        self.tails = {"": b""}
        # ids of pieces that a word's end alone can have
        suffix = getattr(self.library.model, "end_of_word_suffix", None)
        self.word_ends: np.ndarray | None = None
        if suffix:
            pieces = self.library.get_vocab(with_added_tokens=False)
            self.word_ends = np.zeros(max(self.library.get_vocab().values(), default=0) + 1, bool)
            self.word_ends[[i for piece, i in pieces.items() if piece.endswith(suffix)]] = True

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        lists = pc.split_pattern(pa.array([t.replace("\n", " ") for t in texts], pa.large_string()), " ")
        ends = lists.offsets.to_numpy()[1:]
        coded = pc.dictionary_encode(lists.flatten())
        # a few marks after a Latin letter are cut from it, whatever it is, and ASCII letters lose their
        # case, unless a special token may be about: these need no call of their own
        cores, tails = map(pc.dictionary_encode, self._cores(coded.dictionary))
        used = cores.dictionary.to_pylist()
        known = self.known
        new = [w for w in used if w not in known]
        if len(known) + len(new) > REMEMBER:
            known = self.known = {w: known[w] for w in used if w in known}
        letters = [w for w in new if w.isalpha()]
        for a in range(0, len(letters), 1024):
            self._learn_together(letters[a:a + 1024])
        self._learn([w for w in new if w and not w.isalpha()])
        known.setdefault("", b"")
        marks = tails.dictionary.to_pylist()
        unknown = [m for m in marks if m not in self.tails]
        if unknown:
            for tail, found in zip(unknown, self.library.encode_batch_fast(unknown, add_special_tokens=False), strict=True):
                self.tails[tail] = _bytes_of(found.ids)
        # the ids of each word, its core's and its marks', then those of all words
        pieces = [*map(known.__getitem__, used), *map(self.tails.__getitem__, marks)]
        order = np.stack([cores.indices.to_numpy(), tails.indices.to_numpy() + len(used)], axis=1).ravel()
        ids, sizes = _picked(np.frombuffer(b"".join(pieces), "<u4"), np.array([len(p) >> 2 for p in pieces]), order)
        ids, sizes = _picked(ids, sizes.reshape(-1, 2).sum(axis=1), coded.indices.to_numpy())
        cuts = np.append(0, np.cumsum(sizes))[ends].tolist()
        for w in new:
            if len(w) > LONGEST:
                known.pop(w, None)
        return [ids[a:b] for a, b in zip([0, *cuts], cuts)]  # noqa: B905

    def _learn(self, cores: list[str]) -> None:
        for a in range(0, len(cores), 4096):
            part = cores[a:a + 4096]
            for w, found in zip(part, self.library.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.known[w] = _bytes_of(found.ids)

    def _learn_together(self, cores: list[str]) -> None:
        """Words of letters alone in one call, if each of them ends in an id that only ends words."""
        if self.word_ends is None:
            self._learn(cores)
            return
        ids = np.array(self.library.encode_batch_fast([" ".join(cores)], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(self.word_ends[ids]) + 1
        if len(cuts) != len(cores) or cuts[-1] != len(ids):
            # some word is not one for the library
            self._learn(cores)
            return
        ends = (4 * cuts).tolist()
        self.known.update(zip(cores, map(ids.tobytes().__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))

    def _cores(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """(what the library is asked for, the marks after it) of each word."""
        stems = pc.utf8_rtrim(words, MARKS)
        n = pc.subtract(pc.utf8_length(words), pc.utf8_length(stems))
        last = pc.dictionary_encode(pc.utf8_slice_codeunits(stems, -1))
        latin = pa.array([c.isalpha() and ord(c.lower()[-1]) < 0x250 for c in last.dictionary.to_pylist()], pa.bool_())
        cut = pc.and_(pc.less_equal(n, 3), latin.take(last.indices))
        cores = pc.if_else(cut, stems, words)
        plain = pc.and_(pc.string_is_ascii(cores), pc.invert(pc.match_substring(cores, "<")))
        return pc.if_else(plain, pc.ascii_lower(cores), cores), self._marks(words, pc.if_else(cut, n, 0))

    @staticmethod
    def _marks(ends: pa.Array, n: pa.Array) -> pa.Array:
        """The last ``n`` characters, up to three, of each."""
        out = pa.array([""], ends.type).take(pa.array(np.zeros(len(ends), int)))
        for k in (1, 2, 3):
            out = pc.if_else(pc.equal(n, k), pc.utf8_slice_codeunits(ends, -k), out)
        return out


def _picked(flat: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``flat`` holds pieces of these sizes end to end: the pieces in this order, and their sizes."""
    sizes = sizes.astype(np.int64)
    starts, picked = np.cumsum(sizes) - sizes, sizes[order]
    out, done = np.empty(picked.sum(), flat.dtype), 0
    # numbers of 64 bits for each of all ids would be several times what is returned
    for a in range(0, len(order), PICK):
        some = picked[a:a + PICK]
        ends = np.cumsum(some)
        at = np.repeat(starts[order[a:a + PICK]] - (ends - some), some)
        at += np.arange(len(at))
        out[done:done + len(at)] = flat[at]
        done += len(at)
    return out, picked


def _bytes_of(ids: list[int]) -> bytes:
    """The ids as little-endian unsigned 32-bit integers."""
    found = array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(path)


class _Shard:
    """Cuts the ids of a shard's documents into blocks."""

    def __init__(self, number: int, kind: str):
        self.number, self.kind = number, kind
        self.block = self.first = self.held = self.doc_no = 0
        self.parts: list[np.ndarray] = []
        self.docs: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> Iterator[tuple]:
        at = 0
        while at < len(ids):
            take = min(len(ids) - at, BLOCK - self.held)
            self.parts.append(ids[at:at + take])
            self.docs.append((self.doc_no, doc_id, take))
            self.held += take
            at += take
            if self.held == BLOCK:
                yield self.cut()
        self.doc_no += 1

    def cut(self) -> tuple:
        planes, ends = shuffle_block(np.concatenate(self.parts), self.kind)
        numbers, doc_ids, counts = (list(x) for x in zip(*self.docs, strict=True))
        row = (self.number, self.block, self.first, self.held, self.kind, planes, ends, numbers, doc_ids, counts)
        self.first += self.held
        self.block, self.held, self.parts, self.docs = self.block + 1, 0, [], []
        return row


def write_ids(df: DataFrame, path: str, tokenizer_path: str, end_id: int, text: str = "text",
              doc_id: str = "doc_id", kind: str = "byte") -> None:
    """Encode every text and write the file set to ``path`` in ascending ``doc_id`` order, each
    document's ids followed by ``end_id``.  Rows are dealt by range of ``doc_id``; the number of
    shards follows the session's shuffle partitions.  A range's shard is streamed, so a task holds
    one batch of texts and one block."""
    small_batches(df.sparkSession)
    names = [f.split()[0] for f in FILE_SCHEMA.split(", ")]

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        shard, encoder = _Shard(TaskContext.get().partitionId(), kind), _encoder(tokenizer_path)
        end = np.array([end_id], "<u4")
        for batch in batches:
            rows = []
            found = encoder.encode_all(batch["text"].tolist())
            for key, ids in zip(batch["doc_id"].astype("Int64"), found, strict=True):
                rows.extend(shard.add(None if key is pd.NA else int(key), np.concatenate([ids, end])))
            if rows:
                yield pd.DataFrame(rows, columns=names)
            give_back()
        if shard.docs:
            yield pd.DataFrame([shard.cut()], columns=names)

    (df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
       .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
       .mapInPandas(blocks, FILE_SCHEMA).write.option("compression", "none").parquet(path))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with their place among all ids (``start``).  Only one number per shard is summed
    over all shards."""
    blocks = spark.read.schema(FILE_SCHEMA).parquet(path)
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_base"))
    # one row per shard, and shards are tasks: the table is as small as the list of tasks
    return blocks.join(F.broadcast(bases), "shard").withColumn("start", F.col("_base") + F.col("first")).drop("_base")


def crc32_joined(first: int, second: int, second_bytes: int) -> int:
    """crc32 of two strings end to end from their crc32 and the second one's length: the first is
    moved on by that many zero bytes, squaring the matrix of one zero bit over GF(2)."""
    if second_bytes <= 0:
        return first

    def times(matrix, vector):
        total, k = 0, 0
        while vector:
            if vector & 1:
                total ^= matrix[k]
            vector >>= 1
            k += 1
        return total

    matrix = [0xEDB88320] + [1 << k for k in range(31)]
    for _ in range(3):
        matrix = [times(matrix, row) for row in matrix]
    while second_bytes:
        if second_bytes & 1:
            first = times(matrix, first)
        second_bytes >>= 1
        if second_bytes:
            matrix = [times(matrix, row) for row in matrix]
    return first ^ second


def document_checksums(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens, ids_crc32 (of its ids as
    little-endian unsigned 32-bit integers).  A document inside one block is done where the block is
    read.  Only what touches a block's end may go on in the next one: those pieces are brought
    together and their checksums joined in order, so no task ever holds more ids than one block."""

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for b in batch.itertuples(index=False):
                ids = restore_block(b.planes, list(b.plane_ends), b.n_ids, b.kind)
                at, last = 0, len(b.doc_nos) - 1
                # counts come as 32-bit integers; places among all ids pass these
                for k, (no, doc_id, n) in enumerate(zip(b.doc_nos, b.doc_ids, map(int, b.doc_n_ids), strict=True)):
                    key = None if doc_id is None or doc_id != doc_id else int(doc_id)
                    rows.append((b.shard, int(no), key, b.start + at, n, zlib.crc32(ids[at:at + n]), 0 < k < last))
                    at += n
            out = pd.DataFrame(rows, columns=["shard", "doc_no", "doc_id", "start", "n", "crc", "whole"])
            yield out.astype({"doc_id": "Int64"})

    @F.pandas_udf("long")
    def joined(rows: pd.Series) -> pd.Series:
        out = []
        for pieces in rows:
            crc = 0
            for k, p in enumerate(pieces):
                crc = int(p["crc"]) if k == 0 else crc32_joined(crc, int(p["crc"]), 4 * int(p["n"]))
            out.append(crc)
        return pd.Series(out, dtype="int64")

    found = stage(read_blocks(spark, path)
                  .select("shard", "start", "n_ids", "kind", "planes", "plane_ends", "doc_nos", "doc_ids", "doc_n_ids")
                  .mapInPandas(parts, "shard int, doc_no long, doc_id long, start long, n int, crc long, whole boolean"), "pieces")
    whole = found.where("whole").select("doc_id", "start", F.col("n").cast("long").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
    pieces: Column = F.sort_array(F.collect_list(F.struct("start", "n", "crc")))  # one for each of its blocks
    cut = (found.where("NOT whole").groupBy("shard", "doc_no", "doc_id")
           .agg(F.min("start").alias("start"), F.sum("n").alias("n_tokens"), pieces.alias("_pieces"))
           .select("doc_id", "start", "n_tokens", joined("_pieces").alias("ids_crc32")))
    return whole.unionByName(cut)

"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation (operator 5).

Boundaries come without a regular expression.  Each codepoint is looked up in a class array;
class and following classes give one input symbol per character for a small automaton whose
state says what kind of match is open.  A symbol is a function from state to state; functions
compose associatively, so the text is laid out in lanes, every lane's function is composed
character by character for all lanes at once, a scan over the lanes gives each lane's first
state, and a second pass marks where matches begin.  The slices feed a remembered pair merging.
Ids keep the byte offset at which each ends, from which any part can be decoded.

Defined cases: a null or empty text has no ids and decodes to no bytes; repeated rows each give
a row; all columns, whatever their names, pass unchanged; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import fresh_name, give_back, small_batches
from vantage.llm.merges import merge_pairs

REMEMBER = 400_000     # remembered slices a worker holds at most
LONGEST = 64           # longer slices are merged each time
SHORT = 32             # bytes of a slice that is merged without a heap
CHUNK = 1 << 20        # characters that are scanned together, at least one text

# The letters and numbers of Unicode 16.0, by which the library matches, that are
# unassigned in the tables of Python 3.13 (Unicode 15.1).
LATER_LETTERS = [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
                 (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
                 (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
                 (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
                 (0x1E5F0, 0x1E5F0)]
LATER_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
                 (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]

# codepoint classes
OTHER, LETTER, NUMBER, SPACE, WHITE, QUOTE = range(6)
# input symbols: a space before a non-space, white space before white space or the end, other
# white space before a non-space, and a quote that may open a contraction of 1 or 2 letters
S_OTHER, S_LETTER, S_NUMBER, S_SPACE, S_RUN, S_LAST, S_SHORT, S_LONG = range(8)
# states: nothing open, letters, numbers, others, a space that joins what follows, white space,
# one or two letters of a contraction to come
FRESH, LETTERS, NUMBERS, OTHERS, JOIN, RUN, ONE, TWO = range(8)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, whether a match begins), both by state and symbol."""
    to = np.zeros((8, 8), np.uint8)
    begins = np.ones((8, 8), bool)
    for symbol, state in ((S_LETTER, LETTERS), (S_NUMBER, NUMBERS), (S_OTHER, OTHERS)):
        to[:, symbol] = state
        begins[[state, JOIN], symbol] = False
    to[:, S_SPACE], to[:, S_RUN], to[:, S_LAST] = JOIN, RUN, FRESH
    begins[RUN, S_RUN] = False
    for symbol, state in ((S_SHORT, ONE), (S_LONG, TWO)):
        to[:, symbol] = state
        to[[JOIN, OTHERS], symbol] = OTHERS
        begins[[JOIN, OTHERS], symbol] = False
    to[ONE, S_LETTER], to[TWO, S_LETTER] = FRESH, ONE
    begins[[ONE, TWO], S_LETTER] = False
    return to, begins


NEXT, BEGINS = _automaton()


def _monoid() -> tuple[np.ndarray, np.ndarray]:
    """All functions that runs of symbols stand for, as numbers: (number of "this function, then
    that one", by both numbers; state that a function leads to from FRESH).  Function 0 is the
    identity and 1 + s that of symbol s."""
    found = [tuple(range(8))] + [tuple(NEXT[:, s].tolist()) for s in range(8)]
    number = {f: i for i, f in reversed(list(enumerate(found)))}
    grown = 1
    while grown < len(found):
        f = found[grown]
        grown += 1
        for g in found[1:9]:
            h = tuple(g[x] for x in f)
            if h not in number:
                number[h] = len(found)
                found.append(h)
    then = np.array([[number[tuple(g[x] for x in f)] for g in found] for f in found], np.intp)
    return then, np.array([f[FRESH] for f in found], np.intp)


THEN, FROM_FRESH = _monoid()


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every codepoint, by its general category and the White_Space property in Unicode 16.0."""
    table = np.zeros(sys.maxunicode + 1, np.uint8)
    category = unicodedata.category
    for c in range(sys.maxunicode + 1):
        kind = category(chr(c))[0]
        if kind == "L":
            table[c] = LETTER
        elif kind == "N":
            table[c] = NUMBER
        elif kind == "Z":
            table[c] = WHITE
    for ranges, kind in ((LATER_LETTERS, LETTER), (LATER_NUMBERS, NUMBER)):
        for first, last in ranges:
            table[first:last + 1] = kind
    table[[9, 10, 11, 12, 13, 0x85]] = WHITE
    table[ord(" ")] = SPACE
    table[ord("'")] = QUOTE
    return table


def _symbols(codes: np.ndarray) -> np.ndarray:
    """Input symbol of each character."""
    kind = _classes()[codes]
    white = (kind == SPACE) | (kind == WHITE)
    ahead = np.ones(len(codes), bool)           # white space or the end follows
    ahead[:-1] = white[1:]
    out = np.where(kind == LETTER, np.uint8(S_LETTER), np.where(kind == NUMBER, np.uint8(S_NUMBER), np.uint8(S_OTHER)))
    out[white & ahead] = S_RUN
    out[(kind == SPACE) & ~ahead] = S_SPACE
    out[(kind == WHITE) & ~ahead] = S_LAST
    quotes = np.flatnonzero(kind == QUOTE)
    if len(quotes):
        padded = np.concatenate([codes, np.zeros(2, codes.dtype)])
        one, two = padded[quotes + 1], padded[quotes + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = (np.isin(one, [ord("r"), ord("v")]) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        out[quotes[short]], out[quotes[long]] = S_SHORT, S_LONG
    return out


def boundaries(codes: np.ndarray) -> np.ndarray:
    """Positions at which a match begins in one text, given as codepoints."""
    n = len(codes)
    if n == 0:
        return np.zeros(0, np.int64)
    symbols = _symbols(codes)
    lanes = max(1, min(8192, n // 32))
    steps = -(-n // lanes)
    grid = np.full(lanes * steps, S_LAST, np.uint8)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    # the function of each whole lane
    then, size = THEN.ravel(), len(THEN)
    function = np.zeros(lanes, np.intp)
    for row in grid:
        function = then[function * size + row + 1]
    # inclusive scan over the lanes by doubling: compose each with all before it
    span = 1
    while span < lanes:
        function[span:] = then[function[:-span] * size + function[span:]]
        span *= 2
    state = np.full(lanes, FRESH, np.intp)
    state[1:] = FROM_FRESH[function[:-1]]
    flat_next = NEXT.ravel().astype(np.intp)
    flat_begins = BEGINS.ravel()
    marks = np.empty((steps, lanes), bool)
    for k, row in enumerate(grid):
        at = (state << 3) + row
        marks[k] = flat_begins[at]
        state = flat_next[at]
    return np.flatnonzero(marks.T.ravel()[:n])


def slices(text: str) -> list[str]:
    """The matches of the pattern in ``text``, which they cover without gaps."""
    if not text:
        return []
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    starts = boundaries(codes).tolist()
    return [text[a:b] for a, b in zip(starts, starts[1:] + [len(text)], strict=True)]


class BytePairs:
    """Encoder and decoder for a file of base64 byte strings and their ranks."""

    def __init__(self, ranks_path: str):
        with open(ranks_path, "rb") as f:
            pairs = (line.split() for line in f if line.strip())
            self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        size = max(self.ranks.values()) + 1
        self.bytes = [b""] * size
        for token, rank in self.ranks.items():
            self.bytes[rank] = token
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.decimals = [str(i) for i in range(size)]
        self.single = [bytes([i]) for i in range(256)]
        self.known = _Known(self)

    def __getstate__(self):
        return {**self.__dict__, "known": None}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.known = _Known(self)

    def merge(self, piece: bytes) -> bytes:
        """Ids of one slice, little-endian, 4 bytes each."""
        rank = self.ranks.get(piece)
        if rank is not None:
            return rank.to_bytes(4, "little")
        if len(piece) > SHORT:
            symbols, _ = merge_pairs([self.single[b] for b in piece], self.ranks)
        else:
            symbols = self._merge_short(piece)
        return b"".join(self.ranks[s].to_bytes(4, "little") for s in symbols if s is not None)

    def _merge_short(self, piece: bytes) -> list[bytes]:
        """The same merges on a short slice, where a scan for the lowest rank beats a heap."""
        get, none = self.ranks.get, len(self.bytes)
        symbols = [self.single[b] for b in piece]
        ranks = [get(piece[k:k + 2], none) for k in range(len(piece) - 1)]
        while ranks:
            low = min(ranks)
            if low == none:
                break
            k = ranks.index(low)
            symbols[k] += symbols.pop(k + 1)
            del ranks[k]
            if k < len(ranks):
                ranks[k] = get(symbols[k] + symbols[k + 1], none)
            if k:
                ranks[k - 1] = get(symbols[k - 1] + symbols[k], none)
        return symbols

    def encode_all(self, texts: list[str]) -> list[bytes]:
        return list(self.encode_each(texts))

    def encode_each(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text.  Texts are scanned together up to CHUNK characters."""
        i, known = 0, self.known.__getitem__
        while i < len(texts):
            j, size = i, 0
            while j < len(texts) and (j == i or size + len(texts[j]) <= CHUNK):
                size += len(texts[j]) + 2
                j += 1
            part = texts[i:j]
            if len(part) == 1:
                yield b"".join(map(known, slices(part[0])))
            else:
                yield from self._encode_joined(part)
            i = j

    def _encode_joined(self, texts: list[str]) -> list[bytes]:
        # A text is followed by a space and a line end: they make the text's last white space
        # a run to the end, as it is alone, and the next text begins afresh.
        joined = " \n".join(texts) + " \n"
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths + 2) - 2
        begins = np.zeros(len(codes) + 1, bool)
        begins[boundaries(codes)] = True
        begins[ends], begins[ends + 1], begins[ends + 2] = True, False, True
        starts = np.flatnonzero(begins)
        first = np.searchsorted(starts, ends - lengths)
        last = np.searchsorted(starts, ends)
        starts, known = starts.tolist(), self.known.__getitem__
        pieces = [joined[a:b] for a, b in zip(starts, starts[1:], strict=False)]
        return [b"".join(map(known, pieces[a:b])) for a, b in zip(first.tolist(), last.tolist(), strict=True)]

    def ends(self, ids: bytes) -> bytes:
        """Byte offset at which each id's bytes end, little-endian, 8 bytes each."""
        return np.cumsum(self.lengths[np.frombuffer(ids, "<u4")]).astype("<i8").tobytes()

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode_range(self, ids: bytes, ends: bytes, start: int, stop: int) -> bytes:
        """Bytes ``start`` to ``stop`` of the text, from the ids that cover them only."""
        to = np.frombuffer(ends, "<i8")
        a, b = int(np.searchsorted(to, start, "right")), int(np.searchsorted(to, stop, "left")) + 1
        base = int(to[a - 1]) if a else 0
        return self.decode(ids[4 * a:4 * b])[start - base:max(stop, start) - base]


class _Known(dict):
    def __init__(self, coder: BytePairs):
        super().__init__()
        self.coder = coder

    def __missing__(self, piece: str) -> bytes:
        ids = self.coder.merge(piece.encode("utf-8"))
        if len(piece) <= LONGEST:
            if len(self) >= REMEMBER:
                self.clear()
            self[piece] = ids
        return ids


def _coder(df: DataFrame, ranks_path: str) -> Broadcast:
    """One coder, with its memory, per worker; it goes with the first task that does without it."""
    return df.sparkSession.sparkContext.broadcast(BytePairs(ranks_path))


def encode(df: DataFrame, ranks_path: str, text: str = "text", ids: str = "ids", ends: str = "ends") -> DataFrame:
    """``df`` with the ids of ``text`` (binary, 4 bytes each) and the byte offset at which each id
    ends (binary, 8 bytes each).  ``ranks_path`` names the rank file on the driver."""
    small_batches(df.sparkSession)
    held = _coder(df, ranks_path)

    @F.pandas_udf("ids binary, ends binary")
    def encoded(texts: pd.Series) -> pd.DataFrame:
        coder = held.value
        found = coder.encode_all([t if t is not None else "" for t in texts])
        return pd.DataFrame({"ids": found, "ends": [coder.ends(x) for x in found]})

    both = fresh_name(df, "encoded")
    return (df.withColumn(both, encoded(F.col(text)))
              .withColumns({ids: F.col(both)["ids"], ends: F.col(both)["ends"]}).drop(both))


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes that ``ids`` stand for."""
    small_batches(df.sparkSession)
    held = _coder(df, ranks_path)

    @F.pandas_udf("binary")
    def decoded(found: pd.Series) -> pd.Series:
        coder = held.value
        return pd.Series([coder.decode(x or b"") for x in found], dtype=object)

    return df.withColumn(out, decoded(F.col(ids)))


def digests(df: DataFrame, ranks_path: str, text: str = "text") -> DataFrame:
    """``df`` with n_tokens, ids_sha256 (of the decimal ids with spaces between) and decoded_sha256.
    Each text is encoded and its ids decoded where it lies, so ids never leave the worker; the
    decoded length is held against the last offset."""
    small_batches(df.sparkSession)
    held = _coder(df, ranks_path)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(texts: pd.Series) -> pd.DataFrame:
        coder, rows = held.value, []
        for ids in coder.encode_each([t if t is not None else "" for t in texts]):
            decoded, ends = coder.decode(ids), coder.ends(ids)
            if len(decoded) != int.from_bytes(ends[-8:], "little"):
                raise ValueError("decoded length differs from the last offset")
            decimal = " ".join(map(coder.decimals.__getitem__, np.frombuffer(ids, "<u4").tolist()))
            rows.append((len(ids) // 4, hashlib.sha256(decimal.encode("ascii")).hexdigest(), hashlib.sha256(decoded).hexdigest()))
        give_back()
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    both = fresh_name(df, "digest")
    return (df.withColumn(both, digest(F.col(text)))
              .withColumns({c: F.col(both)[c] for c in ("n_tokens", "ids_sha256", "decoded_sha256")}).drop(both))

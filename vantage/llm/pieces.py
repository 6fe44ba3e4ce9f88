"""Token counts by heap-and-linked-list pair merging (operator 10).

A text's count is its number of initial symbols minus the number of merges; no identifiers are
emitted.  The vocabulary is a SentencePiece BPE model with byte fallback: a character outside
the vocabulary counts its UTF-8 bytes and never merges, so the text may be cut there, and no
piece holds a space after another character, so it may be cut before each run of spaces too.
What lies between two cuts is merged once and remembered.

Defined cases: a null or empty text has no bytes and no tokens; repeated rows each give a row;
every other column, whatever its name, passes unchanged; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from vantage.llm.common import small_batches
from vantage.llm.merges import merge_pairs

SPACE = "▁"
REMEMBER = 800_000   # remembered units a worker holds at most
LONGEST = 64         # longer units are merged each time
_UNIT = re.compile("( *)([^ ]+)")


class PieceCounter:
    """Counts tokens of one SentencePiece BPE model."""

    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.ranks, self.chars = {}, set()
        for i in range(model.get_piece_size()):
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
                continue
            piece = model.id_to_piece(i)
            if len(piece) == 1:
                self.chars.add(piece)
            else:
                self.ranks[piece] = -int(model.get_score(i))
        if any(SPACE in p.lstrip(SPACE) for p in self.ranks):
            raise ValueError("a piece holds a space after another character: texts can't be cut at spaces")
        # neighbours inside some piece; no merge ever joins any other two characters
        self.inner = {p[k:k + 2] for p in self.ranks for k in range(len(p) - 1)}
        # characters outside the vocabulary, at which whole texts are cut fast
        self.newline_cuts = "\n" not in self.chars
        self.spaced, self.bare = _Memory(self, SPACE), _Memory(self, "")

    def unit(self, text: str) -> int:
        """Initial symbols minus merges of one unit."""
        known = self.chars
        outside = sum(len(c.encode("utf-8")) for c in text if c not in known)
        if not outside:
            symbols = list(text)
            return len(symbols) - merge_pairs(symbols, self.ranks)[1]
        inside, run = 0, []
        for c in text + "\n":
            if c in known:
                run.append(c)
            elif run:
                inside += len(run) - merge_pairs(run, self.ranks)[1]
                run = []
        if run:
            inside += len(run) - merge_pairs(run, self.ranks)[1]
        return inside + outside

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = text.replace(SPACE, " ")
        lines = (" " + text).split("\n") if self.newline_cuts else [" " + text]
        total = len(lines) - 1
        for line in lines:
            if "  " in line or line.endswith(" "):
                for spaces, word in _UNIT.findall(line):
                    if len(spaces) == 1:
                        total += self.spaced[word]
                    else:
                        total += self.bare[SPACE * len(spaces) + word]
                tail = len(line) - len(line.rstrip(" "))
                if tail:
                    total += self.bare[SPACE * tail]
            elif line:
                words = line.split(" ")
                if words[0]:
                    total += self.bare[words[0]]
                total += sum(map(self.spaced.__getitem__, words[1:]))
        return total


class _Memory(dict):
    def __init__(self, counter: PieceCounter, prefix: str):
        super().__init__()
        self.counter, self.prefix = counter, prefix

    def __missing__(self, unit: str) -> int:
        end, n = len(unit), 0
        while end > 1 and not unit[end - 1].isalnum() and unit[end - 2:end] not in self.counter.inner:
            end -= 1
            n += self.counter.unit(unit[end])
        if n:
            return self.remember(unit, self[unit[:end]] + n)
        return self.remember(unit, self.counter.unit(self.prefix + unit))

    def remember(self, unit: str, n: int) -> int:
        if len(unit) <= LONGEST:
            if len(self) >= REMEMBER:
                self.clear()
            self[unit] = n
        return n


@lru_cache(maxsize=2)
def _counter(model_path: str) -> PieceCounter:
    return PieceCounter(model_path)


def with_token_counts(df: DataFrame, model_path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``df`` with the column ``out``: the number of tokens of ``text``.  ``model_path`` names the
    model on every executor."""
    small_batches(df.sparkSession)

    @F.pandas_udf(LongType())
    def counts(texts: pd.Series) -> pd.Series:
        count = _counter(model_path).count
        return pd.Series([count(t) if t is not None else 0 for t in texts], dtype="int64")

    return df.withColumn(out, counts(F.col(text)))

"""Toxicity scores over noisy-channel deobfuscated text (operator 3).

A character language model (trigrams with back-off) and a noisy channel give the most likely plain
form of every token that has more than one, and of runs of short neighbouring tokens.  Its characters form a lattice: a symbol may stand for
itself or for the letters it is used for, a separator or the space between tokens may be dropped or
may end a word, and a repeated letter may be dropped.  Viterbi decoding picks the path of highest
channel and language probability; tokens of which no reading can hold a weighted feature are left out.  Restored words are scored: the features of a text are the words
and word beginnings that training text marks as toxic, and a logistic model turns their weights,
over the distinct words of the whole text, into a probability.

Training reads every labelled text as a whole; equal texts count once.  Spark counts the characters'
trigrams, then the texts of either label that each feature occurs in, and fits the logistic model.  All
features are counted in the toxic texts and half of the clean ones; in the other half only those that
may still be chosen.  Only the model comes to the driver, and the names of these, if they are few: the
MODEL_GRAMS most frequent grams and the MAX_FEATURES best features bound its size, not what is counted.
Features are chosen by how much likelier they are in toxic texts than in clean ones, whatever the share
of toxic labels is.  Labels, language, source and ``doc_id`` are never inputs of a score.

Defined cases: a null or empty text, or one without toxic words, scores the model's base rate;
without labels of both kinds every score is the share of label 1 (0 without labels); repeated rows
score alike; other columns, whatever their names, pass unchanged; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from functools import cached_property, lru_cache
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Matrices, Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import fresh_name, give_back, small_batches, stage

MODEL_GRAMS = 200_000  # grams that the character model keeps, the most frequent ones of the whole corpus
MAX_FEATURES = 20_000  # features that the logistic model keeps, the best ones of the whole corpus
CANDIDATES = 100_000   # features that are looked for by name; where more may be chosen, all are counted
HELD = 200_000         # counts a training task holds before it hands them on
KNOWN = 100_000        # words whose features a training task remembers
SLICE = 1 << 18        # characters of text whose tokens are looked up together
RIDGE = 0.003
THRESHOLD = 0.3
REMEMBER = 400_000     # remembered words a worker holds at most
LONGEST = 64           # longer words are decoded each time
READINGS = 200_000     # remembered readings of a few symbols
AHEAD = (3, 6, 12)     # symbols after a choice that are tried for settling it
LEAST_BIAS = -4.0     # a text without features keeps this much doubt, so that one feature can settle it
LEAST_WEIGHT = 0.05    # smaller weights decide nothing, but would have tokens decoded for their sake
NONE: tuple = ()
MIN_TEXTS = 4          # training texts that a feature must occur in
EVIDENCE = math.log(3)   # a feature's share among toxic texts is at least thrice that among clean ones,
DOUBT = 1.3            # even so many standard errors below what was counted
SHORT = 4              # characters of a token that may be a piece of a word
STEMS = (4, 5)         # lengths of word beginnings that are features
PIECE = 6              # symbols of a feature's skeleton that tokens are searched for
WHOLE = 16             # symbols of a word's skeleton that is searched for as a whole, where its first PIECE are found

# What symbols are used for, and which are put between letters.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "+": "t", "|": "il", "€": "e", "¡": "i", "(": "c", "<": "c",
        "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s"}
SEPARATORS = " .-_*~/\\,'`·•​‌‍⁠﻿­"
EDGES = ".,;:!?\"'()[]{}<>*#%&-_~/\\|`=+^…“”‘’«»¿¡"
# log10 costs of the channel
SWAP, DROP, SPLIT, REPEAT = -0.4, -0.2, -0.3, -0.9

_LETTER_THEN = re.compile(r"[^\W\d_][^\w\s]*[^\w\s]|[^\W\d_][\d@$!|+€(<]|[\d@$!|+€(<][^\W\d_]")
_THRICE = re.compile(r"([^\W\d_])\1\1")
_LOOKALIKE = re.compile("[" + "".join(c for c in LEET if ord(c) > 0x400) + "​‌‍⁠﻿­]")


_CHOICE = re.compile("[" + re.escape("".join(LEET) + SEPARATORS) + "]|(.)\\1", re.DOTALL)


def _classes() -> dict[int, str | None]:
    """Symbol -> the least of all that may stand for one another; separators go."""
    kind = {}
    for c, letters in LEET.items():
        joined = {c, *letters}
        joined |= {x for x, k in kind.items() if any(kind.get(y) == k for y in joined)}
        kind.update(dict.fromkeys(joined, min(joined)))
    return {**{ord(c): k for c, k in kind.items()}, **{ord(c): None for c in SEPARATORS}}


CLASSES = _classes()
_REPEATED = re.compile(r"(.)\1+", re.DOTALL)


def skeleton(token: str) -> str:
    """What all readings of a token share: classes of symbols without separators and repeats."""
    return _REPEATED.sub(r"\1", token.translate(CLASSES))


class Wanted:
    """Tells tokens of which some reading may hold one of the features; never wrongly says no."""

    def __init__(self, chosen):
        # what words may begin with, and the whole of words that are not very long
        self.starts: dict[int, set] = defaultdict(set)
        self.wholes: dict[int, set] = defaultdict(set)
        for f in chosen:
            bones = skeleton(f.removesuffix("$"))
            pieces = self.wholes if f.endswith("$") and len(bones) <= WHOLE else self.starts
            bones = bones if pieces is self.wholes else bones[:PIECE]
            pieces[len(bones)].add(bones)

    def __call__(self, token: str) -> bool:
        bones = skeleton(token)
        return any(bones[k:k + n] in pieces for kind in (self.starts, self.wholes) for n, pieces in kind.items()
                   for k in range(len(bones) - n + 1))

    @cached_property
    def _tables(self) -> list[tuple[int, bool, np.ndarray]]:
        return [(n, kind is self.wholes, _table(pieces)) for kind in (self.starts, self.wholes)
                for n, pieces in kind.items() if n <= PIECE]

    @cached_property
    def _longer(self) -> tuple[np.ndarray | None, list[tuple[int, np.ndarray]]]:
        """What longer words begin with, and their wholes."""
        longer = {n: pieces for n, pieces in self.wholes.items() if n > PIECE}
        begin = _table({x[:PIECE] for pieces in longer.values() for x in pieces}) if longer else None
        return begin, [(n, _table(pieces)) for n, pieces in longer.items()]

    def among(self, tokens: list[str]) -> list[str]:
        """The tokens that may hold a feature, and few others.  A word of a reading begins where the token does,
        its edges cut off, or after a separator, and ends likewise; only there are skeletons' pieces looked up,
        by their hashes."""
        if not tokens or not (self.starts or self.wholes):
            return []
        if 0 in self.starts or 0 in self.wholes:
            return tokens
        raw = np.frombuffer(("\n".join(tokens) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
        loose, codes = _loose()[raw], _class_codes()[raw]
        stays = np.flatnonzero(codes != GONE)
        codes, begins, ends = codes[stays], np.append(True, loose[:-1])[stays], np.append(loose[1:], True)[stays]
        # symbols of one class in a row are one, which begins or ends a word if any of them does
        first = np.flatnonzero(np.append(True, (codes[1:] != codes[:-1]) | (codes[1:] == 10)))
        codes, begins, ends = codes[first], np.logical_or.reduceat(begins, first), np.logical_or.reduceat(ends, first)
        at = np.flatnonzero(begins & (codes != 10))
        hit = np.zeros(len(codes), bool)
        for n, whole, table in self._tables:
            here = at[at <= len(codes) - n]
            if whole:
                here = here[ends[here + (n - 1)]]
            hit[here[table[_hashes([codes[here + k] for k in range(n)])]]] = True
        begin, longer = self._longer
        if begin is not None:
            at = at[at <= len(codes) - PIECE]
            at = at[begin[_hashes([codes[at + k] for k in range(PIECE)])]]
        for n, table in longer:
            here = at[at <= len(codes) - n]
            here = here[ends[here + (n - 1)]]
            hit[here[table[_hashes([codes[here + k] for k in range(n)])]]] = True
        return [tokens[k] for k in np.unique(np.cumsum(codes == 10)[hit])]

    def __getstate__(self):
        return {"starts": self.starts, "wholes": self.wholes}


GONE = 0x110000      # the class of what goes


@lru_cache(maxsize=1)
def _class_codes() -> np.ndarray:
    codes = np.arange(GONE, dtype="<u4")
    for c, kind in CLASSES.items():
        codes[c] = GONE if kind is None else ord(kind)
    return codes


@lru_cache(maxsize=1)
def _loose() -> np.ndarray:
    """What may stand beside a word within a token."""
    loose = np.zeros(GONE, bool)
    loose[[ord(c) for c in EDGES + SEPARATORS + "\n"]] = True
    return loose


def _hashes(columns) -> np.ndarray:
    total = np.zeros(len(columns[0]), "<u4")
    for column in columns:
        total = (total * np.uint32(0x9E3779B1)) ^ (column * np.uint32(0x85EBCA6B))
    return total >> np.uint32(12)


def _table(pieces) -> np.ndarray:
    """Which hashes pieces of one length have."""
    table = np.zeros(1 << 20, bool)
    codes = np.array([[ord(c) for c in x] for x in pieces], "<u4")
    table[_hashes(codes.reshape(len(pieces), -1).T)] = True
    return table


def grams_of(words: Counter) -> Counter:
    """Counts of the trigrams of words, with two spaces before and one after; disguised ones are left out."""
    counts: Counter = Counter()
    for word, n in words.items():
        if not word or " " in word or disguised(word):
            continue
        padded = f"  {word} "
        for k in range(len(padded) - 2):
            counts[padded[k:k + 3]] += n
    return counts


class CharModel:
    """Trigram model of characters within words, interpolated with shorter contexts."""

    def __init__(self, counts: dict[str, int]):
        """``counts``: of trigrams; those of shorter grams are sums of theirs."""
        by_order: list[dict] = [defaultdict(float) for _ in range(3)]
        for gram, n in counts.items():
            for order in range(3):
                by_order[order][gram[2 - order:]] += n
        totals: list[dict] = [defaultdict(float) for _ in range(3)]
        for order in range(3):
            for gram, n in by_order[order].items():
                totals[order][gram[:-1]] += n
        self.counts = [dict(c) for c in by_order]
        self.totals = [dict(t) for t in totals]
        self.size = len(self.counts[0]) + 1
        self._log: dict[str, float] = {}
        self.readings: dict[tuple, tuple] = {}

    def log10(self, gram: str) -> float:
        """log10 P(last of three characters | the two before)."""
        found = self._log.get(gram)
        if found is None:
            p = 1.0 / self.size
            for order, strength in ((0, 1.0), (1, 5.0), (2, 5.0)):
                part = gram[2 - order:]
                p = (self.counts[order].get(part, 0.0) + strength * p) / (self.totals[order].get(part[:-1], 0.0) + strength)
            found = self._log[gram] = math.log10(p)
        return found

    def __getstate__(self):
        return {**self.__dict__, "_log": {}, "readings": {}}


def _steps(beams: dict, c: str, model: CharModel) -> dict:
    """The states after one more symbol, each with its best path."""
    if c in SEPARATORS:
        choices = [("", DROP), (" ", SPLIT)]
    else:
        choices = [(c, 0.0)]
        choices += [(x, SWAP) for x in LEET.get(c, "")]
    step: dict[tuple, tuple] = {}
    for (last, raw), (score, path) in beams.items():
        options = list(choices)
        if c == raw and c not in SEPARATORS:
            options.append(("", REPEAT))
        for out, cost in options:
            if out == "" or (out == " " and last[1] == " "):
                state, value, to = (last, c), score + cost, path
            else:
                state = (last[1] + out, c)
                if out == " ":
                    value = score + cost + model.log10(last + " ")
                    state = ("  ", c)
                else:
                    value = score + cost + model.log10(last + out)
                to = (out, path)
            if state not in step or value > step[state][0]:
                step[state] = (value, to)
    return step


def _read(last: str, raw: str, ahead: str, ends: bool, model: CharModel) -> tuple | None:
    """(symbols read, what they give, the last two characters then) of the shortest start of ``ahead``
    after which one state is left, so that nothing that follows changes its reading.  Without one:
    the best reading of all of ``ahead`` if the token ``ends`` there, else None."""
    # state: the last two emitted characters; value: (score, emitted so far as a linked pair)
    beams: dict[tuple, tuple] = {(last, raw): (0.0, None)}
    n, path = 0, None
    for n, c in enumerate(ahead, 1):
        beams = _steps(beams, c, model)
        if len(beams) == 1:
            ((last, _), (_, path)), = beams.items()
            break
    else:
        if not ends:
            return None
        best = -math.inf
        for (at, _), (score, to) in beams.items():
            score += model.log10(at + " ") if at[1] != " " else 0.0
            if score > best:
                best, path, last = score, to, at
    out = []
    while path is not None:
        out.append(path[0])
        path = path[1]
    return n, "".join(reversed(out)), last


def _settle(token: str, at: int, last: str, model: CharModel) -> tuple:
    """``_read`` from ``at`` on, as far as it takes; readings of a few symbols are remembered by them,
    the symbol before them, the two characters before, and whether the token ends there."""
    known, raw = model.readings, token[at - 1:at] if at else ""
    for n in (*AHEAD, len(token)):
        ahead, ends = token[at:at + n], at + n >= len(token)
        key = (last, raw + ahead, ends)
        read = known.get(key) if at else None
        if read is None:
            read = _read(last, raw, ahead, ends, model)
            if read is not None and at and n <= AHEAD[-1]:
                if len(known) >= READINGS:
                    known.clear()
                known[key] = read
        if read is not None:
            return read
    raise AssertionError("the whole token was read")


def restore(token: str, model: CharModel) -> str:
    """The most likely plain form of a lower-case token; may hold spaces.

    Where one state is left the best path up to there is settled.  So symbols without a choice stand
    as they are, and the reading of a choice with the few symbols after it is remembered by them and
    what stands before."""
    out, at, last, known, size = [], 0, "  ", model.readings, len(token)
    while at < size:
        if not (at and token[at] == token[at - 1]):
            found = _CHOICE.search(token, at)
            start = size if found is None else found.start() + (found.group(1) is not None)
            if start > at:
                out.append(token[at:start])
                last = (last + token[at:start])[-2:]
                at = start
                continue
        read = known.get((last, token[at - 1:at + 3], at + 3 >= size)) if at else None
        if read is None:
            read = _settle(token, at, last, model)
        at, last = at + read[0], read[2]
        out.append(read[1])
    return "".join(out)


def disguised(token: str) -> bool:
    """Looks unlike a plain word, so the character model doesn't learn from it."""
    return "_" in token or bool(_LETTER_THEN.search(token) or _THRICE.search(token) or _LOOKALIKE.search(token))


class _ShortCores(dict):
    """Token -> what is left without its edges if that is short, else None."""

    def __missing__(self, token: str) -> str | None:
        core = token.strip(EDGES)
        found = core if len(core) <= SHORT else None
        if len(token) <= LONGEST:
            if len(self) >= KNOWN:
                self.clear()
            self[token] = found
        return found


_short_core = _ShortCores().__getitem__


def tokens_of(text: str) -> set[str]:
    """The distinct lower-case tokens of a text, edges cut off; single characters in a row of three
    or more are one token (with spaces between them), and so are two or more short tokens in a row."""
    words = text.lower().split()
    more, single, row, run = set(), set(), [], []
    for token, core in zip(words, map(_short_core, words)):  # noqa: B905
        if core is None:
            if run:
                _add_run(more, run)
                run = []
        else:
            if core:
                run.append(core)
            if len(token) <= 2 and len(core or token) == 1:
                row.append(core or token)
                single.add(token)
                continue
        if row:
            _add_row(more, row)
            row = []
    if row:
        _add_row(more, row)
    _add_run(more, run)
    out = set(words)
    out -= single
    out |= more
    return out


def _add_row(out: set[str], row: list[str]) -> None:
    if len(row) > 2:
        out.add(" ".join(row))
    else:
        out.update(row)


def _add_run(out: set[str], run: list[str]) -> None:
    # letters alone are a token already
    if len(run) > 1 and max(map(len, run)) > 1:
        out.add(" ".join(run))


class Restorer:
    def __init__(self, model: CharModel):
        self.model = model

    def words(self, token: str, wanted: Wanted | None = None) -> tuple[str, ...]:
        """Plain words of one token; restored ones only if they may hold a wanted feature."""
        core = token.strip(EDGES)
        if not core:
            return ()
        pieces = core.split(" ")
        joined = len(pieces) > 1 and max(map(len, pieces)) > 1
        # the pieces of a run are tokens themselves: only what they give together counts
        own = pieces if joined else [core]
        found = [] if joined else [core]
        if _CHOICE.search(core) and (wanted is None or wanted(core)):
            # a trailing or leading symbol may be part of the word: both readings count
            found += [w for w in restore(core, self.model).split() if w not in own]
        return tuple(dict.fromkeys(found))


def features(word: str) -> list[str]:
    return [word + "$"] + [word[:n] for n in STEMS if len(word) >= n]


class Scorer:
    """Weights of features and the restorer; texts in, probabilities out."""

    def __init__(self, restorer: Restorer, weights: dict[str, float], bias: float):
        self.restorer, self.weights, self.bias = restorer, weights, bias
        self.wanted = Wanted(weights)
        self.seen: set[str] = set()
        self.known: dict[str, float] = {}      # weights of the seen tokens that have one

    def token_weight(self, token: str) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for w in self.restorer.words(token) for f in features(w))

    def weighted(self, texts: list[str | None]) -> Iterator[dict[str, float]]:
        """Per text, its distinct tokens that have a weight."""
        at = 0
        while at < len(texts):
            found, size = [], 0
            while at < len(texts) and (not found or size < SLICE):
                text = texts[at] or ""
                found.append(tokens_of(text))
                size, at = size + len(text), at + 1
            tokens = set().union(*found)
            new = tokens - self.seen
            if len(self.seen) + len(new) > REMEMBER:
                self.seen, self.known, new = set(), {}, tokens
            for token in self.wanted.among(list(new)):
                weight = self.token_weight(token)
                if weight:
                    self.known[token] = weight
            known, held = self.known, set(self.known)
            for one in found:
                yield {token: known[token] for token in one & held}
            self.seen.update(t for t in new if len(t) <= LONGEST)
            for token in [t for t in new & held if len(t) > LONGEST]:
                del known[token]

    def scores(self, texts: list[str | None]) -> list[float]:
        return [1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, self.bias + math.fsum(found.values())))))
                for found in self.weighted(texts)]

    def score(self, text: str | None) -> float:
        return self.scores([text])[0]

    def __getstate__(self):
        return {**self.__dict__, "seen": set(), "known": {}}


def evidence(a: int, c: int, toxic: int, clean: int) -> float:
    """Lower bound of the log ratio of a feature's shares among ``toxic`` and ``clean`` texts, of which
    ``a`` and ``c`` hold it.  It does not depend on how many texts of either kind were read."""
    ratio = math.log((a + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
    spread = 1 / (a + 0.5) - 1 / (toxic + 1) + 1 / (c + 0.5) - 1 / (clean + 1)
    return ratio - DOUBT * math.sqrt(max(spread, 0.0))


def fit(texts: list[str], labels: list[int]) -> Scorer:
    """``fit_from`` for a few texts in a list, without Spark: character model from the words of all
    texts, feature weights by logistic regression with a ridge penalty."""
    once = list({t: y for t, y in zip(texts, labels, strict=True)}.items())
    words: Counter = Counter()
    for t, _ in once:
        words.update(cores_of(t))
    restorer = Restorer(CharModel(grams_of(words)))
    y = np.array([y for _, y in once], float)
    if not len(y) or y.min() == y.max():
        return _without_features(restorer, float(y.mean()) if len(y) else 0.0)

    toxic: Counter = Counter()
    for t, label in once:
        if label:
            toxic.update({f for token in tokens_of(t) for w in restorer.words(token) for f in features(w)})
    toxic = Counter({f: n for f, n in toxic.items() if n >= MIN_TEXTS})
    wanted = Wanted(toxic)
    seen: dict[str, tuple] = {}      # token -> its features that toxic texts have; most have none

    def features_of(text: str) -> Counter:
        found: Counter = Counter()
        for token in tokens_of(text):
            known = seen.get(token)
            if known is None:
                known = seen[token] = tuple(f for w in restorer.words(token, wanted) for f in features(w) if f in toxic) or NONE
            found.update(known)
        return found

    clean: Counter = Counter()
    for t, label in once:
        if not label:
            clean.update(features_of(t).keys())
    base = y.mean()
    n_toxic = int(y.sum())
    chosen = []
    for f, a in toxic.items():
        low = evidence(a, clean[f], n_toxic, len(y) - n_toxic)
        if low > EVIDENCE:
            chosen.append((low * math.log(1 + a), f))
    chosen = [f for _, f in sorted(chosen, reverse=True)]
    number = {f: k for k, f in enumerate(chosen)}
    seen = {token: tuple(f for f in known if f in number) or NONE for token, known in seen.items()}
    toxic = Counter({f: toxic[f] for f in chosen})
    at_row, at_col, value = [], [], []
    for i, (t, _) in enumerate(once):
        for f, v in features_of(t).items():
            k = number.get(f)
            if k is not None:
                at_row.append(i)
                at_col.append(k)
                value.append(min(v, 3))
    i, k, v = np.array(at_row, int), np.array(at_col, int), np.array(value, float)
    w, b = np.zeros(len(chosen)), math.log(base / (1 - base))
    rate = np.zeros(len(chosen) + 1)
    for _ in range(300):   # full-batch descent with a step per coordinate
        margin = b + np.bincount(i, w[k] * v, len(y)) if len(chosen) else np.full(len(y), b)
        error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y
        g = np.append((np.bincount(k, error[i] * v, len(chosen)) if len(chosen) else []) + RIDGE * w, error.sum())
        rate = 0.95 * rate + g * g
        move = 0.3 * g / np.sqrt(rate + 1e-6)
        w, b = np.maximum(w - move[:-1], 0.0), max(b - move[-1], LEAST_BIAS)
    return Scorer(restorer, {f: float(x) for f, x in zip(chosen, w, strict=True) if x > LEAST_WEIGHT}, float(b))


def cores_of(text: str) -> list[str]:
    return [word.strip(EDGES) for word in set(text.lower().split())]


def _without_features(restorer: Restorer, share: float) -> Scorer:
    return Scorer(restorer, {}, math.log((share + 1e-9) / (1 - share + 1e-9)))


def training_texts(docs: DataFrame, labels: DataFrame, text: str, label: str, key: str) -> DataFrame:
    """(t, y): every labelled text once; of equal texts the label of the row whose ``key`` has the
    largest hash counts (of repeated labels of a ``key``, 1)."""
    known = (labels.where(F.col(label).isNotNull()).groupBy(F.col(key).alias("k"))
             .agg(F.max((F.col(label).cast("int") != 0).cast("long")).alias("y")))
    # labels grow with the texts, so neither side is broadcast; theirs is the small one, texts are not sorted
    texts = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t")).join(known.hint("shuffle_hash"), "k")
    # hash and label in one number, so that texts are grouped by hashing, without a sort
    rank = F.xxhash64("k").bitwiseAND(F.lit(-2)).bitwiseOR(F.col("y"))
    return texts.groupBy("t").agg(F.max(rank).alias("r")).select("t", F.col("r").bitwiseAND(F.lit(1)).cast("int").alias("y"))


def gram_counts(texts: DataFrame) -> DataFrame:
    """(gram, n): how often each trigram occurs in the plain words of all texts, a text's distinct words once."""
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: Counter = Counter()

        def grams() -> pd.DataFrame:
            cores: Counter = Counter()
            for word, n in words.items():
                cores[word.strip(EDGES)] += n
            words.clear()
            found = grams_of(cores)
            return pd.DataFrame({"gram": list(found), "n": list(found.values())})

        for batch in batches:
            for t in batch["t"]:
                words.update(set(t.lower().split()))
                if len(words) > HELD:
                    yield grams()
            give_back()
        yield grams()

    return texts.select("t").mapInPandas(counted, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _handed_on(counts: tuple[Counter, Counter]) -> Iterator[pd.DataFrame]:
    """What was counted since the last time; nothing instead of a frame without rows, which Spark can't convert."""
    clean, toxic = counts
    names = list(clean.keys() | toxic.keys())
    if names:
        yield pd.DataFrame({"feature": names, "toxic": [toxic[f] for f in names], "clean": [clean[f] for f in names]})
    clean.clear()
    toxic.clear()


def feature_counts(texts: DataFrame, restorer: Restorer) -> DataFrame:
    """(feature, toxic, clean): in how many texts of either label each feature occurs."""
    held = texts.sparkSession.sparkContext.broadcast(restorer)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, known = held.value.words, {}
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        for batch in batches:
            for t, y in zip(batch["t"], batch["y"], strict=True):
                tokens = list(tokens_of(t))
                owns = list(map(known.get, tokens))
                for k, own in enumerate(owns):
                    if own is None:
                        token = tokens[k]
                        owns[k] = own = tuple(f for w in words(token) for f in features(w)) or NONE
                        # runs of tokens hardly ever come again
                        if len(token) <= LONGEST and " " not in token:
                            if len(known) >= KNOWN:
                                known.clear()
                            known[token] = own
                found = set().union(*owns)
                counts[y].update(found)
                if len(counts[0]) + len(counts[1]) > HELD:
                    yield from _handed_on(counts)
            give_back()
        yield from _handed_on(counts)

    return (texts.mapInPandas(counted, "feature string, toxic long, clean long")
            .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def counts_among(texts: DataFrame, restorer: Restorer, names: list[str]) -> DataFrame:
    """``feature_counts`` of the features in ``names`` alone; tokens that can't hold one are not decoded."""
    held = texts.sparkSession.sparkContext.broadcast(Scorer(restorer, dict.fromkeys(names, 1.0), 0.0))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer, own = held.value, {}
        words, wanted = scorer.restorer.words, scorer.weights
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for found, y in zip(scorer.weighted(batch["t"].tolist()), batch["y"], strict=True):
                for token in found.keys() - own.keys():
                    own[token] = [f for w in words(token) for f in features(w) if f in wanted]
                counts[y].update({f for token in found for f in own[token]})
                if len(own) > KNOWN:
                    own.clear()
            give_back()
        yield from _handed_on(counts)

    return (texts.mapInPandas(counted, "feature string, toxic long, clean long")
            .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def candidate_counts(texts: DataFrame, restorer: Restorer, n_toxic: int, n_clean: int, most: int = CANDIDATES) -> DataFrame:
    """``feature_counts`` with the whole counts of all features that ``choose_features`` may take; others may lack.

    Further clean texts never bring a feature above EVIDENCE that was not above it, so the toxic texts and half
    of the clean ones tell which features the other half is searched for.  If these are more than ``most``, all
    features are counted there too, with the same result."""
    first = (F.col("y") == 1) | (F.pmod(F.xxhash64("t"), F.lit(2)) == 0)
    known = stage(_likely(feature_counts(texts.where(first), restorer), n_toxic, n_clean).drop("low"), "toxic-features")
    names = [r["feature"] for r in known.select("feature").limit(most + 1).collect()]
    if not names:
        return known
    rest = texts.where(~first)
    more = feature_counts(rest, restorer) if len(names) > most else counts_among(rest, restorer, names)
    return known.unionByName(more).groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _likely(counts: DataFrame, n_toxic: int, n_clean: int) -> DataFrame:
    """The features that are likelier in toxic texts beyond doubt, with their evidence ``low``."""
    @F.pandas_udf("double")
    def low(toxic: pd.Series, clean: pd.Series) -> pd.Series:
        return pd.Series([evidence(a, c, n_toxic, n_clean) for a, c in zip(toxic, clean, strict=True)], dtype="float64")

    # asked for once: else the condition is computed beside the column, by a second worker for each task
    once = low.asNondeterministic()
    return counts.where(F.col("toxic") >= MIN_TEXTS).withColumn("low", once("toxic", "clean")).where(F.col("low") > EVIDENCE)


def choose_features(counts: DataFrame, n_toxic: int, n_clean: int, most: int = MAX_FEATURES) -> list[str]:
    """The features that are likelier in toxic texts beyond doubt, best first."""
    rows = _likely(counts, n_toxic, n_clean).select("feature", (F.col("low") * F.log1p("toxic")).alias("rank"))
    return [r["feature"] for r in rows.orderBy(F.desc("rank"), "feature").limit(most).collect()]


def fit_weights(texts: DataFrame, restorer: Restorer, chosen: list[str], n_texts: int) -> tuple[list[float], float]:
    """Weights, none below zero, and bias of a logistic regression with a ridge penalty over all texts;
    those of the same features and label are one weighted row."""
    number = {f: k for k, f in enumerate(chosen)}
    held = texts.sparkSession.sparkContext.broadcast(Scorer(restorer, dict.fromkeys(chosen, 1.0), 0.0))

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer, words, own = held.value, held.value.restorer.words, {}
        for batch in batches:
            at, value = [], []
            for found in scorer.weighted(batch["t"].tolist()):
                for token in found.keys() - own.keys():
                    own[token] = [number[f] for w in words(token) for f in features(w) if f in number]
                n = Counter(k for token in found for k in own[token])
                if len(own) > KNOWN:
                    own.clear()
                at.append(sorted(n))
                value.append([float(min(n[k], 3)) for k in sorted(n)])
            yield pd.DataFrame({"at": at, "value": value, "y": batch["y"].astype(float).tolist()})
            give_back()

    size = len(chosen)
    # by Arrow as all else here: other workers with a daemon of their own would stand beside these
    sparse = F.udf(lambda at, value: Vectors.sparse(size, at, value), VectorUDT(), useArrow=True)
    rows = stage(texts.mapInPandas(vectors, "at array<int>, value array<double>, y double")
                 .groupBy("at", "value", "y").agg(F.count(F.lit(1)).cast("double").alias("n")), "toxic-vectors")
    model = LogisticRegression(
        featuresCol="x", labelCol="y", weightCol="n", regParam=RIDGE / n_texts, standardization=False, maxIter=100,
        lowerBoundsOnCoefficients=Matrices.dense(1, size, [0.0] * size), lowerBoundsOnIntercepts=Vectors.dense([LEAST_BIAS]),
    ).fit(rows.select(sparse("at", "value").alias("x"), "y", "n"))
    return model.coefficients.toArray().tolist(), float(model.intercept)


def fit_from(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "label", key: str = "doc_id") -> Scorer:
    """Fit on all labelled texts, each as a whole."""
    small_batches(docs.sparkSession)
    texts = stage(training_texts(docs, labels, text, label, key), "toxic-texts")
    n = {r["y"]: r["n"] for r in texts.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_clean, n_toxic = n.get(0, 0), n.get(1, 0)
    if not (n_clean and n_toxic):
        return _without_features(Restorer(CharModel({})), float(n_toxic > 0))
    grams = gram_counts(texts).orderBy(F.desc("n"), "gram").limit(MODEL_GRAMS).collect()
    restorer = Restorer(CharModel({r["gram"]: r["n"] for r in grams}))
    chosen = choose_features(candidate_counts(texts, restorer, n_toxic, n_clean), n_toxic, n_clean)
    if not chosen:
        return Scorer(restorer, {}, max(math.log(n_toxic / n_clean), LEAST_BIAS))
    weights, bias = fit_weights(texts, restorer, chosen, n_toxic + n_clean)
    return Scorer(restorer, {f: x for f, x in zip(chosen, weights, strict=True) if x > LEAST_WEIGHT}, bias)


def with_scores(df: DataFrame, scorer: Scorer, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the probability of label 1."""
    small_batches(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast(scorer)

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        found = pd.Series(held.value.scores(texts.tolist()), dtype="float64")   # one object, with its memory, per worker
        give_back()
        return found

    return df.withColumn(out, scores(F.col(text)))


def without_toxic(df: DataFrame, scorer: Scorer, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` that score below the threshold, all columns as they were."""
    score = fresh_name(df, "score")
    return with_scores(df, scorer, text, score).where(F.col(score) < threshold).drop(score)

"""Language-model scores with a log-bilinear neural model (operator 9).

Token counts over the whole training corpus are made by Spark.  Every word that occurs as often as
``own_count`` asks (and at least the SHORTLIST most frequent), the end of a text and one class for the
rarer words are the model's outputs and have embeddings as its inputs, the two tokens before: the
vocabulary grows with the corpus.  The log-bilinear model predicts a vector from the context's
embeddings, each weighted by coordinate and position, and scores an output by its dot product with
that vector plus a bias.  Outputs are factored: the HEAD most frequent words, the class of the rarer
and the end stand beside classes of the remaining words, neighbours in frequency, about a quarter as
many classes as a class has words; a word of a class is scored within it by the same vector.

The model is trained in numpy by noise-contrastive estimation.  Each text is turned once into the
numbers of its outputs, which training and scoring read.  Training texts are dealt into shares by a
hash of key and text; a task trains on one share after the other, each from the round's parameters and
with a seed of its own, so scores do not depend on partitions (beyond rounding).  A share hands on only
the parameter rows that it moved; they are averaged in blocks of rows, in a tree of bounded groups,
each row by how often the shares met its word.  Each round takes another part of the shares and all
rounds take all of them.

A score sums normalised log10 probabilities: both softmaxes are computed by batched matrix products;
a word of the class of others also has its add-one share of that class, in which one more type stands
for the words that training never saw.

Counts of frequent words (FREQUENT at most, or all with an output of their own) are broadcast; other
words are joined with their counts by word, so no table of all words is ever in one place.

Defined cases: a null or empty text is its end token alone; without training texts every count is
0 and the model is uniform over its outputs; repeated rows score alike and give a row each; an
empty table gives no rows.
"""

from __future__ import annotations

import copy
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.llm.common import small_batches, stage, text_bytes

SHORTLIST = 512       # words with an output of their own, at least
HEAD = 64             # words that stand beside the classes
DIMENSION = 16        # of an embedding
NOISE = 32            # noise outputs that a batch of tokens is held against
INNER_NOISE = 8       # noise words that the tokens of a class in a batch are held against
BATCH = 2048, 16384    # tokens of one step, at a share's beginning and from GROWN times as many tokens on
GROWN = 64
CHUNK = 1 << 16       # tokens that are shuffled together
ROUNDS = 2            # each takes another part of the shares
SHARE_TOKENS = 4_000_000   # tokens of the texts that are trained on together, about
RATE = 0.1            # step size (AdaGrad, one sum of squares a row)
FREQUENT = 200_000    # words whose counts are broadcast, at most
FANIN = 32            # shares averaged by one task
BLOCK = 1024          # parameter rows that are averaged together
CACHED = 1024         # words whose contexts keep their normalisers
SLICE = 1 << 16       # tokens scored together


def own_count(tokens: int) -> float:
    """Occurrences that give a word an output of its own: a twelfth of the square root of the tokens,
    which by Zipf's law some 10^5 words reach in 30 GB of text and about 2 * 10^6 in 100 TB, where the
    model then takes 0.5 GB."""
    return max(2.0, tokens ** 0.5 / 12)


class Ranks(dict):
    """Words to ranks; others have -1."""

    def __missing__(self, word: bytes) -> int:
        return -1


@dataclass
class Vocabulary:
    """Frequent words with counts, most frequent first, and the corpus totals."""

    words: list[bytes]
    counts: np.ndarray
    tokens: int               # N, with one end for each text
    types: int                # V, with the end
    texts: int
    shortlist: int | None = None
    rank: Ranks = field(default_factory=Ranks)

    def __post_init__(self):
        self.rank = Ranks(zip(self.words, range(len(self.words)), strict=True))
        if self.shortlist is None:
            self.shortlist = max(SHORTLIST, int((self.counts >= own_count(self.tokens)).sum()))
        self.shortlist = min(self.shortlist, len(self.words))
        self.other, self.end = self.shortlist, self.shortlist + 1
        self.outputs = self.shortlist + 2
        inside = int(self.counts[:self.shortlist].sum())
        self.other_tokens = self.tokens - self.texts - inside
        self.other_types = max(0, self.types - 1 - self.shortlist)
        # log10 of the add-one total of the class of others, with one type for unseen words
        self.log_other = float(np.log10(self.other_tokens + self.other_types + 1))
        self.log_counts = np.log10(self.counts + 1.0)

    def noise(self) -> np.ndarray:
        seen = np.append(self.counts[:self.shortlist], [self.other_tokens, self.texts]).astype(np.float64) + 1.0
        return seen / seen.sum()

    def ranks(self, text: bytes) -> tuple[np.ndarray, list[bytes]]:
        """Rank of each word, -1 for a word that is not frequent, and the words."""
        words = text.lower().split()
        return np.fromiter(map(self.rank.__getitem__, words), np.int64, len(words)), words

    def ids(self, ranks: np.ndarray) -> np.ndarray:
        """Outputs of a text's tokens, its end last."""
        out = np.where((ranks >= 0) & (ranks < self.shortlist), ranks, self.other)
        return np.append(out, self.end)


class LogBilinear:
    """Parameters: input embeddings, output embeddings and biases (of outputs, then of classes), one
    weight per coordinate and context position.  The last two outputs are the class of rarer words and the end."""

    CONTEXT = 2

    def __init__(self, noise: np.ndarray, seed: int = 1):
        random = np.random.default_rng(seed)
        n = len(noise)
        self.noise = noise
        head = min(HEAD, n - 2)
        count = int(np.ceil(np.sqrt(n - 2 - head) / 2))
        # class c holds the outputs from starts[c] up to starts[c + 1]
        self.starts = np.linspace(head, n - 2, count + 1).astype(np.int64) if count else np.array([head])
        # rows of the first softmax, and the row there of each output
        self.top = np.concatenate([np.arange(head), [n - 2, n - 1], n + np.arange(count)])
        self.first = np.arange(n)
        self.first[head:n - 2] = n + np.repeat(np.arange(count), np.diff(self.starts))
        self.below = np.concatenate([[0.0], np.cumsum(noise)])
        mass = np.concatenate([noise, np.diff(self.below[self.starts])])
        self.top_steps = np.cumsum(mass[self.top] / mass[self.top].sum())
        # log probability of a row as noise: in the first softmax, or within its class
        self.log_noise = np.log(mass).astype(np.float32)
        self.log_noise[head:n - 2] -= self.log_noise[self.first[head:n - 2]]
        self.inputs = random.normal(0, 0.1, (n, DIMENSION)).astype(np.float32)
        self.outputs = random.normal(0, 0.1, (n + count, DIMENSION)).astype(np.float32)
        self.bias = self.log_noise.copy()
        self.mix = np.ones((self.CONTEXT, DIMENSION), np.float32)
        self._log_z = self._mixed = None

    def table(self, squares: list[np.ndarray]) -> np.ndarray:
        """All parameters as rows: inputs, outputs with their biases, context weights, each beside the
        sums of squares that go with it."""
        n, m = len(self.inputs), len(self.outputs)
        out = np.zeros((n + m + self.CONTEXT, DIMENSION + 3), np.float32)
        out[:n, :-3], out[n:n + m, :-3], out[n + m:, :-3] = self.inputs, self.outputs, self.mix
        out[n:n + m, -3], out[n:n + m, -1] = self.bias, squares[2]
        out[:n, -2], out[n:n + m, -2], out[n + m:, -2] = squares[0], squares[1], squares[3].mean(1)
        return out

    def take_table(self, rows: np.ndarray) -> tuple[LogBilinear, list[np.ndarray]]:
        """The model with the parameters of ``rows``, and their sums of squares."""
        n, m = len(self.inputs), len(self.outputs)
        rows = rows.astype(np.float32)
        self.inputs, self.outputs, self.mix = rows[:n, :-3].copy(), rows[n:n + m, :-3].copy(), rows[n + m:, :-3].copy()
        self.bias = rows[n:n + m, -3].copy()
        self._log_z = None
        mixed = np.repeat(rows[n + m:, -2:-1], DIMENSION, axis=1)
        return self, [rows[:n, -2].copy(), rows[n:n + m, -2].copy(), rows[n:n + m, -1].copy(), mixed]

    def predicted(self, context: np.ndarray) -> np.ndarray:
        return sum(self.inputs[context[:, j]] * self.mix[j] for j in range(self.CONTEXT))

    def train(self, context: np.ndarray, target: np.ndarray, squares: list[np.ndarray], random) -> None:
        """One step of noise-contrastive estimation; the noise of the first softmax is shared by the
        batch, that within a class by the batch's tokens of the class."""
        n = len(self.noise)
        order = np.argsort(target, kind="stable")       # tokens of a word, and of a class, side by side
        context, target = context[order], target[order]
        rows = self.first[target]
        noise = self.top[np.searchsorted(self.top_steps, random.random(NOISE), "right").clip(max=len(self.top) - 1)]
        level = self.bias - self.log_noise
        met = [self.inputs[context[:, j]] for j in range(self.CONTEXT)]
        q = sum(x * c for x, c in zip(met, self.mix, strict=True))
        own = self.outputs[rows]
        true = np.einsum("ij,ij->i", q, own) + level[rows] - np.float32(np.log(NOISE))
        false = q @ self.outputs[noise].T + (level[noise] - np.float32(np.log(NOISE)))
        up, down = _sigmoid(true) - 1, _sigmoid(false)
        dq = down @ self.outputs[noise]
        dq += np.multiply(up[:, None], own, out=own)
        at, moves, shifts = [noise], [down.T @ q], [down.sum(0)]
        words, (of_true, of_shift) = _runs(rows, up[:, None] * q, up)
        at, moves, shifts = at + [words], moves + [of_true], shifts + [of_shift]
        inner = np.flatnonzero(rows >= n)
        if len(inner):
            bounds = np.flatnonzero(np.diff(rows[inner])) + 1
            up = np.empty(len(inner), np.float32)
            less = np.float32(np.log(INNER_NOISE))
            for a, b in zip([0, *bounds.tolist()], [*bounds.tolist(), len(inner)], strict=True):
                here = inner[a:b]
                low, high = self.starts[rows[here[0]] - n:][:2]
                drawn = random.random(INNER_NOISE) * (self.below[high] - self.below[low]) + self.below[low]
                drawn = np.clip(np.searchsorted(self.below, drawn, "right") - 1, low, high - 1)
                p, mine, other = q[here], target[here], self.outputs[drawn]
                own = self.outputs[mine]
                up[a:b] = _sigmoid(np.einsum("ij,ij->i", p, own) + level[mine] - less) - 1
                down = _sigmoid(p @ other.T + (level[drawn] - less))
                own *= up[a:b, None]
                own += down @ other
                dq[here] += own
                at.append(drawn)
                moves.append(down.T @ p)
                shifts.append(down.sum(0))
            words, (of_true, of_shift) = _runs(target[inner], up[:, None] * q[inner], up)
            at, moves, shifts = at + [words], moves + [of_true], shifts + [of_shift]
        mixed = np.stack([np.einsum("ij,ij->j", x, dq) for x in met])
        back = np.concatenate([dq * c for c in self.mix])
        of_rows, (of_outputs, of_bias) = _summed(np.concatenate(at), np.concatenate(moves), np.concatenate(shifts))
        of_words, (of_inputs,) = _summed(context.T.ravel(), back)
        size = np.float32(len(target))
        for p, s, where, g in ((self.inputs, squares[0], of_words, of_inputs), (self.outputs, squares[1], of_rows, of_outputs)):
            g /= size
            s[where] += np.einsum("ij,ij->i", g, g) / DIMENSION
            p[where] -= RATE * g / np.sqrt(s[where] + 1e-8)[:, None]
        of_bias = of_bias / size
        squares[2][of_rows] += of_bias * of_bias
        self.bias[of_rows] -= RATE * of_bias / np.sqrt(squares[2][of_rows] + 1e-8)
        mixed /= size
        squares[3] += mixed * mixed
        self.mix -= RATE * mixed / np.sqrt(squares[3] + 1e-8)

    def squares(self) -> list[np.ndarray]:
        """The sums of squares that ``train`` keeps, at their beginning."""
        return [np.zeros(len(self.inputs), np.float32), np.zeros(len(self.outputs), np.float32),
                np.zeros(len(self.bias), np.float32), np.zeros_like(self.mix)]

    def log10(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Normalised log10 P(target | context)."""
        parts = [self._log(context[a:a + SLICE], target[a:a + SLICE]) for a in range(0, len(target), SLICE)]
        return np.concatenate(parts) / np.log(10) if parts else np.zeros(0)

    def _log(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        n = len(self.noise)
        size = min(CACHED, n - 2) + 2
        if self._log_z is None:
            self._log_z = np.full(size ** 2, np.nan)
            self._mixed = [self.inputs * m for m in self.mix]
            self._top = np.ascontiguousarray(self.outputs[self.top].T), self.bias[self.top]
        code, back = np.unique(context[:, 0] + n * context[:, 1], return_inverse=True)
        pair = np.stack([code % n, code // n])
        q = sum(m[i] for m, i in zip(self._mixed, pair, strict=True))
        # normalisers of contexts of frequent words are kept
        short = np.where(pair >= n - 2, pair - n + size, pair)
        kept = ((pair >= n - 2) | (pair < size - 2)).all(0)
        slot = short[0] + size * short[1]
        z = np.full(len(code), np.nan)
        z[kept] = self._log_z[slot[kept]]
        new = np.flatnonzero(np.isnan(z))
        for a in range(0, len(new), 4096):
            part = new[a:a + 4096]
            z[part] = _log_sum(q[part] @ self._top[0] + self._top[1])
        self._log_z[slot[kept]] = z[kept]
        q, rows = q[back], self.first[target]
        log = np.einsum("ij,ij->i", q, self.outputs[rows]) + self.bias[rows] - z[back]
        inner = np.flatnonzero(rows >= n)
        if len(inner):
            inner = inner[np.argsort(rows[inner], kind="stable")]
            for at in np.split(inner, np.flatnonzero(np.diff(rows[inner])) + 1):
                low, high = self.starts[rows[at[0]] - n:][:2]
                scores = q[at] @ self.outputs[low:high].T + self.bias[low:high]
                log[at] += scores[np.arange(len(at)), target[at] - low] - _log_sum(scores)
        return log

    def __getstate__(self):
        return {**self.__dict__, "_log_z": None, "_mixed": None, "_top": None}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) + np.float32(0.5) * np.tanh(np.float32(0.5) * x)


def _log_sum(scores: np.ndarray) -> np.ndarray:
    top = scores.max(1)
    scores = scores - top[:, None]
    return np.log(np.exp(scores, out=scores).sum(1)) + top


def _summed(at: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct rows of ``at`` and the sums of the values for each."""
    order = np.argsort(at)
    ordered = at[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    place = np.empty(len(at), np.int64)
    place[order] = np.cumsum(first) - 1
    distinct = ordered[first]
    return distinct, [_gathered(place, v, len(distinct)) for v in values]


def _gathered(place: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of ``values`` by ``place``, a column at a time, which is faster than by rows."""
    if values.ndim == 1:
        return np.bincount(place, values, size).astype(np.float32)
    out = np.empty((size, values.shape[1]), np.float32)
    for k, column in enumerate(np.ascontiguousarray(values.T)):
        out[:, k] = np.bincount(place, column, size)
    return out


def _runs(at: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """``_summed`` where equal rows already stand side by side."""
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[first], [np.add.reduceat(v, first, axis=0) for v in values]


def contexts(ids: np.ndarray, end: int) -> np.ndarray:
    """The two tokens before each; the end stands before a text's first."""
    before = np.concatenate([[end, end], ids])
    return np.stack([before[1:-1], before[:-2]], 1)


def corpus_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(word, c) of all words of all rows.  A task sums its words before the shuffle."""
    small_batches(df.sparkSession)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for batch in batches:
            for t in batch["t"]:
                held.update(t.lower().split())
                if len(held) > 300_000:
                    yield pd.DataFrame(list(held.items()), columns=["word", "n"])
                    held.clear()
        if held:
            yield pd.DataFrame(list(held.items()), columns=["word", "n"])

    return (df.select(text_bytes(text).alias("t")).mapInPandas(counted, "word binary, n long")
              .groupBy("word").agg(F.sum("n").alias("c")))


def vocabulary(counts: DataFrame, texts: int, frequent: int = FREQUENT, shortlist: int | None = None) -> Vocabulary:
    """Frequent words are those above a count that at most ``frequent`` words reach: it is found on
    a histogram of the counts' logarithms, so nothing is sorted and ties stand together.  Words that
    occur often enough for an output of their own are always among them."""
    level = F.floor(F.log2("c") * 16).cast("long")
    steps = counts.groupBy(level.alias("k")).agg(F.count(F.lit(1)).alias("types"), F.sum("c").alias("tokens")).collect()
    least, room = None, frequent
    for r in sorted(steps, key=lambda r: -r["k"]):
        room -= r["types"]
        if room < 0:
            break
        least = r["k"]
    tokens = sum(r["tokens"] for r in steps) + texts
    if shortlist is None and steps:
        own = int(np.floor(np.log2(own_count(tokens)) * 16))
        least = own if least is None else min(least, own)
    rows = counts.where(level >= F.lit(least)).collect() if least is not None else []
    rows = sorted(((bytes(r["word"]), r["c"]) for r in rows), key=lambda x: (-x[1], x[0]))
    return Vocabulary([w for w, _ in rows], np.array([c for _, c in rows], np.int64),
                      tokens=tokens, types=sum(r["types"] for r in steps) + bool(texts),
                      texts=texts, shortlist=shortlist)


def id_type(known: Vocabulary) -> str:
    return "<u2" if known.outputs < 1 << 16 else "<u4"


def numbered(df: DataFrame, known: Vocabulary, training=None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Each text once as the numbers of its outputs (``ids``), beside what the tables of counts give:
    n_tokens, n_known, logs, ``inside`` (the shares of words within the class of others, as far as
    known) and the words whose counts are to be joined (``rest``).  ``row`` holds the
    other columns, ``learn`` tells training texts, ``share`` and ``turn`` follow from a hash of key and
    text, so they do not depend on how rows lie in partitions."""
    small_batches(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast(known)
    kind = id_type(known)

    @F.pandas_udf("n_tokens long, n_known long, logs double, inside double, ids binary, rest binary")
    def first(texts: pd.Series) -> pd.DataFrame:
        known = held.value
        rows, end_log = [], float(np.log10(known.texts + 1.0))
        for t in texts:
            ranks, words = known.ranks(t)
            rare = np.flatnonzero(ranks < 0)
            found = ranks[ranks >= 0]
            logs, shared = known.log_counts[found], found >= known.shortlist
            inside = float(logs[shared].sum()) - known.log_other * (int(shared.sum()) + len(rare))
            rows.append((len(ranks) + 1, len(found) + (known.texts > 0), float(logs.sum()) + end_log, inside,
                         known.ids(ranks).astype(kind).tobytes(), b" ".join([words[k] for k in rare.tolist()])))
        return pd.DataFrame(rows, columns=["n_tokens", "n_known", "logs", "inside", "ids", "rest"])

    names = [c for c in df.columns if c not in {text, *ADDED}]
    row = F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.struct(F.lit(0).alias(NOTHING))
    hashed = F.xxhash64(*([F.col(f"`{key}`")] if key in df.columns else []), F.col(f"`{text}`"))
    shares = max(1, -(-known.tokens // SHARE_TOKENS))
    learn = F.coalesce(training, F.lit(False)) if training is not None else F.lit(True)
    return stage(df.select(row.alias("row"), F.monotonically_increasing_id().alias("id"), learn.alias("learn"), hashed.alias("turn"),
                           F.pmod(hashed, F.lit(shares)).cast("int").alias("share"), first(text_bytes(text)).alias("f"))
                 .select("row", "id", "learn", "turn", "share", "f.*"), "numbered")


def train(texts: DataFrame, known: Vocabulary, rounds: int = ROUNDS) -> LogBilinear:
    """Train on all rows of ``texts`` (from ``numbered``).

    Shares are trained on one by one, each from the round's parameters and with its own seed; a round
    takes every ``rounds``-th share.  Of a share's parameters only the rows that it moved are kept,
    weighted by how often it met them, and averaged in blocks of rows, in a tree of bounded groups."""
    spark: SparkSession = texts.sparkSession
    shares = max(1, -(-known.tokens // SHARE_TOKENS))
    model, kind, end = LogBilinear(known.noise()), id_type(known), known.end
    squares = model.squares()
    for r in range(min(rounds, shares)):
        now = spark.sparkContext.broadcast((model, squares))

        def trained(batches: Iterator[pd.DataFrame], now=now, r=r) -> Iterator[pd.DataFrame]:
            learner = None
            for batch in batches:
                for share, ids in zip(batch["share"].tolist(), batch["ids"], strict=True):
                    if learner is None or learner.share != share:
                        if learner is not None:
                            yield learner.moved()
                        learner = Learner(*now.value, share, [r, share], end)
                    learner.add(np.frombuffer(ids, kind).astype(np.int64))
            if learner is not None:
                yield learner.moved()

        mine = texts.where(F.pmod("share", F.lit(rounds)) == r) if shares > 1 else texts
        # by range: a hash would let several shares meet in one task and leave others empty
        dealt = (mine.select("share", "turn", "ids").repartitionByRange(-(-shares // rounds), "share")
                     .sortWithinPartitions("share", "turn", "ids"))
        made = stage(dealt.select("share", "ids").mapInPandas(trained, MOVED), "models")
        model, squares = LogBilinear(known.noise()).take_table(_averaged(made, model.table(squares)))
    return model


class Learner:
    """Trains a copy of the parameters on the texts of one share."""

    def __init__(self, model: LogBilinear, squares: list[np.ndarray], share: int, seed, end: int):
        self.model, self.share, self.end = copy.deepcopy(model), share, end
        self.random = np.random.default_rng(seed)
        self.before, self.squares = squares, copy.deepcopy(squares)
        self.uses = np.zeros(len(model.inputs) + len(model.outputs) + model.CONTEXT)
        self.seen = self.waiting = 0
        self.parts: list = []

    def add(self, ids: np.ndarray) -> None:
        self.parts.append((contexts(ids, self.end), ids))
        self.waiting += len(ids)
        if self.waiting >= CHUNK:
            self.learn()

    def learn(self) -> None:
        if not self.parts:
            return
        model, n = self.model, len(self.model.inputs)
        context, target = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        rows = model.first[target]
        self.uses[:n] += np.bincount(context.ravel(), minlength=n)
        self.uses[n:-model.CONTEXT] += np.bincount(np.concatenate([rows, target[target != rows]]), minlength=len(model.outputs))
        self.uses[-model.CONTEXT:] += len(target)
        size = min(max(BATCH[0], self.seen // GROWN), BATCH[1])
        for part in np.array_split(self.random.permutation(len(target)), max(1, round(len(target) / size))):
            model.train(context[part], target[part], self.squares, self.random)
        self.seen += len(target)
        self.waiting, self.parts = 0, []

    def moved(self) -> pd.DataFrame:
        """The rows that moved, as ``MOVED``: each times its uses (a little for noise alone)."""
        self.learn()
        touched = np.concatenate([now > old for now, old in zip(self.squares[:2], self.before[:2], strict=True)]
                                 + [np.ones(self.model.CONTEXT, bool)])
        at = np.flatnonzero(touched)
        uses = self.uses[at] + 0.001
        return _records(self.share, at, uses, self.model.table(self.squares)[at] * uses[:, None])


ADDED = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
NOTHING = "_no_other_column"
MOVED = "share long, block int, places binary, uses binary, sums binary"


def _records(share: int, at: np.ndarray, uses: np.ndarray, sums: np.ndarray) -> pd.DataFrame:
    """One record for each block of rows; ``at`` rises."""
    cuts = np.flatnonzero(np.diff(at // BLOCK)) + 1
    rows = [(share, int(places[0] // BLOCK), (places % BLOCK).astype("<u2").tobytes(), u.astype("<f8").tobytes(), v.astype("<f4").tobytes())
            for places, u, v in zip(np.split(at, cuts), np.split(uses, cuts), np.split(sums, cuts), strict=True)]
    return pd.DataFrame(rows, columns=["share", "block", "places", "uses", "sums"])


def _merged(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, uses, sums) of the records of one block, added up in the order of their shares."""
    uses, sums = np.zeros(BLOCK), np.zeros((BLOCK, DIMENSION + 3))
    for r in rows.sort_values("share").itertuples(index=False):
        places = np.frombuffer(r.places, "<u2")
        uses[places] += np.frombuffer(r.uses, "<f8")
        sums[places] += np.frombuffer(r.sums, "<f4").reshape(len(places), -1)
    at = np.flatnonzero(uses)
    return at, uses[at], sums[at]


def _averaged(made: DataFrame, table: np.ndarray) -> np.ndarray:
    """``table`` with the mean of each row that some share moved, by uses: FANIN shares of a block
    are added up by one task until each block has one record left."""

    def group(rows: pd.DataFrame) -> pd.DataFrame:
        at, uses, sums = _merged(rows)
        return _records(int(rows["share"].iloc[0]) // FANIN, at + int(rows["block"].iloc[0]) * BLOCK, uses, sums)

    now, most = made, made.agg(F.max("share")).first()[0]
    while most is not None and most > 0:
        now = now.groupBy("block", F.floor(F.col("share") / FANIN)).applyInPandas(group, MOVED)
        most //= FANIN
    table = table.copy()
    for r in now.toPandas().itertuples(index=False) if most is not None else ():
        at = np.frombuffer(r.places, "<u2").astype(np.int64) + r.block * BLOCK
        uses = np.frombuffer(r.uses, "<f8")
        table[at] = np.frombuffer(r.sums, "<f4").reshape(len(at), -1) / uses[:, None]
    return table


def scored(texts: DataFrame, known: Vocabulary, model: LogBilinear, counts: DataFrame) -> DataFrame:
    """The rows behind ``texts`` (from ``numbered``) with n_tokens, n_known, train_tokens, base_score,
    score (which take the places of columns of these names); the texts themselves are left out."""
    spark = texts.sparkSession
    held = spark.sparkContext.broadcast(model)
    kind, end = id_type(known), known.end

    @F.pandas_udf("double")
    def neural(found: pd.Series) -> pd.Series:
        """Texts are scored together; each has an end, so none is without tokens."""
        ids = [np.frombuffer(b, kind).astype(np.int64) for b in found]
        if not ids:
            return pd.Series([], dtype="float64")
        ends = np.cumsum([0, *map(len, ids)])
        logs = held.value.log10(np.concatenate([contexts(i, end) for i in ids]), np.concatenate(ids))
        return pd.Series(np.add.reduceat(logs, ends[:-1]))

    # words have no spaces, so the bytes between them are theirs
    rest = (texts.where(F.length("rest") > 0)
                 .select("id", F.explode(F.split(F.col("rest").cast("string"), " ")).alias("w"))
                 .select("id", F.col("w").cast("binary").alias("word")))
    c = F.coalesce(F.col("c"), F.lit(0))
    sums = (rest.join(counts, "word", "left").groupBy("id")
                .agg(F.sum(F.log10(c + 1)).alias("more_logs"), F.sum((c > 0).cast("long")).alias("more_known")))
    every = texts.select("row", "id", "n_tokens", "n_known", "logs", "inside", neural("ids").alias("neural")).join(sums, "id", "left")
    more = F.coalesce("more_logs", F.lit(0.0))
    return every.select(
        "row.*", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * float(np.log10(known.tokens + known.types + 1.0))).alias("base_score"),
        (F.col("neural") + F.col("inside") + more).alias("score")).drop(NOTHING)


def score_documents(df: DataFrame, training, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Count, train on the rows where ``training`` holds, and score all rows."""
    mine = df.where(training)
    counts = stage(corpus_counts(mine, text), "counts")
    known = vocabulary(counts, mine.count())
    texts = numbered(df, known, training, text, key)
    return scored(texts, known, train(texts.where("learn"), known), counts)

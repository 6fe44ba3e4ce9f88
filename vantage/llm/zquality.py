"""Quality scores by compression (operator 6).

Two zstandard dictionaries are built, from texts labelled good and from texts labelled bad.  A text
is compressed with each; the difference of the two sizes over their sum says which kind it is like.
A logistic calibration turns this difference into a probability of label 1, given how far the text
compresses at all and how long it is, as the difference of a text that repeats itself, or that is
short, means less.

Training reads about FIT_ROWS labelled texts of each kind of at most FIT_BYTES each, chosen by a
hash of ``doc_id`` (documented parameters of the classifier fit; twice as many rows is the bound);
half of each kind builds the dictionaries and the other half the calibration, as a text that shaped a
dictionary compresses too well with it.

Defined cases: a null or empty text gets the calibrated score of length 0; where the labels are too
few for dictionaries, or of one kind, every score is the share of label 1 (0.5 without labels);
repeated rows score alike; other columns pass unchanged; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import labelled_sample, small_batches, text_bytes

FIT_ROWS = 2000
FIT_BYTES = 32 * 1024
DICTIONARY = 112 * 1024
LEVEL = 3
THRESHOLD = 0.3
LEAST = 20       # texts of each kind that a dictionary and a calibration need


def _inputs(good, bad, n) -> np.ndarray:
    good, bad, n = (np.asarray(x, float) for x in (good, bad, n))
    difference = (bad - good) / (bad + good + 1)
    ratio = np.log((np.minimum(good, bad) + 1) / (n + 1))
    length = np.log(n + 1)
    own = [difference, ratio, length]
    return np.stack(own + [a * b for k, a in enumerate(own) for b in own[k:]], 1)


class CompressionScorer:
    def __init__(self, share: float, dictionaries: tuple[bytes, bytes] | None = None):
        self.share, self.dictionaries = share, dictionaries
        self.mean = self.scale = self.weights = None
        self._open: list = []

    def sizes(self, text: bytes) -> tuple[int, int, int]:
        """Compressed size with the good and the bad dictionary, and the text's own."""
        if not self._open:
            self._open = [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d),
                                                   write_content_size=False) for d in self.dictionaries]
        good, bad = (len(c.compress(text)) for c in self._open)
        return good, bad, len(text)

    def calibrate(self, texts: list[bytes], labels: list[int]) -> None:
        """Newton's method on the logistic likelihood, quadratic in the inputs, with a small ridge penalty."""
        x, y = _inputs(*zip(*map(self.sizes, texts), strict=True)), np.asarray(labels, float)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-9
        a = np.c_[(x - self.mean) / self.scale, np.ones(len(x))]
        # the sample holds both kinds alike; weights bring back their shares
        share = min(max(self.share, 0.01), 0.99)
        weight = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
        w, ridge = np.zeros(a.shape[1]), 1e-5 * len(y) * np.eye(a.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            move = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + ridge, a.T @ (weight * (p - y)) + ridge @ w)
            w -= move
            if np.abs(move).max() < 1e-9:
                break
        self.weights = w

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.weights is None or not texts:
            return np.full(len(texts), self.share)
        x = (_inputs(*zip(*map(self.sizes, texts), strict=True)) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(np.c_[x, np.ones(len(x))] @ self.weights, -30, 30)))

    def __getstate__(self):
        return {**self.__dict__, "_open": []}


def fit(good: list[bytes], bad: list[bytes], share: float) -> CompressionScorer:
    """``share``: of label 1 among all labelled rows."""
    if min(len(good), len(bad)) < LEAST:
        return CompressionScorer(share)
    halves = [(texts[::2], texts[1::2]) for texts in (good, bad)]
    try:
        made = tuple(zstandard.train_dictionary(min(DICTIONARY, max(1024, sum(map(len, part)) // 4)), part).as_bytes()
                     for part, _ in halves)
    except zstandard.ZstdError:     # too little text of one kind
        return CompressionScorer(share)
    scorer = CompressionScorer(share, made)
    scorer.calibrate(halves[0][1] + halves[1][1], [1] * len(halves[0][1]) + [0] * len(halves[1][1]))
    return scorer


def fit_from(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "label", key: str = "doc_id",
             max_rows: int = FIT_ROWS, max_bytes: int = FIT_BYTES) -> CompressionScorer:
    """Fit on about ``max_rows`` labelled texts of each label, chosen by a hash of ``key``."""
    share = labels.where(F.col(label).isNotNull()).agg(F.avg(F.col(label).cast("int"))).first()[0]
    rows = labelled_sample(docs, labels, max_rows, max_bytes, per_label=True, text=text, label=label, key=key)
    kinds = [[r["t"].encode("utf-8") for r in rows if r["y"] == y] for y in (1, 0)]
    return fit(*kinds, share=0.5 if share is None else float(share))


def with_scores(df: DataFrame, scorer: CompressionScorer, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the calibrated probability of label 1."""
    small_batches(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast(scorer)

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series(held.value.scores(texts.tolist()), dtype="float64")

    return df.withColumn(out, scores(text_bytes(text)))

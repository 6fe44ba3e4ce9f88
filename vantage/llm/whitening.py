"""Embedding whitening by contour integration (operator 12).

Vectors become integers, x = floor(scale * entry).  The fit list, each distinct x once, is written to
the shared folder; Spark sums it and then its products, centred before multiplying, both exactly in
integers, so that the covariance does not depend on how rows lie in partitions.  What reaches the
driver is one matrix of dimension x dimension; ``feast.largest`` takes its leading eigenpairs, and
every row is projected where it lies.

Defined cases: a vector that is null, empty, or holds null, NaN or infinite entries takes no part, nor
does one whose length is not the most frequent (of ties the longest); rows of equal vectors are fitted
once and all returned; a null key stays null; a component whose eigenvalue is zero to rounding has no
rows, nor has any where all vectors are equal; an empty table gives an empty result; a deviation
beyond 64 bits is null; other columns are left alone, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm import feast
from vantage.llm.common import small_batches, stage
from vantage.llm.vectors import dimension, exact_dtype, finite, integers, magnitude, matrix

SUM = pa.decimal128(38, 0)
PART = 10 ** 18


@dataclass
class Whitening:
    """A fitted projection: ``axes`` holds one unit eigenvector a row, divided by no eigenvalue."""
    width: int = 0
    scale: int = 256
    n: int = 0
    sums: list = field(default_factory=list)
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))
    axes: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    trace: float = 0.0
    identity_error: float = 0.0


def vectors(df: DataFrame, vec: str, width: int, scale: int, *keep: str) -> DataFrame:
    return df.where(finite(vec) & (F.size(vec) == width)).select(*keep, integers(vec, scale).alias("x"))


def _added(rows: DataFrame, width: int, part, size: int) -> list:
    """Exact sums over all rows of the ``size`` integers that ``part`` (matrix, type -> array, bound)
    gives for a batch; each task adds its batches and emits its sums once."""
    def add(batches):
        total, bound = np.zeros(size, dtype=object), 0
        fast = np.zeros(size, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                values, reach = part(matrix(batch.column(0), width))
                if bound + reach >= 1 << 62 or values.dtype == object:
                    total, fast, bound = total + fast, np.zeros(size, dtype=np.int64), 0
                if values.dtype == object:
                    total = total + values
                else:
                    fast, bound = fast + values, bound + reach
        # in two parts, as products of large entries have more digits than a decimal
        parts = [divmod(int(t) + int(f), PART) for t, f in zip(total, fast)]
        high, low = (pa.array([p[k] for p in parts], SUM) for k in (0, 1))
        yield pa.record_batch([pa.array(np.arange(size, dtype=np.int32)), high, low], ["i", "high", "low"])

    found = rows.select("x").mapInArrow(add, "i int, high decimal(38,0), low decimal(38,0)").groupBy("i").agg(
        F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    out = [0] * size
    for r in found:
        out[r["i"]] = int(r["high"]) * PART + int(r["low"])
    return out


def _column_sums(x: np.ndarray):
    reach = magnitude(x) * len(x)
    return x.astype(np.int64 if reach < 1 << 62 else object).sum(axis=0), reach


def _products(shift: list):
    """Upper triangle of the products of the columns, less ``shift``."""
    upper = np.triu_indices(len(shift))

    def part(x):
        wide = max(magnitude(x), max(abs(s) for s in shift)) >= 1 << 61
        centred = x.astype(object if wide else np.int64) - np.array(shift, dtype=object if wide else np.int64)
        reach = max(1, magnitude(centred)) ** 2 * len(x)
        dtype = exact_dtype(reach)
        centred = centred.astype(np.float64 if dtype is np.float32 else dtype)
        products = (centred.T @ centred)[upper]
        return products.astype(object if dtype is object else np.int64), reach

    return part


def fit(df: DataFrame, components: int = 4, vec: str = "embedding", scale: int = 256) -> Whitening:
    """Covariance of the distinct vectors, its leading components, and the error of the whitened list."""
    small_batches(df.sparkSession)
    width = dimension(df, vec)
    if not width:
        return Whitening(scale=scale)
    fit_list = stage(vectors(df, vec, width, scale).distinct(), "vectors")
    n = fit_list.count()
    sums = _added(fit_list, width, _column_sums, width)
    # centred by the nearest whole mean, an exact difference; what is left of the mean is taken off
    # in whole numbers too
    shift = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * m for s, m in zip(sums, shift)]
    upper = np.triu_indices(width)
    products = _added(fit_list, width, _products(shift), len(upper[0]))
    v = np.zeros((width, width))
    for i, j, p in zip(*upper, products):
        v[i, j] = v[j, i] = (n * p - rest[i] * rest[j]) / (n * n)
    values, columns = feast.largest(v, components)
    real = values > width * np.finfo(float).eps * max(values.max(initial=0.0), 0.0)
    model = Whitening(width, scale, n, sums, values[real], columns.T[real], float(np.trace(v)))
    model.identity_error = _identity_error(fit_list, model)
    return model


def _whitened(x: np.ndarray, model: Whitening) -> np.ndarray:
    mean = np.array([s / model.n for s in model.sums])
    return (x.astype(np.float64) - mean) @ (model.axes / np.sqrt(model.values)[:, None]).T


def _identity_error(fit_list: DataFrame, model: Whitening) -> float:
    """Largest entry of the measured covariance of the whitened fit list, less the identity."""
    k = len(model.values)
    if not k:
        return 0.0

    def add(batches):
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            z = _whitened(matrix(batch.column(0), model.width), model)
            first, second = first + z.sum(axis=0), second + z.T @ z
        sums = np.concatenate([first, second.ravel()])
        yield pa.record_batch([pa.array(np.arange(len(sums), dtype=np.int32)), pa.array(sums)], ["i", "s"])

    found = {r["i"]: r["s"] for r in fit_list.mapInArrow(add, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()}
    sums = np.array([found[i] for i in range(k + k * k)]) / model.n
    mean, second = sums[:k], sums[k:].reshape(k, k)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def transform(df: DataFrame, model: Whitening, vec: str = "embedding", key: str = "vec_id") -> DataFrame:
    """One row per usable row and component: the key, component, n, deviation, whitened, explained,
    identity_error."""
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    schema = (f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, "
              f"identity_error double")
    k = len(model.values)
    if not k:
        return spark.createDataFrame([], schema)
    small_batches(spark)
    share = model.values / model.trace
    most = max(abs(s) for s in model.sums)

    def rows(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1), model.width)
            m = len(x)
            far = model.n * magnitude(x) + most
            whole = np.int64 if far * far * model.width < 1 << 62 else object
            gaps = (x.astype(whole) * model.n - np.array(model.sums, dtype=whole)) ** 2
            deviation = [None if s >= 1 << 63 else int(s) for s in gaps.sum(axis=1)]
            z = _whitened(x, model)
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(m), k)))
            yield pa.record_batch([
                ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n)),
                pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(z.ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, model.identity_error))],
                names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors(df, vec, model.width, model.scale, key).mapInArrow(rows, schema)


def whitened(df: DataFrame, components: int = 4, vec: str = "embedding", key: str = "vec_id",
             scale: int = 256) -> DataFrame:
    """Fit on all of ``df`` and whiten all its rows."""
    return transform(df, fit(df, components, vec, scale), vec, key)

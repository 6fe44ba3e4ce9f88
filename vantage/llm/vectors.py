"""Integer vectors out of a table of embeddings, shared by the operators on vectors."""

from __future__ import annotations

import numpy as np

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vec: str) -> Column:
    """The vector is there, not empty, and all its entries are finite numbers."""
    entry = lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf"))
    return F.coalesce(F.col(vec).isNotNull() & (F.size(vec) > 0) & F.forall(vec, entry), F.lit(False))


def dimension(df: DataFrame, vec: str) -> int:
    """The most frequent length of the finite vectors (of ties the longest); 0 where there is none."""
    sizes = df.where(finite(vec)).groupBy(F.size(vec).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    return first["d"] if first else 0


def integers(vec: str, scale: int) -> Column:
    """floor(scale * entry) of each entry read as double, as bigint."""
    return F.transform(vec, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))


def matrix(column, width: int) -> np.ndarray:
    """An Arrow column of lists of ``width`` numbers as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def exact_dtype(bound: int):
    """The fastest type in which sums up to ``bound`` in size are exact."""
    if bound < 1 << 24:
        return np.float32
    if bound < 1 << 53:
        return np.float64
    return np.int64 if bound < 1 << 62 else object


def magnitude(x: np.ndarray) -> int:
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0

"""Eigenpairs of a symmetric matrix by contour integration (FEAST), in numpy.

A circle around an interval of the real line is integrated by Gauss-Legendre quadrature: at each node
z the complex shifted system (z I - V) X = Y is solved, and the weighted sum of the solutions is the
projection of Y on the eigenvectors whose eigenvalues lie inside.  Rayleigh-Ritz extracts the pairs,
and the projection is repeated from them until the residuals reach rounding.  How many pairs an
interval holds is known beforehand from the inertia of V - a I and V - b I (Sylvester's law, read off
the pivots of a tridiagonal form), so that a missed or false pair cannot pass."""

from __future__ import annotations

import numpy as np

NODES = 16
PER_INTERVAL = 8
ROUNDS = 60


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix similar to ``v`` (Householder)."""
    a = np.array(v, dtype=np.float64)
    d = len(a)
    off = np.zeros(max(d - 1, 0))
    for k in range(d - 2):
        x = a[k + 1:, k].copy()
        length = np.linalg.norm(x)
        off[k] = length
        if length == 0.0:
            continue
        x[0] += np.copysign(length, x[0])
        x /= np.linalg.norm(x)
        inner = a[k + 1:, k + 1:]
        p = inner @ x
        q = p - (x @ p) * x
        inner -= 2.0 * (np.outer(x, q) + np.outer(q, x))
    if d > 1:
        off[d - 2] = a[d - 1, d - 2]
    return np.diag(a).copy(), off


class Inertia:
    """Counts of eigenvalues above a shift, and eigenvalues located by them."""

    def __init__(self, v: np.ndarray):
        self.diag, off = tridiagonal(v)
        self.squares = off * off
        reach = np.zeros(len(self.diag))
        reach[:-1] += np.abs(off)
        reach[1:] += np.abs(off)
        self.low, self.high = float((self.diag - reach).min()), float((self.diag + reach).max())
        self.scale = max(abs(self.low), abs(self.high), np.finfo(float).tiny)
        self.low -= 1e-6 * self.scale
        self.high += 1e-6 * self.scale

    def above(self, shift: float) -> int:
        """Positive pivots of the factorisation of V - shift I."""
        tiny = np.finfo(float).eps * self.scale
        count, pivot = 0, 1.0
        for k in range(len(self.diag)):
            pivot = self.diag[k] - shift - (self.squares[k - 1] / pivot if k else 0.0)
            if abs(pivot) < tiny * 1e-3:
                pivot = -tiny * 1e-3
            count += pivot > 0.0
        return count

    def nth(self, j: int) -> float:
        """The j-th largest eigenvalue (from 1), by bisection on the counts."""
        low, high = self.low, self.high
        while high - low > 1e-9 * self.scale:
            mid = (low + high) / 2
            if self.above(mid) >= j:
                low = mid
            else:
                high = mid
        return (low + high) / 2


def intervals(inertia: Inertia, k: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside) of intervals that hold the ``k`` largest, from the top, cut
    only where there is a gap: eigenvalues that tie with the k-th are taken too."""
    d = len(inertia.diag)
    values = {j: inertia.nth(j) for j in range(1, min(k + 1, d) + 1)}

    def gap(j):
        for i in (j, j + 1):
            if i not in values and i <= d:
                values[i] = inertia.nth(i)
        return values[j] - values[j + 1] if j < d else np.inf

    last = k
    while last < d and gap(last) <= 1e-8 * inertia.scale:
        last += 1
    out, first, high = [], 1, inertia.high
    while first <= last:
        end = last
        if last - first + 1 > PER_INTERVAL:
            end = max(range(first + PER_INTERVAL // 2, first + PER_INTERVAL), key=gap)
            while end < last and gap(end) <= 1e-8 * inertia.scale:
                end += 1
        low = (values[end] + values[end + 1]) / 2 if end < d else inertia.low
        # a narrow circle around the values: its top lies above the first one by a share of its width
        top = min(high, values[first] + max(0.25 * (values[first] - low), 1e-6 * inertia.scale))
        out.append((low, top, end - first + 1))
        first, high = end + 1, low
    return out


def project(v: np.ndarray, low: float, high: float, y: np.ndarray) -> np.ndarray:
    """``y`` projected on the eigenvectors with eigenvalues in (low, high), up to quadrature."""
    centre, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(NODES)
    eye = np.eye(len(v))
    total = np.zeros_like(y)
    for x, w in zip(points, weights):       # the upper half circle; the lower one is its conjugate
        turn = np.exp(1j * np.pi / 2 * (1 - x))
        solved = np.linalg.solve((centre + radius * turn) * eye - v, y.astype(complex))
        total += w / 2 * (radius * turn * solved).real
    return total


def pairs_inside(v: np.ndarray, low: float, high: float, count: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs with eigenvalues in (low, high)."""
    d = len(v)
    size = min(d, count + max(count, 8))
    enough = 32 * np.finfo(float).eps * scale * np.sqrt(d)
    while True:
        y = np.random.default_rng(7).standard_normal((d, size))
        for _ in range(ROUNDS):
            q, _r = np.linalg.qr(project(v, low, high, y))
            h = q.T @ v @ q
            values, turn = np.linalg.eigh((h + h.T) / 2)
            y = q @ turn
            inside = (values > low) & (values < high)
            if inside.sum() == count:
                x = y[:, inside]
                if np.linalg.norm(v @ x - x * values[inside], axis=0).max(initial=0.0) <= enough:
                    return values[inside], x
        if size == d:
            raise ArithmeticError(f"{count} eigenvalues counted in ({low}, {high}), not all extracted")
        size = min(d, 2 * size)


def largest(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors as columns."""
    v = np.asarray(v, dtype=np.float64)
    k = min(k, len(v))
    if k <= 0 or not v.any():
        return np.zeros(k), np.eye(len(v))[:, :k]
    inertia = Inertia(v)
    found = []
    for low, high, count in intervals(inertia, k):
        if inertia.above(low) - inertia.above(high) != count:
            raise ArithmeticError("the inertia counts of an interval do not agree")
        values, vectors = pairs_inside(v, low, high, count, inertia.scale)
        order = np.argsort(-values)
        found.append((values[order], vectors[:, order]))
    values = np.concatenate([f[0] for f in found])[:k]
    vectors = np.concatenate([f[1] for f in found], axis=1)[:, :k]
    return values, vectors / np.linalg.norm(vectors, axis=0)

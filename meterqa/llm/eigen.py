"""Leading eigenvalues and eigenvectors of a symmetric matrix.

Householder reflections make the matrix tridiagonal, Sturm counts bisect for the leading eigenvalues, and inverse iteration finds
their vectors, which are made orthogonal within clusters of near eigenvalues and then reflected back.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
#: Eigenvalues nearer than this share of the largest are one cluster.
CLUSTER = 1e-3
ITERATIONS = 4


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit vectors of the reflections, the first made first."""
    a = np.array(matrix, float)
    size = len(a)
    mirrors = []
    for k in range(size - 2):
        v = a[k + 1 :, k].copy()
        length = np.linalg.norm(v)
        if length:
            v[0] += np.copysign(length, v[0])
            a[k + 1, k] = -np.copysign(length, a[k + 1, k])
            v /= np.linalg.norm(v)
            rest = a[k + 1 :, k + 1 :]
            p = rest @ v
            w = p - (v @ p) * v
            rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each of ``at``."""
    tiny = np.finfo(float).tiny * max(1.0, float((off**2).max(initial=0)))
    below = np.zeros(len(at), np.int64)
    q = np.ones(len(at))
    for i, d in enumerate(diagonal):
        q = d - at - (off[i - 1] ** 2 / q if i else 0.0)
        q = np.where(np.abs(q) < tiny, -tiny, q)
        below += q < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, by bisection down to neighbouring doubles."""
    size = len(diagonal)
    around = np.abs(np.r_[off, 0]) + np.abs(np.r_[0, off])
    wide = max(np.abs(diagonal).max() + around.max(), np.finfo(float).tiny)
    low, high = np.full(count, (diagonal - around).min() - EPS * wide), np.full(count, (diagonal + around).max() + EPS * wide)
    place = size - 1 - np.arange(count)  # from the smallest
    for _ in range(2100):
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high) | (high - low <= EPS * EPS * wide)).all():
            break
        above = sturm_counts(diagonal, off, middle) <= place
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return low + (high - low) / 2


def _solved(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """(T - shift) x = right by elimination with row exchanges; a pivot below ``least`` counts as ``least``."""
    size = len(diagonal)
    pivot, next_, third, b = np.zeros(size), np.zeros(size), np.zeros(size), right.copy()
    d, e = diagonal[0] - shift, off[0] if size > 1 else 0.0
    for i in range(size - 1):
        below, d2, e2 = off[i], diagonal[i + 1] - shift, off[i + 1] if i + 2 < size else 0.0
        if abs(below) > abs(d):
            pivot[i], next_[i], third[i] = below, d2, e2
            factor = d / below
            b[i], b[i + 1] = b[i + 1], b[i] - factor * b[i + 1]
            d, e = e - factor * d2, -factor * e2
        else:
            pivot[i], next_[i] = d if abs(d) > least else least, e
            factor = below / pivot[i]
            b[i + 1] -= factor * b[i]
            d, e = d2 - factor * e, e2
    pivot[-1] = d if abs(d) > least else least
    x = np.zeros(size + 2)
    for i in range(size - 1, -1, -1):
        x[i] = (b[i] - next_[i] * x[i + 1] - third[i] * x[i + 2]) / pivot[i]
    return x[:size]


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors, one a column, by inverse iteration from fixed random starts."""
    size = len(diagonal)
    wide = max(float(np.abs(values).max(initial=0)), float(np.abs(diagonal).max()), np.finfo(float).tiny)
    random = np.random.default_rng(12)
    vectors = np.zeros((size, len(values)))
    first = 0  # of the cluster
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * wide:
            first = k
        near = vectors[:, first:k]
        x = random.uniform(-1, 1, size)
        for _ in range(ITERATIONS):
            x /= np.abs(x).max()
            x = _solved(diagonal, off, value, x, EPS * wide)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= near @ (near.T @ x)
            x /= np.linalg.norm(x)
        vectors[:, k] = x
    return vectors


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and, as columns, unit eigenvectors; values that are zero to double precision are left out."""
    diagonal, off, mirrors = tridiagonal(matrix)
    values = leading_values(diagonal, off, min(count, len(diagonal)))
    values = values[values > len(diagonal) * EPS * max(values.max(initial=0), 0)]
    vectors = leading_vectors(diagonal, off, values)
    for k in range(len(mirrors) - 1, -1, -1):
        v = mirrors[k]
        vectors[k + 1 :] -= 2 * np.outer(v, v @ vectors[k + 1 :])
    return values, vectors

"""SetSketch: registers of truncated, exponentially spaced minima.

Every element gives each of M registers an exponential random value; a register keeps the least, as
``floor(1 - log_BASE(value))`` between 0 and TOP. An element's values are drawn in ascending order, to registers in an order of its own, and
drawing stops once they pass the largest kept value. Registers of a union are the maxima of the registers.
"""

from __future__ import annotations

import numpy as np

from meterqa.llm.lookup import mixed

#: A prime, so that any step visits all registers.
M = 127
BASE = 1.001
RATE = 20.0
TOP = 2**16 - 1
BANDS, ROWS = 25, 5


def registers(offsets: np.ndarray, elements: np.ndarray) -> np.ndarray:
    """One row of M registers for each set; an empty set has zeros."""
    n_sets = len(offsets) - 1
    least = np.full(n_sets * M, np.inf)
    of = np.repeat(np.arange(n_sets), np.diff(offsets))
    seed = mixed(elements + np.uint64(0x5E75E7C4))
    place = (seed % np.uint64(M)).astype(np.int64)
    step = ((seed >> np.uint64(20)) % np.uint64(M - 1)).astype(np.int64) + 1
    value = np.zeros(len(elements))
    live = np.arange(len(elements))
    for j in range(M):
        draw = mixed(elements[live] + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        unit = ((draw >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52
        value[live] -= np.log(unit) / (RATE * (M - j))
        np.minimum.at(least, of[live] * M + place[live], value[live])
        place[live] = (place[live] + step[live]) % M
        limit = least.reshape(n_sets, M).max(axis=1) if n_sets else least
        live = live[value[live] < limit[of[live]]]
        if not len(live):
            break
    with np.errstate(invalid="ignore"):
        kept = np.floor(1 - np.log(np.where(np.isinf(least), 1.0, least)) / np.log(BASE))
    kept = np.clip(np.where(np.isinf(least), 0, kept), 0, TOP)
    return kept.astype(np.uint16).reshape(n_sets, M)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """One row of ``BANDS`` hashes of ``ROWS`` registers each."""
    keys = np.zeros((len(sketches), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(sketches), band + 1, np.uint64)
        for row in range(ROWS):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + sketches[:, band * ROWS + row])
        keys[:, band] = key
    return keys


def _share(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def joint_likelihood(a, b, size_a, size_b, least: float, steps: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """The most likely similarity of each pair, and by how much its log-likelihood exceeds that of any similarity of ``least`` or more.

    Pairs of registers that are greater, less and equal are counted together; set sizes are known.
    """
    greater = (a > b).sum(axis=1)[:, None]
    less = (a < b).sum(axis=1)[:, None]
    equal = a.shape[1] - greater - less
    u, v = size_a / (size_a + size_b), size_b / (size_a + size_b)
    top = np.minimum(u, v) / np.maximum(u, v)

    def likelihood(j: np.ndarray) -> np.ndarray:
        p = np.maximum(_share(u[:, None] - v[:, None] * j), 1e-12)
        q = np.maximum(_share(v[:, None] - u[:, None] * j), 1e-12)
        rest = np.maximum(1 - p - q, 1e-12)
        return greater * np.log(p) + less * np.log(q) + equal * np.log(rest)

    grid = np.linspace(0, 1, steps)[None, :] * top[:, None]
    every = likelihood(grid)
    high = likelihood(least + np.linspace(0, 1, 16)[None, :] * np.maximum(top - least, 0)[:, None])
    best = np.maximum(every.max(axis=1), high.max(axis=1))
    return grid[np.arange(len(grid)), every.argmax(axis=1)], best - high.max(axis=1)

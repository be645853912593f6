"""Word shingles of whole texts as 64-bit hashes, many texts at a time."""

from __future__ import annotations

import numpy as np

from meterqa.llm.lookup import mixed

WIDTH = 5
_random = np.random.default_rng(5)
#: A random number for each byte, A-Z as a-z; an odd base; odd factors for the places of a shingle.
_BYTES = _random.integers(0, 2**64, 256, np.uint64)
_BYTES[65:91] = _BYTES[97:123]
_BASE = int(_random.integers(0, 2**63)) * 2 + 1
_PLACES = _random.integers(0, 2**63, WIDTH, np.uint64) * np.uint64(2) + np.uint64(1)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    global _powers
    while len(_powers[0]) < n:
        size = len(_powers[0])
        step = pow(_BASE, size, 2**64), pow(_BASE, -size, 2**64)
        _powers = tuple(np.concatenate([p, p * np.uint64(s)]) for p, s in zip(_powers, step, strict=True))
    return _powers


def words(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text of each word, hash of each word) over texts laid end to end."""
    space = _IS_SPACE[data]
    edge = np.ones(len(data) + 1, bool)  # a word starts after a space, at a text's start
    edge[1:-1] = space[:-1]
    edge[offsets] = True
    starts = np.flatnonzero(edge[:-1] & ~space)
    stop = np.ones(len(data) + 1, bool)
    stop[:-1] = space
    stop[offsets] = True
    stops = np.flatnonzero(stop)
    ends = stops[np.searchsorted(stops, starts, "right")]
    power, inverse = _grown(len(data) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * power[: len(data)], dtype=np.uint64)])
    hashes = (total[ends] - total[starts]) * inverse[starts]
    hashes = mixed(hashes + (ends - starts).astype(np.uint64))
    return np.searchsorted(offsets, starts, "right") - 1, hashes


def shingle_sets(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the texts' sets and the distinct shingles, sorted within each text.

    A text of fewer than ``WIDTH`` words has its whole sequence as its one shingle; without words it has none.
    """
    n_texts = len(offsets) - 1
    text, word = words(offsets, data)
    count = np.bincount(text, minlength=n_texts)
    first = np.r_[0, np.cumsum(count)]
    size = max(len(word) - WIDTH + 1, 0)
    hashes = np.zeros(size, np.uint64)
    for place in range(WIDTH):
        hashes += word[place : place + size] * _PLACES[place]
    hashes = mixed(hashes)
    sets: list[np.ndarray] = []
    for i in range(n_texts):
        if count[i] >= WIDTH:
            sets.append(np.unique(hashes[first[i] : first[i + 1] - WIDTH + 1]))
        elif count[i]:
            few = word[first[i] : first[i + 1]] * _PLACES[: count[i]]
            sets.append(mixed(np.array([few.sum() + np.uint64(count[i])], np.uint64)))
        else:
            sets.append(np.empty(0, np.uint64))
    return np.r_[0, np.cumsum([len(s) for s in sets])], np.concatenate(sets) if sets else hashes[:0]

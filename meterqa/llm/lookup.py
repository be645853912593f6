"""Lookups of many numbers at once."""

from __future__ import annotations

import numpy as np


class HashIndex:
    """Places of distinct numbers by hash, with open addressing; -1 where a number is missing."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(len(keys) * 8).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.places = np.full(1 << self.bits, -1, np.int32)
        rest, slot = np.arange(len(keys)), self._slot(keys)
        while len(rest):
            free = self.places[slot] < 0
            _, first = np.unique(slot, return_index=True)
            chosen = np.zeros(len(rest), bool)
            chosen[first] = True
            chosen &= free
            self.keys[slot[chosen]], self.places[slot[chosen]] = keys[rest[chosen]], rest[chosen]
            rest, slot = rest[~chosen], (slot[~chosen] + ~free[~chosen]) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        places = self.places[slot]
        wrong = np.flatnonzero((self.keys[slot] != keys) & (places >= 0))
        slot = slot[wrong]
        while len(wrong):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            here = self.places[slot]
            places[wrong] = here
            more = (self.keys[slot] != keys[wrong]) & (here >= 0)
            wrong, slot = wrong[more], slot[more]
        return places


def mixed(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64-bit hashes of 64-bit numbers (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))

"""Equal strings of fixed length in a text, by difference-cover suffix sorting.

Suffixes are put into buckets by their first ``PERIOD`` bytes. Inside a bucket two suffixes are compared by precomputed ranks:
some distance below ``PERIOD`` leads both to sample positions, as the sample's residues are a difference cover, and the sample
suffixes are ranked beforehand to ``DEPTH`` bytes by doubling. So no comparison reads long common prefixes, and memory is a few
numbers per byte of the block at hand.
"""

from __future__ import annotations

import numpy as np

from meterqa.llm.lookup import mixed

PERIOD = 16
DEPTH = 256


def difference_cover(period: int) -> list[int]:
    """Residues of which some two differ by any number modulo ``period``; found greedily."""
    cover, missing = [0], set(range(1, period))
    while missing:
        gain = {c: {(c - x) % period for x in cover} | {(x - c) % period for x in cover} for c in range(period)}
        best = max(range(period), key=lambda c: (len(gain[c] & missing), -c))
        cover.append(best)
        missing -= gain[best]
    return sorted(cover)


COVER = difference_cover(PERIOD)
_IN_COVER = np.isin(np.arange(PERIOD), COVER)
#: For two residues, a distance that leads both into the cover.
_AHEAD = np.array(
    [[next(d for d in range(PERIOD) if _IN_COVER[(i + d) % PERIOD] and _IN_COVER[(j + d) % PERIOD]) for j in range(PERIOD)] for i in range(PERIOD)],
    np.int64,
)


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number, in byte order; the text is padded by at least eight bytes."""
    n = len(text) - 8
    words = np.empty(n, np.uint64)
    for shift in range(min(8, n)):
        count = (n - shift + 7) // 8
        words[shift::8] = text[shift : shift + 8 * count].view(">u8")
    return words


def _grouped(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by two numbers, and where in it a new pair begins."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, new


def _packed(high: np.ndarray, low: np.ndarray | None, bits: int) -> np.ndarray:
    """The order by ``high`` and ``low``, numbers of at most ``bits`` bits, as places are."""
    key = high.astype(np.uint64) << np.uint64(bits)
    if low is not None:
        key = (key | low.astype(np.uint64)) << np.uint64(bits)
    key |= np.arange(len(high), dtype=np.uint64)
    key.sort()  # much faster than argsort
    return (key & np.uint64((1 << bits) - 1)).astype(np.int64)


def _bucketed(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``_grouped``, but the pairs may come in any order: here in that of a hash."""
    bits = len(first).bit_length()
    hashed = mixed(first * np.uint64(0x9E3779B97F4A7C15) + mixed(second)) >> np.uint64(bits)
    order = _packed(hashed, None, bits)
    a, b, h = first[order], second[order], hashed[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    if (new[1:] & (h[1:] == h[:-1])).any():  # unlike pairs of one hash
        return _grouped(first, second)
    return order, new


def _sample_ranks(words: np.ndarray, size: int) -> np.ndarray:
    """Ranks, from 1, of the sample suffixes by their first ``DEPTH`` bytes; other positions hold 0."""
    positions = np.arange(size)[_IN_COVER[np.arange(size) % PERIOD]]
    ranks = np.zeros(size + DEPTH + PERIOD, np.int64)
    order, new = _grouped(words[positions], words[positions + 8])
    positions = positions[order]
    depth = PERIOD
    start = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    ranks[positions] = start + 1
    while depth < DEPTH and len(positions):
        # Only ranks that several suffixes share are refined; a rank is the place of its first suffix.
        shared = ~new | np.r_[~new[1:], False]
        positions, start = positions[shared], ranks[positions[shared]]
        then = ranks[positions + depth]
        bits = max(size, 2).bit_length()
        order = _packed(start, then, bits) if 3 * bits <= 64 else np.lexsort((then, start))
        positions, start, then = positions[order], start[order], then[order]
        new = np.ones(len(order), bool)
        new[1:] = (start[1:] != start[:-1]) | (then[1:] != then[:-1])
        group = np.ones(len(start), bool)
        group[1:] = start[1:] != start[:-1]
        at = np.arange(len(start))
        inside = np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        ranks[positions] = start + inside
        depth *= 2
    return ranks


def _sort_ties(suffixes: np.ndarray, group_at: np.ndarray, sizes: np.ndarray, ranks: np.ndarray) -> None:
    """Sort each group in place by its suffixes' sample ranks: one sorting network for all groups of like size."""
    class_of = np.ceil(np.log2(sizes)).astype(int)
    for steps in np.unique(class_of):
        some = np.flatnonzero(class_of == steps)
        size = np.repeat(sizes[some], sizes[some])
        ends = np.cumsum(sizes[some])
        inside = np.arange(ends[-1]) - np.repeat(ends - sizes[some], sizes[some])
        places = np.repeat(group_at[some], sizes[some]) + inside
        p = 1 << (steps - 1)
        while p:
            q, r, d = 1 << (steps - 1), 0, p
            while True:
                left = places[((inside & p) == r) & (inside + d < size)]
                a, b = suffixes[left], suffixes[left + d]
                ahead = _AHEAD[a % PERIOD, b % PERIOD]
                swap = ranks[a + ahead] > ranks[b + ahead]
                suffixes[left[swap]], suffixes[left[swap] + d] = b[swap], a[swap]
                if q == p:
                    break
                d, q, r = q - p, q >> 1, p
            p >>= 1


def repeated(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Whether the string of ``length`` bytes at each of ``starts`` is also at another of them.

    ``length`` is between ``PERIOD`` and ``DEPTH`` and a multiple of 8; every string lies inside the text.
    """
    if not PERIOD <= length <= DEPTH or length % 8:
        raise ValueError("length must be a multiple of 8 from PERIOD to DEPTH")
    result = np.zeros(len(starts), bool)
    if len(starts) < 2:
        return result
    size = len(text)
    words = _words(np.concatenate([text, np.zeros(DEPTH + 2 * PERIOD + 8, np.uint8)]))
    # Buckets of one suffix are done.
    order, new = _bucketed(words[starts], words[starts + 8])
    shared = ~new | np.r_[~new[1:], False]
    order, new = order[shared], new[shared]
    if not len(order):
        return result
    ranks = _sample_ranks(words, size)
    at = np.flatnonzero(new)
    sizes = np.diff(np.r_[at, len(order)])
    suffixes = starts[order]
    _sort_ties(suffixes, at, sizes, ranks)
    left = np.flatnonzero(~new) - 1  # neighbours inside a bucket
    a, b = suffixes[left], suffixes[left + 1]
    for offset in range(PERIOD, length, 8):
        same = words[a + offset] == words[b + offset]
        left, a, b = left[same], a[same], b[same]
    hit = np.zeros(size, bool)
    hit[a] = True
    hit[b] = True
    return hit[starts]

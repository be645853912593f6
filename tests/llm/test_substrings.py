import random
from collections import Counter

import cases
import numpy as np
import pytest

from meterqa.llm import substrings, suffixes


def brute(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[p : p + length] for b in raw for p in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = True
        edges = np.diff(np.concatenate([[0], gone.astype(int)]))
        out.append((len(b), int(gone.sum()), int((edges == 1).sum()), bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


@pytest.mark.parametrize("many", [substrings.MANY, 2])
def test_against_brute_force(spark, many):
    rows = cases.odd_documents()
    want = [(r[0], *b) for r, b in zip(rows, brute([r[1] for r in rows]), strict=True)]
    got = substrings.without_repeats(cases.odd_table(spark), many=many)
    key = lambda r: tuple((x is None, x) for x in r)
    found = cases.tuples(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    assert [tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in found] == sorted(want, key=key)


def test_near_copies_by_the_thousand(spark):
    """A crowd that is split down to single strings, and one that is not: the same bytes, and rows in proportion to the contexts."""
    rng = random.Random(11)
    base = cases.prose(rng, 80)
    texts = []
    for _ in range(1500):
        words = base.split()
        for at in rng.sample(range(len(words)), 3):
            words[at] = f"x{rng.randint(0, 10**6)}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    want = [(i, *b) for i, b in enumerate(brute(texts))]
    for many in (substrings.MANY, 40):
        got = substrings.without_repeats(docs, many=many)
        found = cases.tuples(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept")
        assert [tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in found] == want


def test_split_keeps_every_string_once():
    import pyarrow as pa

    rng = np.random.default_rng(9)
    rows = [(1, 2, 137, 136, 0, 136, 1, rng.integers(97, 99, 336).astype(np.uint8).tobytes())]
    rows += [(3, 4, 50, 90, 0, 136, 1, rng.integers(97, 99, 249).astype(np.uint8).tobytes())]
    names = ["c", "d", "n", "p", "low", "high", "times", "context"]
    seen = []
    for _ in range(9):
        batch = pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*rows, strict=True)], names=names)
        parts = [r for b in substrings._split(iter([batch])) for r in b.to_pylist()]
        assert all(len(r["context"]) == r["n"] - 1 + 200 and r["low"] <= r["high"] for r in parts)
        rows = [tuple(r[x] for x in names) for r in parts]
        seen.append(sum(r["n"] for r in parts))
        if all(r["low"] == r["high"] for r in parts):
            break
    assert set(seen) == {137 + 50} and len(rows) == 137 + 50


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(substrings, "PIECE_BYTES", 1000)
    rng = np.random.default_rng(2)
    text = rng.integers(97, 123, 5000).astype(np.uint8)
    text = np.concatenate([text, text[900:1400], text[100:350]])
    import pyarrow as pa

    whole = substrings.anchored(np.array([0, len(text)]), text)
    found = set()
    for _, offsets, data, before in substrings._pieces(pa.array([text.tobytes().decode()] * 1)):
        _, first, after, anchor, h = substrings.anchored(offsets, data)
        for a, b, c in zip(first + before, after + before, h, strict=True):
            found |= {(int(p), int(c)) for p in range(a, b)}
    _, first, after, _, h = whole
    assert found == {(p, int(c)) for a, b, c in zip(first, after, h, strict=True) for p in range(a, b)}


def test_suffix_sorting_against_counts():
    rng = np.random.default_rng(0)
    for trial in range(30):
        a = rng.integers(97, 99 if trial % 2 else 120, rng.integers(200, 3000)).astype(np.uint8)
        parts = [a] + [a[s : s + rng.integers(10, 600)] for s in rng.integers(0, len(a), rng.integers(0, 30))]
        text = np.concatenate(parts + ([np.full(700, 97, np.uint8)] if trial % 5 == 0 else []))
        starts = np.sort(rng.choice(len(text) - 199, max(1, (len(text) - 199) // (1 + trial % 3)), replace=False))
        seen = Counter(text[s : s + 200].tobytes() for s in starts)
        want = [seen[text[s : s + 200].tobytes()] > 1 for s in starts]
        assert suffixes.repeated(text, starts, 200).tolist() == want


def test_cover_is_a_difference_cover():
    for period in (8, 16, 32, 57):
        cover = suffixes.difference_cover(period)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_least_of_windows():
    rng = random.Random(4)
    for _ in range(50):
        values = np.array([rng.randint(0, 99) for _ in range(rng.randint(5, 60))], np.uint64)
        width = rng.randint(1, len(values))
        got = substrings._least_of(values, width)
        assert got.tolist() == [min(values[i : i + width]) for i in range(len(values) - width + 1)]


def test_empty(spark):
    assert substrings.without_repeats(cases.empty_table(spark)).count() == 0

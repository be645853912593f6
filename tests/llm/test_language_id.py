import math
import zlib
from collections import defaultdict

import cases
import numpy as np

from meterqa.llm import language_id


class Tree:
    """Counts of one language in a dictionary, and code lengths by the definition."""

    def __init__(self, texts):
        self.next = defaultdict(lambda: defaultdict(int))
        for text in texts:
            raw = bytes([language_id.LEAD] * language_id.DEPTH) + text.encode()
            for i in range(language_id.DEPTH, len(raw)):
                for k in range(language_id.DEPTH + 1):
                    self.next[raw[i - k : i]][raw[i]] += 1

    def bits(self, text):
        raw = bytes([language_id.LEAD] * language_id.DEPTH) + text.encode()
        total = 0.0
        for i in range(language_id.DEPTH, len(raw)):
            for k in range(language_id.DEPTH, -1, -1):
                seen = self.next.get(raw[i - k : i])
                if not seen:
                    continue
                n, q = sum(seen.values()), len(seen)
                if raw[i] in seen:
                    total -= math.log2(seen[raw[i]] / (n + q))
                    break
                total -= math.log2(q / (n + q))
            else:
                total += 8
        return total


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def test_against_definition(spark):
    rows = cases.odd_documents()
    train = defaultdict(list)
    for doc_id, text, lang, *_ in rows:
        if lang is not None and text is not None and fold(doc_id):
            train[lang].append(text)
    trees = {lang: Tree(texts) for lang, texts in train.items()}
    got = language_id.predicted(cases.odd_table(spark))
    want = []
    for doc_id, text, *_ in rows:
        held = fold(doc_id) == 0
        if text is None or not any(c.isalpha() for c in text):
            want.append((doc_id, held, "und", 0.0))
            continue
        bits = {lang: trees[lang].bits(text) for lang in sorted(trees)}
        best = min(bits, key=bits.get)
        want.append((doc_id, held, best, 1 / sum(2.0 ** min(0.0, bits[best] - b) for b in bits.values())))
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[3])
    have = sorted((tuple(r) for r in got.collect()), key=key)
    for a, b in zip(have, sorted(want, key=key), strict=True):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-3


def test_pieces_of_long_texts(monkeypatch):
    trees = language_id.ContextTrees(["a"], np.zeros(3, int), np.array([0x0A0A0A61, 0x0A0A6162, 0x0A616263], np.uint64), np.ones(3, int))
    raw = b"abcabcab" * 50
    offsets = np.array([0, 100, 100, len(raw)])
    whole = trees.text_lengths(offsets, np.frombuffer(raw, np.uint8))
    monkeypatch.setattr(language_id, "PIECE", 7)
    assert np.allclose(whole, trees.text_lengths(offsets, np.frombuffer(raw, np.uint8)))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.predicted(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(got) > 150
    assert sum(r["lang_pred"] == r["lang"] for r in got) / len(got) > 0.97


def test_labels_are_no_input(spark):
    docs = cases.odd_table(spark)
    shuffled = docs.selectExpr("doc_id", "text", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0, 'zz', lang) AS lang")
    columns = ("doc_id", "lang_pred", "score")
    assert cases.tuples(language_id.predicted(docs), *columns) == cases.tuples(language_id.predicted(shuffled), *columns)


def test_empty_and_unlabelled(spark):
    assert language_id.predicted(cases.empty_table(spark)).count() == 0
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in language_id.predicted(docs).collect()] == [("und", 0.0)]


def test_every_label_is_learned(spark, monkeypatch):
    """Labels whose documents are far larger than their share of the sample, beside one with short documents."""
    monkeypatch.setattr(language_id, "WINDOW", 64)
    rows = [(100 * k + i, f"{chr(97 + k)}{chr(98 + k)} " * 3000, f"l{k}") for k in range(12) for i in range(3)]
    rows += [(5000 + i, f"short {i} texts", "small") for i in range(200)] + [(6000, "short long texts " * 4000, "small")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = {r[2] for r in rows if fold(r[0])}
    assert len(labels) == 13
    for sample in (13 * 64, 20_000):
        counts = language_id.training_counts(docs, sample).groupBy("lang").sum("n").collect()
        total = {r["lang"]: r["sum(n)"] for r in counts}
        assert set(total) == labels
        assert all(0 < n <= max(64, sample / 13) for n in total.values())
    assert min(total.values()) > 0.5 * sample / 13


def test_windows_cover_whole_texts(spark, monkeypatch):
    docs = cases.odd_table(spark)
    whole = cases.tuples(language_id.training_counts(docs), "lang", "gram", "n")
    monkeypatch.setattr(language_id, "WINDOW", 7)
    assert cases.tuples(language_id.training_counts(docs), "lang", "gram", "n") == whole

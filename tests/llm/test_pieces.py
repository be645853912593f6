import cases
import numpy as np
import pytest

from meterqa.llm import pieces

TEXTS = ["", " ", "a", "  a  b", "漢字▁x", "x" * 300, "ab" * 100 + "  c", "ﬁ①é́🎉", "\n\n\t ", "▁", " " * 60, "\x00\x7f", "Hello world, hello"]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load()


def batch(texts):
    raw = [t.encode() for t in texts]
    return np.cumsum([0] + [len(b) for b in raw]), np.frombuffer(b"".join(raw), np.uint8)


def test_without_dropout_as_the_library(vocabulary):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = TEXTS + [r[1] or "" for r in cases.odd_documents()]
    edges, ids = pieces.Codec(vocabulary, 0.0, 1).encode(np.arange(len(texts)).astype(np.uint64), *batch(texts))
    for i, text in enumerate(texts):
        if "▁" not in text:
            assert ids[edges[i] : edges[i + 1]].tolist() == library.encode(text)


def test_agenda_and_matrices_agree(vocabulary, monkeypatch):
    texts = TEXTS + [r[1] or "" for r in cases.odd_documents()]
    keys = np.arange(len(texts)).astype(np.uint64)
    for dropout in (0.1, 0.5, 1.0):
        codec = pieces.Codec(vocabulary, dropout, 7)
        edges, ids = codec.encode(keys, *batch(texts))
        monkeypatch.setattr(pieces, "LONGEST", 1)
        assert [x.tolist() for x in codec.encode(keys, *batch(texts))] == [edges.tolist(), ids.tolist()]
        monkeypatch.setattr(pieces, "LONGEST", 40)
        back, raw = codec.decode(edges, ids)
        assert raw.tobytes() == "".join(texts).encode() and back.tolist() == batch(texts)[0].tolist()


def test_seed_and_document_decide(vocabulary):
    text = [" ".join(["international understanding"] * 30)] * 3
    runs = {}
    for seed in (1, 2):
        edges, ids = pieces.Codec(vocabulary, 0.3, seed).encode(np.array([5, 5, 6], np.uint64), *batch(text))
        runs[seed] = [tuple(ids[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    assert runs[1][0] == runs[1][1] != runs[1][2] and runs[1][0] != runs[2][0]


def test_round_trip(spark):
    docs = cases.odd_table(spark)
    got = pieces.round_trip(docs)
    assert got.count() == docs.count() and got.filter("not lossless").count() == 0
    assert got.filter("n_tokens = 0").count() == 2
    again = pieces.round_trip(docs.repartition(2))
    columns = ("doc_id", "n_tokens", "ids_hash")
    assert cases.tuples(got, *columns) == cases.tuples(again, *columns)
    assert pieces.round_trip(cases.empty_table(spark)).count() == 0


def test_columns_stay(spark):
    docs = cases.odd_table(spark)
    ids = pieces.encoded(docs, ["doc_id", "key", "s"])
    assert ids.columns == ["doc_id", "key", "s", "ids"]
    back = pieces.decoded(ids, ["doc_id"])
    want = [(r[0], r[1] or "") for r in cases.odd_documents()]
    assert cases.tuples(back, "doc_id", "text") == sorted(want, key=lambda r: tuple((x is None, x) for x in r))

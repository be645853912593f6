import random
import re
from collections import Counter, defaultdict

import cases
import pytest

from meterqa.llm import phrases
from meterqa.llm.base import written


def brute(rows, top=2000, least=10, inside=50):
    f = defaultdict(Counter)
    n = Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", raw):
            w = re.findall(rb"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        kept = []
        common = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longer = defaultdict(int)
        for p, a in common.items():
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    longer[part] = max(longer[part], a)
        for p, a in common.items():
            if longer.get(p) and 100 * longer[p] >= inside * a and len(p) == 2:
                continue
            cuts = [(1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, b" ".join(p), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def corpus(seed, docs=120, vocabulary=12):
    rng = random.Random(seed)
    common = [f"w{i}" for i in range(vocabulary)]
    chain = [f"c{i}" for i in range(9)]
    rows = []
    for i in range(docs):
        words = []
        while len(words) < 60:
            words += chain[rng.choice([0, 0, 2]) :] if rng.random() < 0.15 else [rng.choice(common) if rng.random() < 0.9 else f"rare{rng.randint(0, 5000)}"]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", ", ", ". ", "\n", "  "]) for w in words)
        rows.append((text, rng.choice(["en", "fr", None, "und"])))
    rows += [("É É É Æ\x00b é. " * 12, "fr"), ("THE the The\x0bthe\x0cthe the " * 11, "fr"), (None, "en"), ("", "xx"), (" .,; ", "yy"), ("one", "zz")]
    rows += [("round and round and round and round and", "loop")] * 11 + [("t\tu", "lang\twith tab")] * 10
    return rows


def table(spark, rows):
    return spark.createDataFrame([(i, t, la, 1, "x", "y") for i, (t, la) in enumerate(rows)], "doc_id long, text string, lang string, n int, a string, bucket string")


@pytest.mark.parametrize("seed,bucket_words", [(1, 1 << 20), (2, 300)])
def test_against_brute_force(spark, monkeypatch, seed, bucket_words):
    rows = corpus(seed)
    got = phrases.collocations(table(spark, rows).repartition(6), bucket_words=bucket_words)
    assert cases.tuples(got, *got.columns) == brute(rows)


def test_top_and_parameters(spark):
    rows = corpus(3, 60)
    got = phrases.collocations(table(spark, rows), top=7, least=3, inside=20)
    assert cases.tuples(got, *got.columns) == brute(rows, 7, 3, 20)


def test_small_blocks(monkeypatch):
    """Blocks of a few words, each text by itself; edges of all blocks together are those of one block."""
    import pyarrow as pa

    rows = corpus(4, 30)
    batch = pa.RecordBatch.from_pydict({"text": [t for t, _ in rows], "lang": ["x"] * len(rows)})

    class Shared:
        value = (5, {("x", b"w1"), ("x", b"w2"), ("x", b"")})

    def counted():
        found = Counter()
        for part in phrases._edges(Shared)(iter([batch])):
            import numpy as np

            row = part.to_pylist()[0]
            names = row["words"].split(b"\n")
            kind = np.uint16 if len(names) < 1 << 16 else np.uint32
            for a, b, c, w in zip(*(np.frombuffer(row[x], kind) for x in "abc"), np.frombuffer(row["weight"], np.uint32), strict=True):
                found[row["bucket"], names[a], names[b], names[c]] += int(w)
        return found

    whole = counted()
    monkeypatch.setattr(phrases, "BLOCK_WORDS", 50)
    assert counted() == whole and len({k[1:] for k in whole}) == len(whole)


def test_paths_hold_every_node_and_edge_once(spark):
    rows = corpus(5)
    found = written(phrases.grams(table(spark, rows)))
    paths, links = phrases.compacted(found)
    nodes, edges = Counter(), Counter()
    longest = 0
    for p in paths.collect():
        w = p["words"]
        longest = max(longest, len(w))
        assert len(p["flows"]) == len(w) - 1 and len(p["weights"]) == len(w) - 2
        nodes.update({(p["lang"], *w[i : i + 2]): x for i, x in enumerate(p["flows"])})
        edges.update({(p["lang"], *w[i : i + 3]): x for i, x in enumerate(p["weights"])})
    edges.update({(r["lang"], r["a"], r["b"], r["c"]): r["times"] for r in links.collect()})
    rows_ = found.collect()
    assert nodes == {(r["lang"], r["a"], r["b"]): r["times"] for r in rows_ if r["b"] and not r["c"]}
    assert edges == {(r["lang"], r["a"], r["b"], r["c"]): r["times"] for r in rows_ if r["c"]}
    assert longest >= 6


def test_long_path_is_cut(spark, monkeypatch):
    monkeypatch.setattr(phrases, "PATH_NODES", 4)
    rows = [(" ".join(f"v{i}" for i in range(30)), "en")] * 10
    paths, links = phrases.compacted(written(phrases.grams(table(spark, rows))))
    assert sorted(len(p["flows"]) for p in paths.collect()) == [1, 4, 4, 4, 4, 4, 4, 4] and links.count() == 7
    got = phrases.collocations(table(spark, rows))
    assert cases.tuples(got, *got.columns) == brute(rows)


def test_score_is_exact(spark):
    big = 10**14 + 7
    got = spark.range(1).selectExpr(f"{big}L as a", f"{big * 3 + 1}L as l", f"{big + 5}L as r").select(phrases._score("a", "l", "r"))
    assert got.first()[0] == 1000000 * big * big // ((big * 3 + 1) * (big + 5))


def test_empty(spark):
    assert phrases.collocations(cases.empty_table(spark)).count() == 0

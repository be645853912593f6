import hashlib
import random
import re

import cases
import pytest

from meterqa.llm import decontaminate as dc
from meterqa.llm.base import written

WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall((text or "").encode().lower())


def brute(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                ids = windows.get(tuple(w[i : i + n]))
                if ids:
                    hit |= set(range(i, i + n))
                    found |= ids
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


def some_tables():
    rng = random.Random(5)
    few = ["a", "b", "The", "É", "漢", "x1"]
    items = [(i, " ".join(rng.choice(few) for _ in range(rng.choice([1, 2, 9, 10, 11, 25])))) for i in range(12)]
    items += [(3, "a b a b a b a b a b a b a b"), (None, "the-quick,brown fox"), (50, None), (51, " ?! "), (52, "a"), (3, items[3][1])]
    items += [(60, cases.prose(rng, 40)), (61, cases.prose(rng, 12)), (62, "one\x00two three")]
    docs = [(i, " ".join(rng.choice(few) for _ in range(rng.randint(0, 80)))) for i in range(60)]
    docs += [(None, "THE QUICK. brown\nFOX"), (70, None), (71, ""), (72, "a " * 300), (72, "a " * 300), (73, "one two THREE"), (74, "É é"), (75, "..")]
    for i, n in ((80, 40), (81, 25), (82, 10), (83, 9)):
        part = items[18][1].split()[5 : 5 + n]
        docs.append((i, cases.prose(rng, 30) + " " + ", ".join(part) + " " + cases.prose(rng, 500)))
    docs += cases.odd_documents()[:20] and [(r[0], r[1]) for r in cases.odd_documents()[:20]]
    return docs, items


def tables(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, "z", 2) for i, t in docs], "doc_id long, text string, row int, term string, n_words int")
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, item int")
    return d.repartition(5), b


def test_against_brute_force(spark):
    docs, items = some_tables()
    got = dc.contaminated(*tables(spark, docs, items))
    assert cases.tuples(got, *got.columns) == brute(docs, items)


def test_frequent_words_and_copies(spark):
    """Windows of frequent words only, in one text a thousand times."""
    rng = random.Random(6)
    passage = " ".join(rng.choice(["of", "the"]) for _ in range(14))
    docs = [(i, f"the of {i} {passage} of the the" if i % 3 == 0 else "of the " * 20) for i in range(900)]
    items = [(1, passage), (2, "unique0 " + passage[:30])]
    got = dc.contaminated(*tables(spark, docs, items))
    assert cases.tuples(got, *got.columns) == brute(docs, items)


@pytest.mark.parametrize("empty", ["docs", "items", "both"])
def test_empty(spark, empty):
    docs, items = some_tables()
    docs = [] if empty in ("docs", "both") else docs
    items = [] if empty in ("items", "both") else items
    got = dc.contaminated(*tables(spark, docs, items))
    assert cases.tuples(got, *got.columns) == brute(docs, items)


def test_proximity(spark):
    item = [f"w{i}" for i in range(12)]
    near = item[:4] + ["x"] + item[4:]
    far = item[:4] + ["x"] * 3 + item[4:]
    docs, items = [(1, " ".join(item)), (2, " ".join(near)), (3, " ".join(far)), (4, "w0 w1")], [(9, " ".join(item))]
    d, b = tables(spark, docs, items)
    terms = written(dc.item_terms(b))
    postings = written(dc.index(d, terms))
    ids = {r["row"]: r["id"] for r in postings.filter("place = 0").collect()}
    found = {(ids[r["row"]], r["exact"]) for r in dc.matches(postings, terms, slack=1).collect()}
    assert (1, True) in found and (2, False) in found and (2, True) not in found and not any(i in (3, 4) for i, _ in found)
    assert {ids[r["row"]] for r in dc.matches(postings, terms).collect()} == {1}
    assert 3 in {ids[r["row"]] for r in dc.matches(postings, terms, slack=3).collect()}


def test_native(spark):
    docs, items = some_tables()
    d, b = tables(spark, docs, items)
    terms = dc.item_terms(b)
    for df in (terms, dc.index(d, terms), dc.contaminated(d, b), dc.matches(written(dc.index(d, terms)), written(terms), slack=2)):
        plan = df._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Cartesian", "NestedLoop"))

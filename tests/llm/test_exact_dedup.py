import hashlib
import re

import cases

from meterqa.llm import exact_dedup


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_groups_against_brute_force(spark):
    rows = cases.odd_documents()
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(normalised(text), []).append(doc_id)
    want = []
    for doc_id, text, *_ in rows:
        ids = groups[normalised(text)]
        keep = min((i for i in ids if i is not None), default=None)
        want.append((doc_id, keep, len(ids), hashlib.sha256(normalised(text).encode()).hexdigest()))
    got = exact_dedup.exact_groups(cases.odd_table(spark))
    key = lambda r: tuple((x is None, x) for x in r)
    assert cases.tuples(got, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(want, key=key)
    kept = got.filter("kept").groupBy("text_sha256").count().collect()
    assert {r["count"] for r in kept} == {1} and len(kept) == len(groups)
    assert got.filter("kept and not (doc_id <=> keep_id)").count() == 0


def test_saturated_filter_gives_the_same(spark):
    docs = cases.odd_table(spark)
    columns = ("doc_id", "keep_id", "group_size", "text_sha256")
    assert cases.tuples(exact_dedup.exact_groups(docs), *columns) == cases.tuples(
        exact_dedup.exact_groups(docs, segments=1), *columns
    )


def test_only_possible_copies_are_flagged(spark):
    hashes = spark.range(0, 20000).selectExpr("xxhash64(id) AS h").union(spark.range(0, 50).selectExpr("xxhash64(id) AS h"))
    cells = exact_dedup.repeated_cells(hashes)
    flagged = exact_dedup.possibly_repeated(hashes, "h", cells, exact_dedup.SEGMENTS, "maybe").filter("maybe")
    twice = hashes.groupBy("h").count().filter("count > 1").select("h")
    assert flagged.join(twice, "h", "left_semi").count() == 100
    assert flagged.count() < 120


def test_drop_copies_keeps_columns(spark):
    docs = cases.odd_table(spark)
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    seen = {}
    for doc_id, text, *_ in cases.odd_documents():
        k = normalised(text)
        seen[k] = min(seen.get(k, (True, 0)), (doc_id is None, doc_id or 0))
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, normalised(r["text"])) for r in left.collect())
    assert got == sorted((*v, k) for k, v in seen.items())
    assert {tuple(r)[5:] for r in left.collect()} == {cases.EXTRA}


def test_empty(spark):
    assert exact_dedup.exact_groups(cases.empty_table(spark)).count() == 0
    assert exact_dedup.drop_copies(cases.empty_table(spark)).count() == 0

import zlib
from collections import Counter

import cases

from meterqa.llm import sharding


def test_rows_and_slots(spark):
    got = sharding.sharded(cases.odd_table(spark), [1.0] * 16)
    rows = cases.tuples(got, "doc_id", "size", "text_crc32")
    want = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in cases.odd_documents()]
    assert rows == sorted(want, key=lambda r: tuple((x is None, x) for x in r))
    slots = {}
    for r in got.collect():
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_weights_and_growth(spark):
    docs = spark.range(40000).selectExpr("id AS doc_id", "'x' AS text")
    got = sharding.sharded(docs, [1.0, 2.0, 0.0, 1.0], grown=1.0).collect()
    share = Counter(r["shard"] for r in got)
    assert share[2] == 0 and abs(share[1] / 40000 - 0.5) < 0.02
    moved = [r for r in got if r["grown_shard"] != r["shard"]]
    assert all(r["grown_shard"] == 4 for r in moved) and abs(len(moved) / 40000 - 0.2) < 0.02


def test_key_alone_decides(spark):
    a = sharding.sharded(spark.createDataFrame([(5, "x"), (5, "y"), (5, None)], "doc_id long, text string"), [1.0] * 16)
    assert len({r["shard"] for r in a.collect()}) == 1
    assert sharding.sharded(cases.empty_table(spark), [1.0] * 3).count() == 0


def test_native(spark):
    plan = sharding.sharded(cases.odd_table(spark), [1.0] * 16)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

import random
from collections import Counter

import cases
import pytest

from meterqa.llm import mixing


def test_windows_are_met():
    rng = random.Random(2)
    for _ in range(60):
        weights = [rng.randint(1, 40) for _ in range(rng.randint(1, 9))]
        period, placed = sum(weights), mixing.pfair_period(weights)
        assert sorted(x for p in placed for x in p) == list(range(period))
        for w, slots in zip(weights, placed, strict=True):
            for i, slot in enumerate(slots):
                assert i * period // w <= slot < -(-(i + 1) * period // w)
        done = Counter()
        owner = {x: s for s, p in enumerate(placed) for x in p}
        for slot in range(period):
            done[owner[slot]] += 1
            for s, w in enumerate(weights):
                assert abs(done[s] - w * (slot + 1) / period) < 1


def schedule(blocks, weights):
    """Source of each slot, from the phases."""
    slots = {}
    for s, first, after, slot0, period, weight, inside in mixing.phases(blocks, weights):
        for b in range(first, after):
            at = slot0 + (b - first) // weight * period + inside[(b - first) % weight]
            assert at not in slots
            slots[at] = s
    return [slots[i] for i in range(len(slots))]


def test_phases_place_all_blocks_near_their_share():
    rng = random.Random(6)
    for _ in range(60):
        n = rng.randint(1, 7)
        blocks, weights = [rng.randint(0, 60) for _ in range(n)], [rng.randint(1, 12) for _ in range(n)]
        order = schedule(blocks, weights)
        assert Counter(order) == Counter({s: b for s, b in enumerate(blocks) if b})
        left, start, done = Counter(order), 0, Counter()
        for slot, s in enumerate(order):
            done[s] += 1
            active = [x for x in range(n) if left[x] > 0]
            total = sum(weights[x] for x in active)
            for x in active:
                assert abs(done[x] - weights[x] * (slot + 1 - start) / total) < 1
            if done[s] == left[s]:  # a source ended: shares start anew
                for x in done:
                    left[x] -= done[x]
                start, done = slot + 1, Counter()


def test_table(spark):
    docs = cases.odd_table(spark)
    got = mixing.mix_order(docs, block=4).collect()
    rows = cases.odd_documents()
    assert Counter((r["doc_id"], r["source"]) for r in got) == Counter((r[0], r[3]) for r in rows)
    sizes = Counter(r[3] for r in rows)
    names = sorted(sizes, key=lambda s: (-sizes[s], (s is not None, s or "")))
    weights = mixing.quanta([sizes[s] ** mixing.FLATTEN for s in names])
    order = schedule([-(-sizes[s] // 4) for s in names], weights)
    slots = {r["slot"]: r["source"] for r in got}
    assert [slots[i] for i in range(len(slots))] == [names[s] for s in order]
    assert len({r["place"] for r in got}) == len(rows)
    assert Counter(Counter((r["source"], r["block"]) for r in got).values())[4] >= sum(n // 4 for n in sizes.values())


def test_given_weights(spark):
    docs = spark.createDataFrame([(i, f"s{i % 5}") for i in range(100)], "doc_id long, source string")
    got = mixing.mix_order(docs, {"s0": 3, "s1": 0.5, "s2": 0.5}, block=1).orderBy("place").collect()
    assert len(got) == 100 and {r["slot"] for r in got} == set(range(100))
    assert Counter(r["source"] for r in got[:24]) == {"s0": 12, "s1": 2, "s2": 2, "s3": 4, "s4": 4}
    none = mixing.mix_order(docs, {"s0": 0, "s3": 0}, block=1).orderBy("place").collect()
    assert {r["source"] for r in none[:60]} == {"s1", "s2", "s4"}
    assert Counter(r["source"] for r in none[60:70]) == {"s0": 5, "s3": 5}
    for bad in (-1, float("nan"), float("inf")):
        with pytest.raises(ValueError):
            mixing.mix_order(docs, {"s0": bad})


def test_a_small_source_keeps_its_weight(spark):
    docs = spark.createDataFrame([(i, f"s{i // 2:03d}") for i in range(1200)], "doc_id long, source string")
    got = mixing.mix_order(docs, {"s599": 50}, block=1).collect()
    assert {r["slot"] for r in got} == set(range(1200))
    assert sorted(r["slot"] for r in got if r["source"] == "s599")[-1] < 30


def test_thousands_of_sources_follow_their_weights(spark):
    rng = random.Random(8)
    weights = {f"s{i:04d}": rng.choice([0.25, 1, 3, rng.uniform(1, 60)]) for i in range(2000)}
    weights["s0007"] = 4000.0
    blocks = {s: 400 if s == "s0007" else rng.randint(6, 12) for s in weights}
    docs = spark.createDataFrame([(i, s) for s, n in blocks.items() for i in range(n)], "doc_id long, source string")
    got = mixing.mix_order(docs, weights, block=1).orderBy("place").collect()
    assert [r["slot"] for r in got] == list(range(sum(blocks.values())))
    assert Counter(r["source"] for r in got) == Counter(blocks)
    total, done, worst = sum(weights.values()), Counter(), 0.0
    for slot, r in enumerate(got[: int(0.09 * total)]):  # before a source ends
        done[r["source"]] += 1
        for s in {r["source"], "s0007", f"s{slot % 2000:04d}"}:
            worst = max(worst, abs(done[s] - weights[s] * (slot + 1) / total))
            assert done[s] < blocks[s]
    assert worst < 1.2, worst  # below one block, and a part of one for the bucket and for rounding


def test_buckets_of_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHILDREN", 8)
    rng = random.Random(9)
    weights = {f"s{i}": rng.choice([0, 0.001, 1, 1, 7, 1000]) for i in range(150)} | {None: 2.5}
    rows = [(i, s) for s in weights for i in range(rng.randint(1, 9))]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    got = mixing.mix_order(docs, weights, block=2).collect()
    assert Counter((r["doc_id"], r["source"]) for r in got) == Counter(rows)
    slots = {(r["source"], r["block"]): r["slot"] for r in got}
    assert sorted(slots.values()) == list(range(len(slots)))
    zero = [x for (s, _), x in slots.items() if weights[s] == 0]
    assert min(zero) > max(x for (s, _), x in slots.items() if weights[s] > 0)


def test_mixed_is_in_order_and_whole(spark):
    docs = cases.odd_table(spark)
    got = mixing.mixed(docs, block=4)
    assert got.columns == docs.columns
    assert cases.tuples(got, *docs.columns) == cases.tuples(docs, *docs.columns)
    want = [(r["doc_id"], r["source"]) for r in mixing.mix_order(docs, block=4).orderBy("place").collect()]
    have = [(r["doc_id"], r["source"]) for r in got.collect()]
    assert [s for _, s in have] == [s for _, s in want]
    assert mixing.mixed(cases.empty_table(spark)).count() == 0
    assert mixing.mix_order(cases.empty_table(spark)).count() == 0

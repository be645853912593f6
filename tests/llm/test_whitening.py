import random
from decimal import Decimal

import numpy as np
import pytest

from meterqa.llm import eigen, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, component int, n string"


def some_matrices():
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 7, 40):
        m = rng.normal(size=(size, size))
        yield m @ m.T
    yield np.eye(6) * 3
    yield np.diag([5.0, 5, 5, 2, 2, 0])
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    yield q @ np.diag([9, 9, 9 - 1e-13, 4, 4, 4, 1, 1, 1e-9, 0, 0, 0]) @ q.T
    yield np.ones((5, 5))
    yield np.zeros((4, 4))


def test_leading_against_a_dense_solver():
    for m in some_matrices():
        m = (m + m.T) / 2
        values, vectors = eigen.leading(m, 32)
        want = np.linalg.eigvalsh(m)[::-1]
        scale = max(want[0], 1e-300)
        assert np.abs(values - want[: len(values)]).max(initial=0) <= 1e-13 * scale
        assert (want[len(values) : 32] <= 1e-13 * scale).all()
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max(initial=0) < 1e-11
        assert np.abs(m @ vectors - vectors * values).max(initial=0) < 1e-12 * scale


def test_sturm_counts():
    rng = np.random.default_rng(2)
    d, e = rng.normal(size=9), rng.normal(size=8)
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = np.r_[values - 1e-9, values + 1e-9]
    assert eigen.sturm_counts(d, e, at).tolist() == [*range(9), *range(1, 10)]


def brute(rows, components=32):
    """(id, deviation, whitened up to signs) by exact sums and a dense solver."""
    good = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in good]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in x]
    z = np.array([[(n * c - s) / n for c, s in zip(r, sums, strict=True)] for r in x])
    values, axes = np.linalg.eigh(z.T @ z / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return [i for i, _ in good], deviations, z @ axes / np.sqrt(values), values / np.trace(z.T @ z / n), n


@pytest.mark.parametrize("size", [40, 5])
def test_against_brute_force(spark, size):
    rng = random.Random(size)
    rows = [(i, [rng.gauss(0, 1 + j % 3) for j in range(size)]) for i in range(400)]
    rows += [(400, None), (401, []), (402, [None] * size), (403, [float("nan")] * size), (404, [1.0] * (size - 1) + [float("inf")])]
    rows += [(7, rows[7][1]), (None, rows[8][1]), (405, rows[9][1])]
    ids, deviations, want, explained, n = brute(rows)
    table = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], SCHEMA).repartition(5)
    short = spark.createDataFrame([(900, [1.0, 2.0], 1, 1, "x")], SCHEMA)
    got = whitening.whitened(table.union(short)).collect()
    k = min(32, size)
    assert len(got) == len(ids) * k and {r["n"] for r in got} == {n}
    assert max(r["identity_error"] for r in got) < 1e-9 and len({r["identity_error"] for r in got}) == 1
    by = {}
    for r in got:
        by.setdefault((r["deviation"], r["component"]), []).append((r["whitened"], r["explained"]))
    for at, (d, row) in enumerate(zip(deviations, want, strict=True)):
        for c in range(k):
            values = by[Decimal(d), c + 1]
            assert min(abs(abs(w) - abs(row[c])) for w, _ in values) < 1e-8, at
            assert abs(values[0][1] / explained[c] - 1) < 1e-9
    shown = sorted((str(r["vec_id"]), r["deviation"]) for r in got if r["component"] == 1)
    assert shown == sorted((str(i), Decimal(d)) for i, d in zip(ids, deviations, strict=True))


def test_signs_are_the_same_for_all_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 6)) * 4
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = whitening.whitened(table.repartition(7), 3).orderBy("component", "vec_id").collect()
    w = np.array([r["whitened"] for r in got]).reshape(3, 300)
    assert np.abs(w @ w.T / 300 - np.eye(3)).max() < 1e-9


def test_large_entries_stay_exact(spark):
    rows = [(i, [1e13 * (i % 3), -1e30 if i == 4 else float(i)]) for i in range(6)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["deviation"] for r in whitening.whitened(table.limit(4)).filter("component = 1").collect()}
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in rows[:4]]
    sums = [sum(c) for c in zip(*x, strict=True)]
    assert got == {i: Decimal(sum((4 * c - s) ** 2 for c, s in zip(r, sums, strict=True))) for i, r in enumerate(x)}


def test_without_variance(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whitened(empty).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0], 1, 1, "") for i in range(3)] + [(9, None, 1, 1, "")], SCHEMA)
    assert whitening.whitened(same).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 3.0], 1, 1, "") for i in range(9)], SCHEMA)
    assert {r["component"] for r in whitening.whitened(line).collect()} == {1}

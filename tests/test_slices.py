import random

import pytest

from meterqa.sources import tables
from tests.conftest import final_plan, rows


@pytest.mark.parametrize("n", [0, 1, 255, 256, 3000])
def test_slices_are_those_of_the_sorted_names(spark, n):
    rng = random.Random(n)
    names = [f"BU{rng.randrange(40):02d}/{i:04d}-M1" for i in range(n)]
    names += rng.sample(names, n // 3) + [None] * (n % 4)
    sites = spark.createDataFrame([(x, i) for i, x in enumerate(names)], "site string, _range int").repartition(7)
    want = sorted(names, key=lambda x: (x is not None, x or ""))
    for start, stop in ((0, 5), (3, 8), (n // 2, n // 2 + 40), (n - 2 if n > 2 else 0, n + 50), (2 * n + 9, 3 * n + 12), (4, 4), (9, 2)):
        got = tables.site_slice(sites, start, stop)
        assert got.columns == ["site", "_range"]
        assert [r.site for r in got.collect()] == want[start:max(stop, start)]
    whole = tables.site_slice(sites, 0, len(names) + 1)
    assert sorted(r["_range"] for r in whole.collect()) == list(range(len(names)))


def test_negative_positions(spark):
    with pytest.raises(ValueError, match="from 0"):
        tables.site_slice(spark.range(3), -1, 2)


def test_deep_slice_shuffles_only_its_ranges(spark):
    """Of a long table about one range in 256 reaches the window; no task merges the names before the slice."""
    n = 200_000
    sites = spark.range(n, numPartitions=16).selectExpr("concat('BU', lpad(id * 7919 % 200000, 9, '0')) as site")
    deep = tables.site_slice(sites, n - 30, n - 10)
    plan = final_plan(deep)
    assert rows(deep) == [(f"BU{i:09d}",) for i in range(n - 30, n - 10)]
    assert "GlobalLimit" not in plan.split("Subquery")[0]
    assert "_first" in plan[plan.index("Window [row_number") :]

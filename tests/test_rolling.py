import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from meterqa.operators import grids, rolling
from tests.conftest import rows

BEGIN = dt.datetime(2024, 2, 27)


@pytest.fixture(scope="module")
def readings(spark):
    rng = random.Random(3)
    data = []
    for site, n in (("A", 4000), ("B", 900), ("C", 40)):
        for _ in range(n):
            at = BEGIN + dt.timedelta(seconds=rng.randrange(40 * 86400))
            data.append((site, at, None if rng.random() < 0.05 else rng.randint(-8, 400) / 8))
    data += [("A", None, 3.0), (None, BEGIN, 2.0), (None, BEGIN, 3.0)]
    return data, spark.createDataFrame(data, "site string, date_time timestamp_ntz, value double")


def by_hand(data, seconds, length, need):
    steps = {}
    for site, at, value in data:
        if at is not None and value is not None:
            k = (site, int((at - dt.datetime(1970, 1, 1)).total_seconds()) // seconds)
            n, total = steps.get(k, (0, 0.0))
            steps[k] = (n + 1, total + value)
    out = {}
    for (site, at), (n, total) in steps.items():
        size = length(site) or 0
        inside = [steps[site, x][1] for x in range(at - size + 1, at + 1) if (site, x) in steps]
        enough = size > 0 and len(inside) >= (size if need is None else need)
        out[site, at] = (n, total, sum(inside) / len(inside) if enough else None)
    return out


def found(df, seconds):
    per_day = 86400 // seconds
    epoch = dt.date(1970, 1, 1)
    return {(r.site, (r.date - epoch).days * per_day + r.step): (r.readings, r.volume, r.ma) for r in df.collect()}


@pytest.mark.parametrize("chunk", [7, 64, 4096])
@pytest.mark.parametrize("seconds, steps, need", [(3600, 24, 6), (900, 96, 20), (86400, 5, None), (60, 1, 1)])
def test_against_steps_by_hand(readings, seconds, steps, need, chunk):
    data, df = readings
    totals = rolling.step_totals(df, seconds)
    got = found(rolling.rolling_average(totals, seconds, steps, need, chunk=chunk), seconds)
    want = by_hand(data, seconds, lambda _: steps, need)
    assert got.keys() == want.keys()
    for k, (n, total, mean) in want.items():
        assert got[k][:2] == (n, total)
        assert got[k][2] == (mean if mean is None else pytest.approx(mean))


def test_own_length_of_each_site(readings):
    data, df = readings
    lengths = {"A": 30, "B": 0, "C": 500}
    own = F.when(F.col("site") == "A", 30).when(F.col("site") == "B", 0).when(F.col("site") == "C", 500)
    totals = rolling.step_totals(df, 3600).withColumn("n", own)
    got = found(rolling.rolling_average(totals, 3600, "n", 3, chunk=50), 3600)
    want = by_hand(data, 3600, lengths.get, 3)
    assert {k: x[2] for k, x in got.items()} == {k: x[2] if x[2] is None else pytest.approx(x[2]) for k, x in want.items()}
    assert any(x[2] is not None for k, x in want.items() if k[0] == "C")


def test_days_are_the_moving_average(readings):
    """On days with a value it equals the average over the calendar."""
    _, df = readings
    df = df.filter("site is not null and date_time is not null and value is not null")
    days = rolling.rolling_average(rolling.step_totals(df, 86400), 86400, 30, 21).select("site", "date", F.round("ma", 9))
    grid = grids.moving_average(grids.fill_days(grids.daily_totals(df)), 30, 21)
    grid = grid.filter("not added").select("site", "date", F.round("ma", 9))
    assert rows(days, "site", "date") == rows(grid, "site", "date")


def test_hot_site_is_cut_in_chunks(readings):
    _, df = readings
    totals = rolling.step_totals(df, 60)
    plan = rolling.rolling_average(totals, 60, 60, 1)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(site#\d+, _chunk#\d+L", plan) and "partial_sum" in plan
    chunk = 512
    spread = rolling.rolling_average(totals, 60, 60, 1, chunk=chunk).withColumn(
        "c", F.floor((F.datediff("date", F.lit("1970-01-01").cast("date")) * 1440 + F.col("step")) / chunk)
    )
    assert spread.groupBy("site", "c").count().agg(F.max("count")).first()[0] <= chunk


def test_odd_tables(spark, readings):
    _, df = readings
    assert rolling.rolling_average(rolling.step_totals(df.limit(0), 900), 900, 4).count() == 0
    with pytest.raises(ValueError, match="whole number"):
        rolling.step_totals(df, 7000)

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from meterqa.functions.calendar import day_lit
from meterqa.operators import grids
from meterqa.plans import reports
from tests.conftest import rows

D = dt.date


def days(first, n):
    return [first + dt.timedelta(days=i) for i in range(n)]


@pytest.fixture(scope="module")
def gappy(spark):
    rng = random.Random(5)
    data = []
    for s, start in (("A", D(2020, 1, 10)), ("B", D(2020, 8, 1))):
        for d in days(start, 300):
            if rng.random() < 0.8:
                data.append((s, d, rng.randint(1, 5), rng.randint(0, 1000) / 8))
    return data, spark.createDataFrame(data, "site string, date date, readings long, volume double")


def test_fill_days_is_the_calendar(gappy):
    data, daily = gappy
    start, end = D(2020, 1, 1), D(2021, 7, 1)
    grid = grids.fill_days(daily, day_lit(start), day_lit(end))
    got = {(r.site, r.date): (r.volume, r.added) for r in grid.collect()}
    n = (end - start).days + 1
    assert len(got) == grid.count() == 2 * n
    known = {(s, d): v for s, d, _, v in data}
    for site in "AB":
        for d in days(start, n):
            value = known.get((site, d))
            assert got[site, d] == (value, value is None)


def test_fill_days_defaults_and_fill(gappy):
    data, daily = gappy
    grid = grids.fill_days(daily, fill={"readings": F.lit(0).cast("long")})
    for site in "AB":
        have = [d for s, d, *_ in data if s == site]
        got = [r for r in grid.filter(F.col("site") == site).orderBy("date").collect()]
        assert [r.date for r in got] == days(min(have), (max(have) - min(have)).days + 1)
        assert sum(r.readings for r in got) == sum(x[2] for x in data if x[0] == site)


def naive_average(series, window, need):
    out = []
    for i in range(len(series)):
        part = [x for x in series[max(0, i - window + 1) : i + 1] if x is not None]
        out.append(sum(part) / len(part) if len(part) >= need else None)
    return out


def test_moving_average_30(gappy):
    _, daily = gappy
    grid = grids.fill_days(daily)
    averaged = grids.moving_average(grid, 30, 21)
    for site in "AB":
        got = averaged.filter(F.col("site") == site).orderBy("date").collect()
        want = naive_average([r.volume for r in got], 30, 21)
        assert [r.ma for r in got] == pytest.approx(want)


@pytest.mark.parametrize("period", [1, 2, 7, 28, 365])
def test_moving_average_by_period(gappy, period):
    _, daily = gappy
    grid = grids.fill_days(daily).withColumn(
        "volume", F.coalesce("volume", F.when(F.dayofmonth("date") != 3, F.lit(1.5)))
    )
    grid = grid.withColumn("n", F.when(F.col("site") == "A", F.lit(period)))
    got = grids.moving_average_by_period(grid, "n")
    a = got.filter("site = 'A'").orderBy("date").collect()
    assert [r.ma for r in a] == pytest.approx(naive_average([r.volume for r in a], period, period))
    assert got.filter("site = 'B' and ma is not null").isEmpty()


def test_no_average_for_a_zero_period(gappy):
    _, daily = gappy
    got = grids.moving_average_by_period(grids.fill_days(daily).withColumn("n", F.lit(0)), "n")
    assert got.filter("ma is not null").isEmpty()


def test_missing_dates_and_seen_dates_make_the_calendar(observations):
    obs = observations(
        [("S", "Compliance Volume", f"2024-01-{d:02d}T08:00:00", 1.0) for d in (3, 4, 9)]
    )
    missing = grids.missing_dates(obs, day_lit("2024-01-01"), day_lit("2024-01-10"))
    assert [r.date.day for r in missing.orderBy("date").collect()] == [1, 2, 5, 6, 7, 8, 10]


def test_hourly_plot_table(observations):
    obs = observations(
        [
            ("S", "Compliance Volume", "2024-01-30T08:10:00", 1.25),
            ("S", "Compliance Volume", "2024-01-30T08:40:00", 1.5),
            ("S", "Compliance Volume", "2024-01-30T09:00:00", -2.5),
            ("S", "Compliance Volume", "2024-01-31T00:00:00", 4.0),  # closing midnight
            ("S", "Compliance Volume", "2024-01-31T01:00:00", 5.0),  # after it
            ("S", "Volume", "2024-01-30T09:00:00", 99.0),
        ]
    )
    table = reports.hourly_plot_table(obs, "2024-01-31")
    got = table.filter("date >= '2024-01-29'").drop("site")
    assert rows(got, "date", "hour") == [
        (D(2024, 1, 29), 0, "1/29", "29", 0, 0, 0.0),
        (D(2024, 1, 30), 8, "1/30", "30", 2, 2, 2.75),
        (D(2024, 1, 30), 9, "1/30", "30", 1, -2, -2.5),
        (D(2024, 1, 31), 0, "1/31", "31", 1, 4, 4.0),
    ]
    assert table.count() == 31 + 2


def test_month_table_drops_the_last_row_and_keeps_negatives(observations):
    obs = observations(
        [
            ("S", "Water Meter", "2024-01-07T00:00:00", 1.0),  # before the window
            ("S", "Water Meter", "2024-01-08T00:00:00", 50.0),
            ("S", "Water Meter", "2024-01-08T01:00:00", 45.0),
            ("S", "Volume", "2024-01-09T03:00:00", 2.0),
            ("S", "Stage", "2024-01-09T03:00:00", 2.0),
        ]
    )
    table = reports.month_hourly_table(obs, "2024-01-08")
    assert {r.measurement for r in table.select("measurement").distinct().collect()} == {
        "Water Meter",
        "Volume",
    }
    register = table.filter("measurement = 'Water Meter' and date = '2024-01-08'")
    assert rows(register.select("hour", "readings", "volume"), "hour") == [(0, 0, 0.0), (1, 1, -5.0)]
    last = table.groupBy("measurement").agg(F.max("date").alias("d"), F.count("*").alias("n"))
    assert rows(last, "measurement") == [
        ("Volume", D(2024, 2, 11), 35),
        ("Water Meter", D(2024, 2, 11), 36),
    ]


def test_daily_series_starts_with_the_water_year(observations):
    from meterqa.operators import volumes

    vols = volumes.plain_volumes(
        observations(
            [("A", "Volume", "2020-06-30T05:00:00", 86.4), ("B", "Volume", "2020-07-02T05:00:00", 8.64)]
        )
    )
    table = reports.daily_series(vols)
    assert rows(table.groupBy("site").agg(F.min("date"), F.max("date")), "site") == [
        ("A", D(2019, 7, 1), D(2020, 6, 30)),
        ("B", D(2020, 7, 1), D(2020, 7, 2)),
    ]
    b = table.filter("site = 'B'").select("readings", "volume", "rate")
    assert rows(b, "date") == [(0, None, None), (1, 8.64, pytest.approx(0.1))]
    unfilled = reports.daily_series(vols, fill_readings=False).filter("site = 'B'")
    assert [r.readings for r in unfilled.orderBy("date").collect()] == [None, 1]

"""Stored day rows: increments against full runs, and against the reports from readings."""

import datetime as dt
import random

import pytest
from conftest import rows

from meterqa.operators import day_bitmaps, day_states, reporting, series, stored_days, volumes
from meterqa.schema import COMPLIANCE_VOLUME
from meterqa.sources import archive
from meterqa.sources.tables import measurement_catalog

BEGIN = dt.datetime(2024, 1, 1)


def some_readings(rng, days, per_day=4):
    out = []
    for site in ("A", "B", "C"):
        for kind in ("Water Meter", COMPLIANCE_VOLUME):
            level = 0.0
            for day in days:
                for k in range(rng.randint(0, per_day)):
                    level += rng.choice([1.0, 2.5, 7.0, -3.0])
                    at = BEGIN + dt.timedelta(days=day, hours=24 // per_day * k)
                    out.append((site, kind, at, level if kind == "Water Meter" else abs(level) - 2))
    return out


@pytest.fixture()
def paths(tmp_path):
    return str(tmp_path / "archive"), str(tmp_path / "days")


def test_increments_equal_a_full_run(spark, observations, paths, tmp_path):
    rng = random.Random(4)
    first = some_readings(rng, range(0, 20))
    fixed = [(s, m, t, v + 100) for s, m, t, v in first if t.day in (3, 9)]  # corrected
    withdrawn = [(s, m, t, None) for s, m, t, v in first if t.day == 5 and s == "A"]
    late = some_readings(rng, [18, 19, 20, 21]) + first[:7] + first[:3]  # late, and repeated
    for no, part in enumerate((first, fixed + withdrawn, late)):
        archive.deliver(observations(part), paths[0], no)
        stored_days.refresh_days(spark, *paths, since=no)
    full = str(tmp_path / "full")
    stored_days.refresh_days(spark, paths[0], full)
    order = ("site", "measurement", "date")
    columns = stored_days.stored(spark, full).columns
    got = rows(stored_days.stored(spark, paths[1]).select(*columns), *order)
    assert got == rows(stored_days.stored(spark, full), *order)
    current = {}
    for part in (first, fixed + withdrawn, late):
        seen = {}
        for s, m, t, v in part:
            seen[s, m, t] = max((x for x in (seen.get((s, m, t)), v) if x is not None), default=None)
        current |= seen
    assert {(r.site, r.measurement, r.date_time): r.value for r in archive.current_readings(spark, paths[0]).collect()} == current
    # A run again, and a delivery again, change nothing.
    archive.deliver(observations(late), paths[0], 2)
    stored_days.refresh_days(spark, *paths, since=1)
    assert rows(stored_days.stored(spark, paths[1]).select(*columns), *order) == got


def test_only_touched_days_are_read_and_replaced(spark, observations, paths, tmp_path):
    rng = random.Random(5)
    archive.deliver(observations(some_readings(rng, range(12), 9)), paths[0], 0)
    stored_days.refresh_days(spark, *paths, since=0)

    def files():
        return {p.parent.name: p.stat().st_mtime_ns for p in (tmp_path / "days").rglob("part-*.parquet")}

    before = files()
    archive.deliver(observations([("A", "Volume", BEGIN + dt.timedelta(days=4), 1.0)]), paths[0], 1)
    assert stored_days.refresh_days(spark, *paths, since=1) == [dt.date(2024, 1, 5)]
    after = files()
    assert {d for d in after if after[d] != before.get(d)} == {"date=2024-01-05"} and set(after) == set(before)
    read = archive.current_readings(spark, paths[0], [dt.date(2024, 1, 5)])
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan or "PartitionFilters: [(date" in plan
    assert all("date=2024-01-05" in f for f in read.inputFiles()) or len(read.inputFiles()) > 0


def test_difference_over_midnight_after_a_late_day(spark, observations, paths):
    """A day that arrives late stands between its neighbours, whose rows are not written again."""
    def at(day, hour=0):
        return BEGIN + dt.timedelta(days=day, hours=hour)

    archive.deliver(observations([("A", "Water Meter", at(0), 5.0), ("A", "Water Meter", at(2), 50.0)]), paths[0], 0)
    stored_days.refresh_days(spark, *paths, since=0)
    cat = [("A", "Water Meter", at(0), at(9))]
    plan = series.stitch_plan(series.process_catalog(spark.createDataFrame(cat, "site string, measurement string, from_ts timestamp_ntz, to_ts timestamp_ntz")))

    def sums():
        return [r.sum_kept for r in stored_days.days_of_plan(stored_days.stored(spark, paths[1]), plan).orderBy("date").collect()]

    assert sums() == [None, 45.0]
    archive.deliver(observations([("A", "Water Meter", at(1), 20.0), ("A", "Water Meter", at(1, 5), 26.0)]), paths[0], 1)
    stored_days.refresh_days(spark, *paths, since=1)
    assert sums() == [None, 21.0, 24.0]


@pytest.mark.parametrize("combined", [True, False])
def test_states_against_volumes(spark, observations, combined):
    rng = random.Random(6)
    obs = observations(some_readings(rng, range(30), 6) + [("A", "Volume", BEGIN + dt.timedelta(days=40, hours=i), float(i)) for i in range(9)] + [("B", "Water Meter", BEGIN + dt.timedelta(days=31), None), ("B", "Water Meter", BEGIN + dt.timedelta(days=32), 4.0)])
    processed = series.process_catalog(measurement_catalog(obs))
    plan = series.stitch_plan(processed) if combined else series.whole_extent_plan(processed)
    vols = volumes.register_to_volume(obs, plan, "combined" if combined else "reset")
    want = vols.groupBy(*day_states.DAY).agg(*day_states.state_columns())
    got = stored_days.days_of_plan(stored_days.day_rows(obs), plan, combined)
    columns = [*day_states.DAY, *day_states.STATE]

    def table(df):
        return sorted(
            tuple(round(x or 0.0, 6) if isinstance(x, float) or x is None else x for x in r) for r in rows(df.select(*columns))
        )

    assert table(got) == table(want)


def test_reports_from_days(spark, observations):
    rng = random.Random(7)
    obs = observations(some_readings(rng, range(0, 120), 3))
    days = stored_days.day_rows(obs)
    as_of = dt.date(2024, 4, 20)
    daily = stored_days.counts_per_day(days, COMPLIANCE_VOLUME)
    assert rows(reporting.modes_of_days(daily, as_of), "site", "window_no") == rows(reporting.window_modes(obs, as_of), "site", "window_no")
    for end in (dt.date(2024, 4, 19), dt.date(2024, 4, 28), dt.date(2024, 12, 30)):
        got = rows(reporting.week_and_year_of_days(days, end), "site")
        assert got == rows(reporting.week_and_year(obs, end), "site")


def test_bitmaps(spark):
    rng = random.Random(9)
    data = {(s, dt.date(2023, 12, 1) + dt.timedelta(days=rng.randint(0, 800))) for s in "AB" for _ in range(300)}
    data |= {("C", dt.date(2024, 12, 31)), ("D", dt.date(2019, 1, 1))}
    dated = spark.createDataFrame([*data, *list(data)[:50], ("A", None), (None, dt.date(2024, 1, 5))], "site string, date date")
    halves = day_bitmaps.day_bits(dated.filter("dayofmonth(date) < 9")).unionByName(day_bitmaps.day_bits(dated.filter("dayofmonth(date) >= 9")))
    bits = day_bitmaps.merged_bits(halves).filter("site is not null")
    found = {r.site: (r.days_with_data, r.start_date, r.end_date) for r in day_bitmaps.distinct_days(bits).collect()}
    for s in "ABCD":
        days = [d for x, d in data if x == s]
        assert found[s] == (len(days), min(days), max(days))
    from meterqa.functions.calendar import day_lit

    lo, hi = dt.date(2023, 12, 20), dt.date(2026, 3, 3)
    window = [lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)]
    want = sorted((s, d) for s in "ABC" for d in window if (s, d) not in data)
    assert rows(day_bitmaps.missing_days(bits, day_lit(lo), day_lit(hi)), "site", "date") == want
    plan = day_bitmaps.missing_days(bits, day_lit(lo), day_lit(hi))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_bit_or" in plan

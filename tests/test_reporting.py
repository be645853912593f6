import datetime as dt
import random
from collections import Counter

import pytest

from meterqa.operators import reporting
from meterqa.plans import reports
from tests.conftest import rows, ts

CV = "Compliance Volume"
AS_OF = dt.date(2024, 6, 30)


def brute_mode(times, start, end):
    """Count readings per day up to the closing midnight, then the smallest most frequent."""
    closing = dt.datetime.combine(end, dt.time())
    inside = [t for t in times if dt.datetime.combine(start, dt.time()) <= t <= closing]
    if not inside:
        return None
    per_day = Counter(t.date() for t in inside)
    n = (end - start).days + 1
    freq = Counter(per_day.get(start + dt.timedelta(days=i), 0) for i in range(n))
    mode = min(freq, key=lambda k: (-freq[k], k))
    return mode, freq[mode], n


def brute_modes(data):
    by_site = {}
    for site, measurement, when, _ in data:
        if measurement == CV and "," not in site:
            by_site.setdefault(site, []).append(when)
    out = {}
    for site, times in by_site.items():
        windows = reporting.mode_windows(AS_OF)
        annual = brute_mode(times, *windows[0][2:])
        if annual is None:
            continue
        mode, n, total = annual
        out[site] = (mode, round(n / total, 2), "Annual")
        if mode == 0:
            for _, name, start, end in windows[1:]:
                found = brute_mode(times, start, end)
                if found and found[0] > 0:
                    out[site] = (found[0], None, name)
                    break
    return out


def random_readings(seed):
    rng = random.Random(seed)
    data = []
    for i in range(40):
        site = f"BU01/{i:04d}-M1" if i % 9 else f"BU01/{i:04d}-M1,BU01/{i + 1:04d}-M1"
        first, length = rng.randint(0, 420), rng.choice([0, 3, 40, 80, 95, 250, 420])
        per_day = rng.choice([1, 2, 3])
        for age in range(first, min(first + length, 430)):
            day = dt.datetime.combine(AS_OF - dt.timedelta(days=age), dt.time())
            for k in range(rng.choice([per_day, per_day, per_day - 1])):
                data.append((site, CV, day + dt.timedelta(hours=k * 7), 1.0))
        data.append((site, "Stage", ts("2024-06-01T00:00:00"), 1.0))
    return data


def test_modes_against_brute_force(observations):
    data = random_readings(21)
    got = {
        r.site: (r.mode, r.mode_freq, r.method)
        for r in reports.reporting_modes(observations(data), AS_OF).collect()
    }
    want = brute_modes(data)
    assert got == want
    assert {m for _, _, m in want.values()} >= {"Annual", "Qtr1", "Qtr2", "Qtr3"}


def test_mode_tie_takes_the_smaller_count(observations):
    data = []
    for i in range(366):
        day = dt.datetime.combine(AS_OF - dt.timedelta(days=i), dt.time())
        data += [("S", CV, day + dt.timedelta(minutes=m), 1.0) for m in range(2 if i % 2 else 5)]
    data = [x for x in data if x[2] <= dt.datetime.combine(AS_OF, dt.time())]
    # 5 readings on 182 days (the closing day has one), 2 on 183
    data += [("S", CV, dt.datetime(2024, 6, 29, 1 + i), 1.0) for i in range(3)]
    got = reports.reporting_modes(observations(data), AS_OF).first()
    assert (got.mode, got.method) == (brute_modes(data)["S"][0], "Annual")


def test_null_values_make_a_site_present_but_silent(observations):
    data = [("S", CV, "2024-06-01T01:00:00", None)]
    assert rows(reports.reporting_modes(observations(data), AS_OF)) == [("S", 0, 1.0, "Annual")]


def test_annual_mode_alone(observations):
    data = random_readings(8)
    got = {r.site: r.mode for r in reporting.annual_mode(observations(data), AS_OF).collect()}
    for site, value in got.items():
        times = [t for s, m, t, _ in data if s == site and m == CV]
        assert value == brute_mode(times, *reporting.mode_windows(AS_OF)[0][2:])[0]


def week(site, last_day, per_day, n_days=7):
    """Readings at the start of every period, closing midnight included."""
    step = dt.timedelta(hours=24 / per_day)
    first = dt.datetime.combine(last_day - dt.timedelta(days=n_days - 1), dt.time())
    return [(site, CV, first + step * i, 1.0) for i in range(n_days * per_day + 1)]


def test_full_week_of_hourly_readings_is_complete(spark, observations):
    modes = spark.createDataFrame([("S", 24)], "site string, mode int")
    table = reporting.weekly_completeness(modes, observations(week("S", AS_OF, 24)), AS_OF)
    assert rows(table) == [("S", 24, 100.0, ts("2024-07-01T00:00:00"))]


@pytest.fixture(scope="module")
def report(spark, observations):
    data = week("A", AS_OF, 24) + week("B", AS_OF, 4)
    data += [("C", CV, "2024-01-01T10:00:00", 1.0), ("D", CV, "2020-01-01T10:00:00", 1.0)]
    data += [("F", CV, "2024-06-29T10:00:00", 1.0), ("E", "Stage", "2024-06-29T10:00:00", 1.0)]
    modes = spark.createDataFrame(
        [("A", 48), ("B", 0), ("C", 24), ("D", 24), ("E", 24), ("F", None), ("G", 24)],
        "site string, mode int",
    )
    obs = observations(data)
    held = obs.select("site").distinct()
    table = reports.weekly_missing_report(modes, obs, held, AS_OF)
    return {r.site: tuple(r)[1:] for r in table.collect()}


def test_weekly_statuses(report):
    closing = ts("2024-07-01T00:00:00")
    assert report == {
        "A": (48, 50.0, None, closing),
        "B": (0, None, "Mode equals 0!", closing),
        "C": (24, None, "No data in last week", ts("2024-01-01T10:00:00")),
        "D": (24, None, "Value error", None),
        "E": (24, None, "Value error", None),
        "F": (None, None, "No data in last week", ts("2024-06-29T10:00:00")),
        "G": (24, None, "Key error", None),
    }

import datetime as dt
import random
import statistics

import pytest

from meterqa.operators import lagged, series, summaries, volumes
from meterqa.plans import reports
from tests.conftest import rows, ts


def registers(n, seed=3, site="S", measurement="Water Meter"):
    """A register read at odd times over some weeks, with pauses and a reset."""
    rng = random.Random(seed)
    when, value, out = ts("2024-01-01T00:00:00"), 1000.0, []
    for i in range(n):
        value = 0.0 if i == n // 2 else value + rng.randint(0, 50)
        out.append((site, measurement, when, value))
        when += dt.timedelta(minutes=rng.choice([7, 61, 600, 3000]), microseconds=i)
    return out


@pytest.mark.parametrize("grain", ["day", "hour", "minute"])
def test_previous_reading_equals_plain_lag(observations, grain):
    data = registers(150) + registers(120, 5, "T")
    got = lagged.previous_reading(observations(data), ["site", "measurement"], grain=grain)
    seen = {(r.site, r.date_time): (r.prev_value, r.prev_time) for r in got.collect()}
    assert len(seen) == len(data)
    last = {}
    for site, _, when, value in data:
        assert seen[site, when] == last.get(site, (None, None))
        last[site] = (value, when)


def test_equal_times_follow_the_value(observations):
    data = [("S", "Flow", "2024-01-01T23:00:00", v) for v in (3.0, 1.0, 2.0)]
    data += [("S", "Flow", "2024-01-02T01:00:00", v) for v in (9.0, 8.0)]
    got = lagged.previous_reading(
        observations(data), ["site", "measurement"], unique_times=False
    )
    pairs = rows(got.select("date_time", "value", "prev_value"), "date_time", "value")
    assert [p[1:] for p in pairs] == [(1.0, None), (2.0, 1.0), (3.0, 2.0), (8.0, 3.0), (9.0, 8.0)]


def test_null_values_are_readings_too(observations):
    data = [("S", "Water Meter", f"2024-01-0{d}T00:00:00", v) for d, v in ((1, 5.0), (2, None), (3, 9.0))]
    got = lagged.previous_reading(observations(data), ["site", "measurement"])
    assert rows(got.select("value", "prev_value"), "date_time") == [
        (5.0, None),
        (None, 5.0),
        (9.0, None),
    ]


def two_series(observations, catalog):
    obs = observations(
        [
            ("S", "Volume", "2024-01-01T06:00:00", 3.0),
            ("S", "Volume", "2024-01-02T06:00:00", 4.0),
            ("S", "Water Meter", "2024-01-02T12:00:00", 100.0),  # still the volume's day
            ("S", "Water Meter", "2024-01-03T06:00:00", 110.0),
            ("S", "Water Meter", "2024-01-03T18:00:00", 125.0),
            ("S", "Water Meter", "2024-01-05T00:00:00", 20.0),  # reset
            ("S", "Water Meter", "2024-01-05T06:00:00", 26.0),
        ]
    )
    cat = catalog(
        [
            ("S", "Volume", "2024-01-01T06:00:00", "2024-01-02T06:00:00"),
            ("S", "Water Meter", "2024-01-02T12:00:00", "2024-01-05T06:00:00"),
        ]
    )
    return obs, series.stitch_plan(series.process_catalog(cat))


@pytest.mark.parametrize("grain", ["day", "hour"])
def test_register_across_a_measurement_change(observations, catalog, grain):
    obs, plan = two_series(observations, catalog)
    got = volumes.register_to_volume(obs, plan, grain=grain)
    assert [r.vol for r in got.orderBy("date_time").collect()] == [
        3.0,
        4.0,
        110.0 - 4.0,  # compared with the volume before it
        15.0,
        20.0 - 125.0,
        6.0,
    ]


def test_register_reset_boundary(observations, catalog):
    obs, _ = two_series(observations, catalog)
    got = volumes.register_to_volume(obs, boundary="reset")
    register = got.filter("measurement = 'Water Meter'").orderBy("date_time")
    assert [r.vol for r in register.collect()] == [None, 10.0, 15.0, -105.0, 6.0]


def test_register_argument_checks(observations, catalog):
    obs, plan = two_series(observations, catalog)
    with pytest.raises(ValueError):
        volumes.register_to_volume(obs)
    with pytest.raises(ValueError):
        volumes.register_to_volume(obs, plan, boundary="other")
    with pytest.raises(ValueError):
        volumes.register_to_volume(obs, plan, grain="week")


def test_negatives_and_nulls_go(observations):
    vols = volumes.plain_volumes(
        observations(
            [("S", "Volume", f"2024-01-0{i}T00:00:00", v) for i, v in ((1, -2.0), (2, None), (3, 0.0), (4, 7.0), (5, -3.0))]
        )
    )
    assert [r.vol for r in volumes.remove_negatives(vols).orderBy("date").collect()] == [0.0, 7.0]
    assert rows(volumes.negatives_by_month(vols)) == [("S", "2024-01", 2, -5.0)]


def spiky(n, spike):
    when = ts("2024-01-01T00:00:00")
    values = [10.0 + (i % 7) for i in range(n)] + [0.0, spike]
    return values, [
        ("S", "Volume", when + dt.timedelta(hours=i), v) for i, v in enumerate(values)
    ]


def test_spike_limits_and_gate(observations):
    values, data = spiky(400, 5000.0)
    vols = volumes.plain_volumes(observations(data))
    params = volumes.spike_params(vols).first()
    positive = [x for x in values if x > 0]
    assert params.mean == pytest.approx(statistics.mean(positive))
    assert params.sd == pytest.approx(statistics.stdev(positive))
    assert (params.kept_rows, params.positive_rows) == (len(values), len(positive))
    flagged = volumes.flag_spikes(vols, volumes.spike_params(vols)).orderBy("date_time").collect()
    for row in flagged:
        for k in (5, 10, 20):
            assert row[f"sd{k}"] == int(row.vol > params.mean + k * params.sd)
    assert flagged[-1].sd5 == 1 and sum(r.sd5 for r in flagged) == 1

    _, few = spiky(98, 5000.0)  # 100 rows: not more than 100
    vols = volumes.plain_volumes(observations(few))
    assert volumes.flag_spikes(vols, volumes.spike_params(vols)).filter("sd5 = 1").isEmpty()


def test_limits_travelling_with_buckets_give_the_same_flags(observations, catalog):
    _, data = spiky(300, 4000.0)
    data += registers(200, site="T")
    cat = catalog(
        [
            ("S", "Volume", "2024-01-01T00:00:00", "2024-03-01T00:00:00"),
            ("T", "Water Meter", "2024-01-01T00:00:00", "2025-03-01T00:00:00"),
        ]
    )
    obs = observations(data)
    plan = series.stitch_plan(series.process_catalog(cat))
    vols = volumes.register_to_volume(obs, plan)
    columns = ["site", "date_time", "vol", "sd5", "sd10", "sd20"]
    direct = volumes.flag_spikes(vols, volumes.spike_params(vols)).select(*columns)
    assert rows(direct, "site", "date_time") == rows(
        reports.flagged_volumes(obs, plan).select(*columns), "site", "date_time"
    )


def test_product_rule(observations):
    _, data = spiky(400, 5000.0)
    vols = volumes.plain_volumes(observations(data))
    params = volumes.spike_params(vols)
    p = params.first()
    flagged = volumes.flag_spikes(vols, params, rule="product")
    assert flagged.agg({"sd5": "sum"}).first()[0] == int(5000.0 > p.mean * p.sd * 5)
    with pytest.raises(ValueError):
        volumes.flag_spikes(vols, params, rule="other")


def test_month_without_extraction_keeps_its_row(observations):
    data = [("S", "Volume", "2024-01-01T00:00:00", 2.0), ("S", "Volume", "2024-02-01T00:00:00", 0.0)]
    vols = volumes.plain_volumes(observations(data))
    flagged = volumes.flag_spikes(vols, volumes.spike_params(vols))
    monthly = summaries.monthly_stats(summaries.daily_stats(summaries.day_rollup(flagged)))
    got = monthly.select(
        "month", "days_with_data", "total_reports", "min_extraction", "mean_extraction", "max_extraction"
    )
    assert rows(got, "month") == [("2024-01", 1, 1, 2.0, 2.0, 2.0), ("2024-02", 1, 1, None, None, None)]

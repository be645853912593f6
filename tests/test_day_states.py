"""Day states against the direct route: differences of all readings, then flags, then day rows."""

import datetime as dt
import random
import re

import pytest
from conftest import final_plan, rows

from meterqa.operators import day_states, series, summaries, volumes
from meterqa.plans import reports

KINDS = ["Water Meter", "Compliance Volume", "Volume", "Stage"]


@pytest.fixture(scope="module")
def archive(spark, observations):
    rng = random.Random(8)
    data = []
    for site in range(6):
        for kind in KINDS:
            level = 0.0
            begin = dt.datetime(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 20))
            for i in range(rng.choice([5, 150, 300])):
                begin += dt.timedelta(minutes=rng.choice([60, 240, 1440]))
                step = abs(rng.gauss(20, 6)) * (40 if rng.random() < 0.01 else 1) * (-1 if rng.random() < 0.03 else 1)
                level += step
                value = level if kind == "Water Meter" else step
                data.append((f"S{site}", kind, begin, None if rng.random() < 0.02 else value))
    data += [(None, "Volume", dt.datetime(2024, 1, 5), 3.0), ("S1", "Volume", None, 4.0), ("S1", None, dt.datetime(2024, 1, 5), 4.0)]
    data += [("S9", "Water Meter", dt.datetime(2024, 1, 5), 3.0), ("S8", "Volume", dt.datetime(2024, 1, 5), float("nan"))]
    return observations(data)


@pytest.fixture(scope="module")
def processed(archive):
    from meterqa.sources.tables import measurement_catalog

    return series.process_catalog(measurement_catalog(archive))


def shown(df):
    columns = ["site", "measurement", "date", *[c for c in day_states.STATE if c != "squares"], "sd5", "sd10", "sd20"]
    table = [tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows(df.select(*columns))]
    return sorted(r for r in table if r[3] or r[5])


@pytest.mark.parametrize("grain", ["day", "hour"])
@pytest.mark.parametrize("rule", ["sum", "product"])
def test_stitched_days(archive, processed, grain, rule):
    plan = series.stitch_plan(processed)
    want = summaries.day_rollup(reports.flagged_volumes(archive, plan, grain, rule))
    got = day_states.flagged_days(archive, plan, grain=grain, rule=rule)
    assert shown(got) == shown(want)
    if rule == "sum":
        assert sum(r[-3] for r in shown(got)) > 0


@pytest.mark.parametrize("grain", ["day", "hour"])
def test_each_series_by_itself(archive, processed, grain):
    plan, whole = series.stitch_plan(processed), series.whole_extent_plan(processed)
    params = volumes.spike_params(volumes.register_to_volume(archive, plan, grain=grain))
    limits = volumes.spike_limits(params, gate="positive_rows")
    vols = volumes.register_to_volume(archive, whole, "reset", grain, per_site=limits)
    want = summaries.day_rollup(volumes.mark_spikes(vols))
    got = day_states.flagged_days(archive, plan, whole, grain, gate="positive_rows")
    assert shown(got) == shown(want)


def test_params_merge_without_cancelling(spark):
    """Large values with a small deviation, over many days."""
    rng = random.Random(2)
    data = [("A", "Volume", dt.date(2024, 1, 1) + dt.timedelta(days=i % 40), 1e9 + rng.random()) for i in range(2000)]
    data += [("B", "Volume", dt.date(2024, 1, 1), 5.0), ("C", "Volume", dt.date(2024, 1, 1), -5.0), ("D", "Volume", dt.date(2024, 1, 1), 0.0)]
    vols = spark.createDataFrame(data, "site string, measurement string, date date, vol double")
    states = vols.groupBy("site", "measurement", "date").agg(*day_states.state_columns())
    got = {r["site"]: r for r in day_states.merged_params(states).collect()}
    want = {r["site"]: r for r in volumes.spike_params(vols).collect()}
    assert set(got) == set(want) == {"A", "B", "D"}
    for site, r in want.items():
        assert (got[site]["kept_rows"], got[site]["positive_rows"]) == (r["kept_rows"], r["positive_rows"])
        for name in ("mean", "sd"):
            assert got[site][name] == pytest.approx(r[name], rel=1e-6, nan_ok=True) if r[name] is not None else got[site][name] is None


def test_unknown_rule(archive, processed):
    with pytest.raises(ValueError, match="unknown rule"):
        day_states.flagged_days(archive, series.stitch_plan(processed), rule="median")


def test_only_registers_are_sorted_by_time(spark, archive, processed):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        plan = final_plan(day_states.flagged_days(archive, series.stitch_plan(processed)))
    finally:
        for k in keys:
            spark.conf.unset(k)
    lines = plan.splitlines()
    depth = [len(re.match(r"[ :|+*-]*", line).group()) for line in lines]
    timed = [i for i, line in enumerate(lines) if re.search(r"Sort \[.*date_time#\d+ ASC", line)]
    assert len(timed) == 2  # registers, and the days of the recount
    below = []
    for i in timed:
        end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
        below.append("\n".join(lines[i:end]))
    assert any("measurement" in b and "= Water Meter)" in b and "max_by" not in b for b in below)
    # Day rows are shuffled by site once: the days without a recount and those with one share them.
    assert "ReusedExchange" in plan
    aggregates = [line for line in lines if "HashAggregate" in line and "partial_max_by" in line]
    assert aggregates and all("partial_var_pop" in line for line in aggregates)

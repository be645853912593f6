import datetime as dt
import random
import re

import pytest

from meterqa import jobs
from meterqa.operators import accounts, day_states, series, volumes
from meterqa.plans import reports
from meterqa.sources import layout
from meterqa.sources.tables import measurement_catalog
from tests.conftest import final_plan, rows

BEGIN = dt.datetime(2024, 1, 1)
KINDS = ("Compliance Volume", "Water Meter", "Volume", "Stage")


def some_readings(rng, n):
    """Series of several kinds that overlap, with gaps in values."""
    data = set()
    for _ in range(n):
        site, kind = rng.choice("AAAB"), rng.randrange(4)
        at = BEGIN + dt.timedelta(days=kind * 25 % 75 + rng.randrange(50), hours=rng.randrange(24))
        data.add((site, KINDS[kind], at))
    return [(*k, None if rng.random() < 0.1 else rng.randint(-10, 400) / 4) for k in sorted(data)]


@pytest.fixture(scope="module")
def readings(observations):
    return observations(some_readings(random.Random(11), 3000))


def stitched(readings):
    return series.stitch_plan(series.process_catalog(measurement_catalog(readings)))


def test_every_reading_is_accounted_for(spark, observations):
    data = some_readings(random.Random(12), 900) + [(None, "Volume", BEGIN, 1.0), ("A", None, BEGIN, 1.0), ("A", "Volume", None, 2.0)]
    obs = observations(data)
    plan = stitched(obs.filter("site is not null and measurement is not null"))
    days = day_states.flagged_days(obs, plan)
    found = accounts.reading_accounts(obs, plan, days)
    accounts.require_balance(found)
    got = {(r.site, r.measurement): r for r in found.collect()}
    for k in {d[:2] for d in data}:
        assert got[k].readings == sum(d[:2] == k for d in data)
    vols = volumes.register_to_volume(obs, plan).selectExpr("site", "measurement", "value", "vol").collect()
    for k, r in got.items():
        mine = [x for x in vols if (x.site, x.measurement) == k]
        assert r.planned == len(mine) and r.no_value == sum(x.value is None for x in mine)
        assert r.kept == sum(x.vol is not None and x.vol >= 0 for x in mine)
        assert r.no_volume == sum(x.value is not None and x.vol is None for x in mine)


@pytest.mark.parametrize("lost", ["measurement = 'Volume' and dayofmonth(date) = 20", "site = 'B'"])
def test_lost_days_are_found(readings, lost):
    plan = stitched(readings)
    days = day_states.flagged_days(readings, plan)
    assert days.filter(lost).count()
    with pytest.raises(accounts.ReadingsLost, match="does not account"):
        accounts.require_balance(accounts.reading_accounts(readings, plan, days.filter(f"not ({lost})")))
    twice = days.unionByName(days.filter(lost))
    with pytest.raises(accounts.ReadingsLost):
        accounts.require_balance(accounts.reading_accounts(readings, plan, twice))


def test_job_fails_where_readings_are_lost(spark, readings, tmp_path, monkeypatch):
    readings.write.parquet(str(tmp_path / "obs"))

    def run(to):
        args = ["time-series", "--observations", str(tmp_path / "obs"), "--export", "s", "--accounts", str(tmp_path / f"{to}-accounts")]
        jobs.main(["--master", "local[8]", *args, "--out", str(tmp_path / to)])

    run("whole")
    written = accounts.read_accounts(spark, str(tmp_path / "whole-accounts"))
    assert written.agg({"readings": "sum"}).first()[0] == readings.count()
    whole = reports.stitched_days
    monkeypatch.setattr(reports, "stitched_days", lambda *a, **k: whole(*a, **k).filter("dayofmonth(date) != 9"))
    with pytest.raises(accounts.ReadingsLost):
        run("part")
    assert not (tmp_path / "part" / "statistics").exists()


@pytest.fixture(scope="module")
def laid_out(spark, readings, tmp_path_factory):
    layout.lay_out(readings, "laid_out_for_tests", str(tmp_path_factory.mktemp("layout") / "t"), 4)
    yield "laid_out_for_tests"
    spark.sql("drop table laid_out_for_tests")


def test_volumes_of_a_laid_out_archive(spark, readings, laid_out):
    plan = stitched(readings)
    columns = ["site", "measurement", "date_time", "value", "segment_no", "vol"]
    got = layout.laid_out_volumes(spark, laid_out, plan).select(*columns)
    want = volumes.register_to_volume(readings, plan).select(*columns)
    assert rows(got, *columns[:3]) == rows(want, *columns[:3]) and got.count() > 1000


def test_readings_of_a_laid_out_archive_are_not_shuffled(spark, readings, laid_out):
    processed = series.process_catalog(measurement_catalog(readings), "2024-02-03", "2024-02-20")
    plan = series.stitch_plan(processed)
    text = final_plan(layout.laid_out_volumes(spark, laid_out, plan))
    lines = text.splitlines()
    assert "dynamicpruning" in text
    scans = [i for i, line in enumerate(lines) if "FileScan parquet" in line and "date_time" in line]
    assert scans and any("Bucketed: true" in lines[i] for i in scans)
    for i in scans:
        depth = len(lines[i]) - len(lines[i].lstrip(" :+-"))
        for line in reversed(lines[:i]):
            own = len(line) - len(line.lstrip(" :+-"))
            if own < depth:
                depth = own
                if re.search(r"Window \[lag\(value|HashAggregate|SortAggregate|ObjectHashAggregate", line):
                    break
                assert "Exchange" not in line
    months = layout.planned_readings(spark, laid_out, plan)
    assert {r.month for r in months.select("month").distinct().collect()} == {dt.date(2024, 2, 1)}

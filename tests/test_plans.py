"""What the physical plans must and must not contain."""

import re

import pytest

from checks import views as v
from checks.cases import QUERIES
from meterqa.operators import meters, volumes
from meterqa.plans import reports
from meterqa.session import shuffle_partitions_for
from meterqa.sources import tables
from tests.conftest import final_plan

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def no_broadcast(spark):
    """Plans as they are when no side is small enough to broadcast."""
    keys = (
        "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.autoBroadcastJoinThreshold",
    )
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k in keys:
        spark.conf.unset(k)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("plans"))
    v.readings(spark, SF).write.parquet(f"{folder}/obs")
    v.catalog(spark, SF).write.parquet(f"{folder}/cat")
    return spark.read.parquet(f"{folder}/obs"), spark.read.parquet(f"{folder}/cat")


def test_no_query_uses_python_or_a_cross_join(spark):
    for name, query in QUERIES.items():
        plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Python|Cartesian|BroadcastNestedLoop", plan), name


def formatted(df):
    utils = df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils
    return utils.explainString(df._jdf.queryExecution(), "formatted")


def test_range_scan_reaches_parquet(stored):
    obs, _ = stored
    df = tables.observations_range(
        obs, ["BU01/0001-M1"], ["Volume"], "2024-01-05", "2024-01-15"
    ).select("site", "value")
    pushed = re.search(r"PushedFilters: \[(.*)\]", formatted(df)).group(1)
    for part in (
        "EqualTo(site,BU01/0001-M1)",
        "EqualTo(measurement,Volume)",
        "GreaterThanOrEqual(date_time,2024-01-05T00:00)",
        "LessThanOrEqual(date_time,2024-01-15T00:00)",
    ):
        assert part in pushed


def test_date_window_of_a_series_reaches_parquet(stored):
    obs, cat = stored
    plan = formatted(reports.stitched_volumes(obs, cat, None, "2024-01-05", "2024-01-22"))
    ranges = re.findall(r"GreaterThanOrEqual\(date_time,2024-01-05T00:00\)", plan)
    assert len(ranges) == 2  # bucket ends and readings
    assert "LessThan(date_time,2024-01-23T00:00)" in plan


def test_monthly_pack_shuffles_registers_once(no_broadcast, stored):
    obs, cat = stored
    plan = final_plan(reports.monthly_pack(obs, cat)["monthly_statistics"])
    by_bucket = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "REPARTITION_BY_COL" in line]
    assert len(by_bucket) == 1
    # Bucket ends with day states, and registers; no day may hold spikes here, so no recount is run.
    scans = re.findall(r"FileScan parquet \[site#\d+,measurement#\d+,date_time#\d+,value#\d+\]", plan)
    assert len(scans) == 2
    assert "EqualTo(measurement,Water Meter)" in formatted(reports.monthly_pack(obs, cat)["monthly_statistics"])


def test_hot_site_is_split_by_day(no_broadcast, stored):
    obs, cat = stored
    requested = cat.select("site").distinct()
    plan = final_plan(reports.quality_combined(obs, cat, requested))
    for line in plan.splitlines():
        if "Window [lag(value" in line:
            assert re.search(r"windowspecdefinition\(site#\d+, (measurement#\d+, )?date#\d+, date_time", line)
    assert re.search(r"hashpartitioning\(site#\d+, date#\d+, \d+\), REPARTITION_BY_COL", plan)


def test_requested_sites_filter_the_scan(no_broadcast, stored):
    """Of the readings, about those of the requested sites enter the exchange."""
    obs, cat = stored
    spark, key = no_broadcast, "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "0")
    try:
        sites = cat.select("site").filter("site < 'BU02'").distinct()
        kept = tables.for_keys(obs, "site", sites)
        plan = final_plan(kept)
        found = kept.collect()
    finally:
        spark.conf.set(key, before)
    lines = plan.splitlines()
    filtered = next(i for i, line in enumerate(lines) if "might_contain" in line)
    assert any(re.search(r"Exchange hashpartitioning\(site#\d+, \d+\)", line) for line in lines[:filtered])
    assert "Generate" not in plan
    assert 0 < len(found) == obs.join(sites, "site", "left_semi").count() < obs.count() / 3


def test_modes_read_the_archive_once(spark):
    plan = final_plan(reports.reporting_modes(v.mode_readings(spark, SF), v.MODES_AS_OF))
    assert plan.count("FileScan") == 1


def test_first_permit_is_limited_before_the_shuffle(spark):
    plan = final_plan(meters.first_consent_per_site(v.consents(spark, SF)))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_daily_aggregates_are_combined_before_the_shuffle(spark):
    plan = final_plan(volumes.spike_params(volumes.plain_volumes(v.long_series(spark, SF))))
    assert "partial_stddev_samp" in plan
    assert re.search(r"HashAggregate\(keys=\[site", plan)


def test_shuffle_partitions_follow_the_input():
    assert shuffle_partitions_for(0, 8) == 8
    assert shuffle_partitions_for(100 * 10**12) > 700_000

import datetime as dt

import pytest

from meterqa import schema
from meterqa.operators import warehouse
from meterqa.plans import reports
from tests.conftest import rows, ts

D = dt.date


@pytest.fixture(scope="module")
def readings(spark):
    def row(site, attribute, source, when, value):
        return (site, attribute, None, None, source, value, ts(when))

    return spark.createDataFrame(
        [
            row("S", "Water Meter", "tel", "2024-01-01T23:45:00", 100.0),
            row("S", "Water Meter", "tel", "2024-01-02T00:00:00", 104.0),
            row("S", "Water Meter", "tel", "2024-01-02T00:15:00", 102.0),  # runs backwards
            row("S", "Water Meter", "tel", "2024-01-02T00:30:00", 103.0),
            row("S", "Water Meter", "man", "2024-01-02T12:00:00", 500.0),
            row("S", "Volume", "man", "2024-01-02T13:00:00", 7.5),
            row("S", "Flow", "man", "2024-01-02T13:00:00", 3.0),
            row("S", "Flow", "man", "2024-01-02T13:10:00", 3.0),
            row("S", "Average Flow", "tel", "2024-01-03T13:00:00", 9.0),
            row("S", "Average Flow", "tel", "2024-01-03T13:50:00", 9.0),  # same hour
            row("S", "Average Flow", "tel", "2024-01-03T15:01:00", 9.0),
            row("T", "Volume", "tel", "2024-01-02T13:00:00", 1.0),
        ],
        schema.WAREHOUSE,
    )


@pytest.mark.parametrize("grain", ["day", "hour"])
def test_daily_abstraction(readings, grain):
    table = reports.warehouse_daily(readings, ["S"], grain=grain).select(
        "site_id", "date", "data_source", "daily_measured_value",
        "duplicate_days", "max_value", "min_value", "difference",
    )
    # the man-made flow: 3 * 1000 / 600 s = 5, with the volume 12.5
    assert rows(table, "date", "data_source") == [
        ("S", D(2024, 1, 2), "man", 12.5, 2, 12.5, 5.0, 7.5),
        ("S", D(2024, 1, 2), "tel", 5.0, 2, 12.5, 5.0, 7.5),
        ("S", D(2024, 1, 3), "tel", 4.5, 1, 4.5, 4.5, 0.0),
    ]


def test_physical_rule(readings):
    measured = warehouse.with_measured_value(warehouse.with_previous(readings), "physical")
    flows = measured.filter("attribute_name in ('Flow', 'Average Flow')")
    got = flows.select("attribute_name", "measured_value")
    assert rows(got, "attribute_name", "observation_date_time") == [
        ("Average Flow", None),
        ("Average Flow", 0.0),
        ("Average Flow", 18.0),
        ("Flow", None),
        ("Flow", 1.8),
    ]


def test_null_source_and_attribute_are_series_too(spark):
    at = [dt.datetime(2024, 1, 1, h) for h in range(4)]
    table = spark.createDataFrame(
        [
            ("A", "Volume", None, 1.0, at[0]),
            ("A", "Volume", None, 2.0, at[1]),
            ("A", "Volume", "S1", 4.0, at[2]),
            ("A", None, "S1", 8.0, at[3]),
        ],
        "site_id string, attribute_name string, data_source string, observation_value double, observation_date_time timestamp_ntz",
    )
    got = reports.warehouse_daily(table).collect()
    assert {(r.data_source, r.daily_measured_value, r.duplicate_days) for r in got} == {(None, 3.0, 2), ("S1", 12.0, 2)}


def test_nan_values_are_missing(spark):
    at = [dt.datetime(2024, 1, 1, h) for h in range(3)]
    table = spark.createDataFrame(
        [("A", "Volume", "S1", v, t) for v, t in zip((1.0, float("nan"), 2.0), at, strict=True)],
        "site_id string, attribute_name string, data_source string, observation_value double, observation_date_time timestamp_ntz",
    )
    assert [r.daily_measured_value for r in reports.warehouse_daily(table).collect()] == [3.0]

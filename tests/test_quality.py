import datetime as dt

import pytest

from meterqa.plans import reports
from tests.conftest import rows, ts

D = dt.date


@pytest.fixture(scope="module")
def archive(observations, catalog):
    hours = [ts("2024-01-01T00:00:00") + dt.timedelta(hours=i) for i in range(240)]
    data = [("A", "Compliance Volume", t, 10.0 + i % 5) for i, t in enumerate(hours[:120])]
    data += [("A", "Volume", t, 20.0 + i % 5) for i, t in enumerate(hours[60:])]
    data += [("A", "Volume", hours[239] + dt.timedelta(minutes=30), 9000.0)]
    data += [("A", "Compliance Volume", hours[5] + dt.timedelta(minutes=1), -4.0)]
    data += [("B", "Stage", hours[0], 1.0)]
    data += [("C", "Volume", hours[0], -1.0)]
    obs = observations(data)
    cat = catalog(
        [
            ("A", "Compliance Volume", hours[0], hours[119]),
            ("A", "Volume", hours[60], hours[239] + dt.timedelta(minutes=30)),
            ("B", "Stage", hours[0], hours[0]),
            ("C", "Volume", hours[0], hours[0]),
        ]
    )
    return obs, cat


def asked(spark, *sites):
    return spark.createDataFrame([(s,) for s in sites], "site string")


COLUMNS = [
    "site", "in_archive", "meas_types", "meas_used", "start_date", "end_date", "total_days",
    "days_with_data", "total_reports", "min_extraction", "max_extraction", "negative_values",
    "spikes_sd5", "spikes_sd20",
]


@pytest.mark.parametrize("grain", ["day", "hour"])
def test_combined(spark, archive, grain):
    table = reports.quality_combined(*archive, asked(spark, "A", "B", "C", "X"), grain=grain)
    assert rows(table.select(*COLUMNS), "site") == [
        # the first series to the 5th, the second from the 6th
        ("A", "Y", 2, 2, D(2024, 1, 1), D(2024, 1, 10), 10, 10, 241, 10.0, 9000.0, 1, 1, 0),
        ("B", "Y", 0, *[None] * 11),
        ("C", "Y", 1, 0, None, None, None, 0, 0, None, None, 1, 0, 0),
        ("X", "N", *[None] * 12),
    ]


def test_by_measurement(spark, archive):
    table = reports.quality_by_measurement(*archive, asked(spark, "A", "X"))
    columns = ["measurement", *[c for c in COLUMNS if not c.startswith("meas_")]]
    assert rows(table.select(*columns), "site", "measurement") == [
        ("Compliance Volume", "A", "Y", D(2024, 1, 1), D(2024, 1, 5), 5, 5, 120, 10.0, 14.0, 1, 0, 0),
        ("Volume", "A", "Y", D(2024, 1, 3), D(2024, 1, 10), 8, 8, 181, 20.0, 9000.0, 0, 1, 0),
        (None, "X", "N", *[None] * 10),
    ]


def test_one_site_is_the_list_filtered(spark, archive):
    whole = reports.quality_combined(*archive, asked(spark, "A", "C")).filter("site = 'A'")
    alone = reports.quality_combined(*archive, asked(spark, "A"))
    assert rows(whole) == rows(alone)
    obs, cat = archive
    for name, table in reports.monthly_pack(obs, cat, ["A"]).items():
        full = reports.monthly_pack(obs, cat)[name].filter("site = 'A'")
        assert rows(table, *table.columns[:2]) == rows(full, *full.columns[:2])


def test_monthly_window(archive):
    obs, cat = archive
    pack = reports.monthly_pack(obs, cat, ["A"], "2024-01-04", "2024-01-08")
    got = pack["monthly_statistics"].select("month", "days_with_data", "total_reports", "meas_type")
    assert rows(got) == [("2024-01", 5, 120, "Volume")]
    assert pack["negatives_removed"].isEmpty()


def test_daily_sums_keep_the_raw_total(archive):
    obs, cat = archive
    vols = reports.stitched_volumes(obs, cat, ["A"])
    raw = vols.filter("vol >= 0").agg({"vol": "sum"}).first()[0]
    series = reports.daily_series(vols).agg({"volume": "sum"}).first()[0]
    assert series == pytest.approx(raw)
    days = reports.stitched_days(obs, cat, ["A"])
    by_days = rows(reports.daily_series(days).select("date", "readings", "volume"), "date")
    assert by_days == rows(reports.daily_series(vols).select("date", "readings", "volume"), "date")

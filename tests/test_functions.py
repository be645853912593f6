import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterqa.functions import calendar as cal
from meterqa.functions import names, rounding, units
from tests.conftest import ts

D = dt.date


def test_round_half_even_equals_numpy(spark):
    rng = np.random.default_rng(7)
    values = [0.5, 1.5, 2.5, -0.5, 0.25, 0.35, 1.005, 2.675, 12.345, -2.5, 0.0]
    values += [float(x) for x in np.round(rng.uniform(-1000, 1000, 2000), 4)]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    for places in (1, 2, 3):
        got = [r[0] for r in df.select(rounding.round_half_even(F.col("x"), places)).collect()]
        assert got == [float(np.round(x, places)) for x in values]


def test_truncate_goes_toward_zero(spark):
    df = spark.createDataFrame([(2.9,), (-2.9,), (0.0,)], "x double")
    assert [r[0] for r in df.select(rounding.truncate(F.col("x"))).collect()] == [2, -2, 0]


def test_water_year_start(spark):
    days = [D(2019, 6, 30), D(2019, 7, 1), D(2020, 1, 1), D(2020, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(cal.water_year_start(F.col("d"))).collect()]
    assert got == [D(2018, 7, 1), D(2019, 7, 1), D(2019, 7, 1), D(2020, 7, 1)]


def test_labels(spark):
    df = spark.createDataFrame([(ts("2024-01-09T23:59:59"),)], "t timestamp_ntz")
    t = F.col("t")
    got = df.select(
        cal.month_label(t), cal.month_day_label(t), cal.year_month_day_label(t), cal.padded_day(t)
    ).first()
    assert tuple(got) == ("2024-01", "1/9", "2024/1/9", "09")


def test_boundaries_count_marks_not_elapsed_time(spark):
    pairs = [
        ("2024-01-01T10:59:59.900000", "2024-01-01T11:00:00.100000"),
        ("2024-01-01T10:00:00", "2024-01-01T10:59:59"),
        ("2023-12-31T23:30:00", "2024-01-01T01:10:00"),
    ]
    df = spark.createDataFrame([(ts(a), ts(b)) for a, b in pairs], "a timestamp_ntz, b timestamp_ntz")
    a, b = F.col("a"), F.col("b")
    got = [tuple(r) for r in df.select(cal.second_boundaries(a, b), cal.hour_boundaries(a, b)).collect()]
    assert got == [(1, 1), (3599, 0), (6000, 2)]


def test_is_midnight_sees_fractions(spark):
    df = spark.createDataFrame(
        [(ts("2024-01-01T00:00:00"),), (ts("2024-01-01T00:00:00.000001"),)], "t timestamp_ntz"
    )
    assert [r[0] for r in df.select(cal.is_midnight(F.col("t"))).collect()] == [True, False]


def test_parse_day():
    assert cal.parse_day("2024-02-29") == D(2024, 2, 29)
    for bad in ("29/02/2024", "2023-02-29", "today"):
        with pytest.raises(ValueError):
            cal.parse_day(bad)


def test_names(spark):
    sites = ["BU24/0011-M1", "bu24/0011-m1", "BU24/0011-M1,BU24/0012-M1", "X-4"]
    df = spark.createDataFrame([(s,) for s in sites], "s string")
    s = F.col("s")
    got = [
        tuple(r)
        for r in df.select(
            names.external_site(s),
            names.site_id_from_name(s),
            names.file_safe(s),
            names.is_composite(s),
            names.looks_like_site_id(s),
        ).collect()
    ]
    assert got == [
        ("BU24/0011", "BU24/0011", "BU24-0011-M1", False, True),
        ("bu24/0011", "BU24/0011", "bu24-0011-m1", False, False),
        ("BU24/0011", "BU24/0011", "BU24-0011-M1,BU24-0012-M1", True, True),
        ("X", None, "X-4", False, False),
    ]


def test_measured_volume_rules(spark):
    df = spark.createDataFrame(
        [
            ("Water Meter", 10.0, 4.0, ts("2024-01-01T00:00:00"), ts("2024-01-01T02:00:00")),
            ("Flow", 7.2, 1.0, ts("2024-01-01T00:00:00"), ts("2024-01-01T02:00:00")),
            ("Average Flow", 7.0, 1.0, ts("2024-01-01T00:00:00"), ts("2024-01-01T02:00:00")),
            ("Average Flow", 7.0, 1.0, ts("2024-01-01T00:00:00"), ts("2024-01-01T00:30:00")),
            ("Volume", 3.0, None, None, ts("2024-01-01T02:00:00")),
        ],
        "a string, v double, pv double, pt timestamp_ntz, t timestamp_ntz",
    )

    def run(rule):
        args = [F.col(c) for c in ("a", "v", "pv", "pt", "t")]
        return [r[0] for r in df.select(units.measured_volume(*args, rule)).collect()]

    assert run("as_published") == [6.0, 1.0, 3.5, None, 3.0]
    assert run("physical") == [6.0, 51.84, 14.0, 0.0, 3.0]
    with pytest.raises(ValueError):
        run("other")

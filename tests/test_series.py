import datetime as dt
import random

from pyspark.sql import functions as F

from meterqa.operators import series
from tests.conftest import rows, ts

D = dt.date


def test_stitching_example(catalog):
    cat = catalog(
        [
            ("BX01/0001-M1", "Volume", "2015-07-01T00:00:00", "2019-06-30T00:00:00"),
            ("BX01/0001-M1", "Compliance Volume", "2012-07-01T00:00:00", "2016-05-08T00:00:00"),
        ]
    )
    plan = series.stitch_plan(series.process_catalog(cat))
    assert rows(plan.drop("site"), "segment_no") == [
        ("Compliance Volume", 1, D(2012, 7, 1), D(2016, 5, 8), True),
        ("Volume", 2, D(2016, 5, 9), D(2019, 6, 30), True),
    ]


def loop_plan(segments):
    """Brute force: walk the segments and move the free day forward."""
    taken, free = [], segments[0][1]
    for name, _, end in segments:
        if free <= end:
            taken.append((name, free, end))
            free = end + dt.timedelta(days=1)
    return taken


def test_plan_equals_loop(catalog):
    rng = random.Random(11)
    table, expected = [], {}
    for i in range(300):
        segments = []
        for m in series.ACCEPTED_MEASUREMENTS[: rng.randint(1, 5)]:
            start = D(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 60))
            end = start + dt.timedelta(days=rng.randint(0, 60))
            segments.append((m, start, end))
        segments.sort(key=lambda s: (s[1], s[0]))
        expected[f"S{i}"] = loop_plan(segments)
        midnight = dt.time()
        table += [
            (f"S{i}", m, dt.datetime.combine(a, midnight), dt.datetime.combine(b, midnight))
            for m, a, b in segments
        ]
    plan = series.stitch_plan(series.process_catalog(catalog(table))).filter("taken")
    got = {}
    for r in plan.orderBy("site", "segment_no").collect():
        got.setdefault(r.site, []).append((r.measurement, r.start_date, r.end_date))
    assert got == expected


def test_clip_to_window(catalog):
    cat = catalog(
        [
            ("S", "Volume", "2018-01-01T05:00:00", "2018-07-01T00:00:00"),  # ends at the start
            ("S", "Compliance Volume", None, "2018-07-01T10:00:00"),
            ("S", "Volume [Flow]", "2019-01-01T10:00:00", "2020-01-01T00:00:00"),
            ("S", "Water Meter", "2019-06-30T10:00:00", "2020-01-01T00:00:00"),  # starts at the end
            ("S", "Volume [Average Flow]", "2019-01-01T00:00:00", None),  # no end
            ("S", "Stage", "2018-01-01T00:00:00", "2020-01-01T00:00:00"),
        ]
    )
    got = series.process_catalog(cat, "2018-07-01", "2019-06-30")
    assert rows(got.select("measurement", "from_ts", "from_date", "to_date"), "measurement") == [
        ("Compliance Volume", ts("2000-01-01"), D(2018, 7, 1), D(2018, 7, 1)),
        ("Volume [Flow]", ts("2019-01-01T10:00:00"), D(2019, 1, 1), D(2019, 6, 30)),
    ]


def test_each_day_belongs_to_one_series(observations, catalog):
    cat = catalog(
        [
            ("S", "Compliance Volume", "2024-01-01T00:00:00", "2024-01-03T12:00:00"),
            ("S", "Volume", "2024-01-02T00:00:00", "2024-01-05T00:00:00"),
            ("S", "Volume [Flow]", "2024-01-02T00:00:00", "2024-01-03T00:00:00"),
        ]
    )
    obs = observations(
        [
            ("S", m, f"2024-01-0{d}T06:00:00", float(d))
            for m in ("Compliance Volume", "Volume", "Volume [Flow]", "Stage")
            for d in range(1, 6)
        ]
    )
    plan = series.stitch_plan(series.process_catalog(cat))
    kept = series.in_segments(obs, plan, F.to_date("date_time"))
    assert rows(kept.select("value", "measurement"), "value") == [
        (1.0, "Compliance Volume"),
        (2.0, "Compliance Volume"),
        (3.0, "Compliance Volume"),
        (4.0, "Volume"),
        (5.0, "Volume"),
    ]


def test_known_and_unknown_sites(spark):
    asked = spark.createDataFrame([("A",), ("B",)], "site string")
    held = spark.createDataFrame([("B",), ("C",)], "site_name string")
    assert rows(series.known_sites(asked, held)) == [("B",)]
    assert rows(series.unknown_sites(asked, held)) == [("A",)]

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from meterqa import jobs, schema
from meterqa.functions.names import is_composite
from meterqa.sources import files, tables, versions
from tests.conftest import rows, ts
from tests.tables import CONSENTS, EXT_SITES, read_back


def test_site_list_file(spark, tmp_path):
    path = tmp_path / "sites.csv"
    path.write_text("BU24/0001-M1\r\n  BU24/0002-M1\n\nBU24/0003-M1")
    assert rows(files.read_site_list(spark, str(path)), "site") == [
        ("BU24/0001-M1",),
        ("BU24/0002-M1",),
        ("BU24/0003-M1",),
    ]


def test_site_list_keeps_whole_lines(spark, tmp_path):
    path = tmp_path / "sites.csv"
    path.write_text('BU24/0011-M1,BU24/0012-M1\n"BU24/0013-M1,BU24/0014-M1"\n "BU24/0015-M1" \n')
    found = files.read_site_list(spark, str(path))
    assert rows(found, "site") == [
        ("BU24/0011-M1,BU24/0012-M1",),
        ("BU24/0013-M1,BU24/0014-M1",),
        ("BU24/0015-M1",),
    ]
    assert found.filter(~is_composite(F.col("site"))).count() == 1


def test_tables_of_a_site_are_in_order(spark, tmp_path):
    days = spark.range(400).select(
        F.lit("BU24/0001-M1").alias("site"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") * 37 % 100).cast("int")).alias("date"),
        (F.col("id") % 24).cast("int").alias("hour"),
    )
    files.write_by_site(days.repartition(5), str(tmp_path / "t"))
    paths = [str(p) for p in (tmp_path / "t").rglob("*.parquet")]
    found = [[(r.date, r.hour) for r in read_back(spark, p).collect()] for p in paths]
    assert sum(map(len, found)) == 400 and all(x == sorted(x) for x in found)


def test_key_file(spark, tmp_path):
    path = tmp_path / "consents.csv"
    path.write_text("RecordNumber,Note\nCRC1,x\n ,\nWTK69B,y\n")
    keys = files.read_keys(spark, str(path), "RecordNumber", "record_number")
    assert rows(keys, "record_number") == [("CRC1",), ("WTK69B",)]
    with pytest.raises(ValueError):
        files.read_keys(spark, str(path), "ExtSiteID", "ext_site_id")


def test_modes_round_trip(spark, tmp_path):
    modes = spark.createDataFrame(
        [("A", 24, 0.97, "Annual"), ("B", 1, None, "Qtr2")], schema.REPORTING_MODES
    )
    path = files.write_csv(modes, str(tmp_path / "modes"))
    assert rows(files.read_reporting_modes(spark, path), "site") == rows(modes, "site")


def test_tables_by_site(spark, tmp_path):
    table = spark.createDataFrame(
        [("A/1-M1", "Volume [Flow]", 1.0), ("B/2-M1", "Volume", 2.0)],
        "site string, measurement string, v double",
    )
    path = files.write_by_site(table, str(tmp_path / "t"), by_measurement=True)
    assert sorted(d for d in os.listdir(path) if "=" in d) == ["site_file=A-1-M1", "site_file=B-2-M1"]
    back = read_back(spark, path).select(*table.columns)
    assert rows(back, "site") == rows(table, "site")


def test_schema_is_checked(spark):
    with pytest.raises(ValueError, match="date_time"):
        tables.observations_range(spark.createDataFrame([("A",)], "site string"))


@pytest.fixture(scope="module")
def stored(spark, observations, tmp_path_factory):
    folder = tmp_path_factory.mktemp("archive")
    start = ts("2024-01-01T00:00:00")
    data = [
        (f"BU24/000{s}-M1", "Compliance Volume", start + dt.timedelta(hours=i), float(i % 9))
        for s in (1, 2)
        for i in range(24 * 20)
    ]
    observations(data).write.parquet(f"{folder}/obs")
    spark.createDataFrame(
        [
            (
                "CRC1", "Take", None, "BU24/0001", "1/07/2020 0:00", "1/07/2030 0:00", 1, 12,
                1.0, 600.0, 7, None, "stock", None, "Issued - Active", None,
            )
        ],
        CONSENTS,
    ).write.parquet(f"{folder}/consents")
    spark.createDataFrame(
        [("S", "Volume", None, None, "tel", 5.0, start)], schema.WAREHOUSE
    ).write.parquet(f"{folder}/wh")
    spark.createDataFrame([("BU24/0001", 1.0, 2.0, "North")], EXT_SITES).write.parquet(
        f"{folder}/ext"
    )
    (folder / "sites.csv").write_text("BU24/0001-M1\nBU24/0009-M1\n")
    (folder / "ids.csv").write_text("ExtSiteID\nBU24/0001\n")
    (folder / "wh.csv").write_text("S\n")
    return str(folder)


def run(stored, out, job, *args):
    jobs.main([job, *args, "--out", str(out)])
    return str(out)


def test_modes_then_weekly_report(spark, stored, tmp_path):
    obs = ("--observations", f"{stored}/obs")
    modes = run(stored, tmp_path / "modes", "reporting-modes", *obs, "--as-of", "2024-01-20")
    assert [r.mode for r in files.read_reporting_modes(spark, modes).collect()] == [0, 0]
    one = run(
        stored, tmp_path / "one", "reporting-modes", *obs, "--as-of", "2024-01-20", "--slice", "1", "2"
    )
    assert [r.site for r in files.read_reporting_modes(spark, one).collect()] == ["BU24/0002-M1"]
    out = run(
        stored, tmp_path / "week", "weekly-report", *obs, "--modes", modes, "--week-end", "2024-01-14"
    )
    table = spark.read.option("header", True).csv(
        f"{out}/missing_data_report_week_ending_2024-01-14"
    )
    assert {r.status for r in table.collect()} == {"Mode equals 0!"}


def test_quality_job(spark, stored, tmp_path):
    args = ("--observations", f"{stored}/obs", "--sites", f"{stored}/sites.csv")
    for i, extra in enumerate(((), ("--by-measurement",))):
        out = run(stored, tmp_path / str(i), "quality", *args, *extra)
        table = spark.read.option("header", True).csv(out)
        got = rows(table.select("site", "in_archive", "total_reports"), "site")
        assert got == [("BU24/0001-M1", "Y", "480"), ("BU24/0009-M1", "N", None)]


def test_time_series_job(spark, stored, tmp_path):
    out = run(
        stored, tmp_path / "ts", "time-series", "--observations", f"{stored}/obs",
        "--site", "BU24/0001-M1", "--consents", f"{stored}/consents",
        "--from-date", "2024-01-05", "--to-date", "2024-01-14",
    )
    assert sorted(os.listdir(f"{out}/statistics")) == [
        "measurements", "monthly_statistics", "negatives_removed",
    ]
    monthly = read_back(spark, f"{out}/statistics/monthly_statistics")
    assert rows(monthly.select("days_with_data", "total_reports")) == [(10, 240)]
    series = read_back(spark, f"{out}/series")
    assert series.filter("ma is not null").count() == 4
    assert series.first().ref_line == 85.7


def test_statistics_of_several_runs(spark, stored, tmp_path):
    args = ("--observations", f"{stored}/obs", "--site", "BU24/0001-M1", "--export", "s", "--versioned")
    for window in ((), ("--from-date", "2024-01-05", "--to-date", "2024-01-14")):
        out = run(stored, tmp_path / "v", "time-series", *args, *window)
    assert len(os.listdir(f"{out}/statistics/runs")) == 2
    monthly = versions.read_report(spark, f"{out}/statistics", "monthly_statistics")
    assert rows(monthly.select("days_with_data", "total_reports")) == [(10, 240)]


def test_statistics_only_and_unknown_site(stored, tmp_path):
    args = ("--observations", f"{stored}/obs", "--export", "s")
    out = run(stored, tmp_path / "s", "time-series", *args)
    assert sorted(os.listdir(out)) == ["days", "statistics"]
    with pytest.raises(ValueError, match="not in the archive"):
        run(stored, tmp_path / "x", "time-series", *args, "--site", "BU24/0009-M1")


def test_plot_jobs(spark, stored, tmp_path):
    obs = ("--observations", f"{stored}/obs")
    out = run(stored, tmp_path / "p", "recent-plots", *obs, "--as-of", "2024-01-20")
    assert read_back(spark, f"{out}/daily").count() == 2 * 366
    assert read_back(spark, f"{out}/hourly").count() == 2 * (12 + 19 * 24 + 1)
    out = run(stored, tmp_path / "m", "month-plots", *obs, "--start", "2024-01-18")
    assert read_back(spark, out).count() == 2 * (3 * 24 + 33 - 1)


def test_meter_list_job(spark, stored, tmp_path):
    base = ("--observations", f"{stored}/obs", "--consents", f"{stored}/consents")
    for i, choice in enumerate(
        (
            ("--site-ids", f"{stored}/ids.csv"),
            ("--where", "swaz_name=North;South", "--ext-sites", f"{stored}/ext"),
        )
    ):
        out = run(stored, tmp_path / str(i), "meter-list", *base, *choice)
        table = spark.read.option("header", True).csv(out)
        assert rows(table.select("record_number", "site_name")) == [("CRC1", "BU24/0001-M1")]
    with pytest.raises(ValueError):
        run(stored, tmp_path / "none", "meter-list", *base)


def test_meter_list_job_tells_rejects(spark, stored, tmp_path):
    permits = spark.read.parquet(f"{stored}/consents")
    text = permits.withColumn("to_date", F.lit("soon")).withColumn("from_date", F.col("from_date").cast("string"))
    text.write.parquet(str(tmp_path / "permits"))
    run(
        stored, tmp_path / "list", "meter-list", "--observations", f"{stored}/obs", "--consents", str(tmp_path / "permits"),
        "--site-ids", f"{stored}/ids.csv", "--rejects", str(tmp_path / "rejects"),
    )
    found = spark.read.option("header", True).csv(str(tmp_path / "rejects"))
    assert found.columns == ["record_number", "column", "raw", "reason"]
    assert rows(found.select("column", "raw", "reason").distinct()) == [("to_date", "soon", "no date")]
    assert found.count() == permits.count()


def test_warehouse_job(spark, stored, tmp_path):
    out = run(
        stored, tmp_path / "w", "warehouse-daily", "--warehouse", f"{stored}/wh",
        "--sites", f"{stored}/wh.csv",
    )
    table = spark.read.option("header", True).csv(out)
    assert rows(table.select("site_id", "date", "daily_measured_value")) == [("S", "2024-01-01", "5.0")]


def test_deliveries_and_stored_modes(spark, tmp_path, observations):
    """Modes from day rows that two deliveries brought up to date are those of all readings."""
    data = [("BU24/0001-M1", "Compliance Volume", ts(f"2024-03-{d:02d}T{h:02d}:00:00"), 1.0) for d in range(1, 29) for h in (0, 12)]
    data += [("BU24/0002-M1,BU24/0003-M1", "Compliance Volume", ts("2024-03-05T00:00:00"), 1.0)]
    archive, days = str(tmp_path / "archive"), str(tmp_path / "days")
    for no, part in enumerate((data[:40], data[30:])):
        observations(part).write.parquet(str(tmp_path / f"in{no}"))
        jobs.main(["--master", "local[8]", "deliver", "--observations", str(tmp_path / f"in{no}"), "--archive", archive, "--delivery", str(no), "--out", days])
    jobs.main(["--master", "local[8]", "stored-modes", "--days", days, "--as-of", "2024-03-28", "--out", str(tmp_path / "stored")])
    observations(data).write.parquet(str(tmp_path / "all"))
    jobs.main(["--master", "local[8]", "reporting-modes", "--observations", str(tmp_path / "all"), "--as-of", "2024-03-28", "--out", str(tmp_path / "plain")])
    found = [rows(files.read_reporting_modes(spark, str(tmp_path / x)), "site") for x in ("stored", "plain")]
    assert found[0] == found[1] and len(found[0]) == 1

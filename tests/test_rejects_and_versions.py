import pytest
from pyspark.sql import functions as F

from meterqa.sources import files, rejects, versions
from tests.conftest import rows


def test_reasons(spark):
    table = spark.createDataFrame(
        [
            (1, "1.5", "1/07/2019", "BU24/0001-M1"),
            (2, "NaN", "2019-07-01 10:00", "BU24/0001,BU24/0002"),
            (3, "gap", "until further notice", "pump shed"),
            (4, " ", "", ""),
            (5, None, None, None),
            (3, "gap", "31/02/2019", "BU24/0003"),
        ],
        "line int, value string, day string, site string",
    )
    found = rejects.rejected(table, {"value": "number", "day": "date", "site": "site"}, ["line"])
    assert found.columns == ["line", "column", "raw", "reason"]
    assert rows(found, "line", "column", "raw") == [
        (2, "site", "BU24/0001,BU24/0002", "several sites"),
        (2, "value", "NaN", "not a number"),
        (3, "day", "31/02/2019", "no date"),
        (3, "day", "until further notice", "no date"),
        (3, "site", "pump shed", "no site id"),
        (3, "value", "gap", "no number"),
        (3, "value", "gap", "no number"),
        (4, "day", "", "blank"),
        (4, "site", "", "blank"),
        (4, "value", " ", "blank"),
    ]
    assert rejects.rejected(table.limit(0), {"value": "number"}).count() == 0


def test_typed_columns(spark):
    table = spark.sql("SELECT double('NaN') AS value, 3 AS n, DATE '2024-01-01' AS day UNION ALL SELECT 1.0, NULL, NULL")
    found = rejects.rejected(table, {"value": "number", "n": "number", "day": "date"})
    assert rows(found, "column") == [("value", "NaN", "not a number")]


def test_faults_of_the_caller(spark):
    table = spark.createDataFrame([("x", "y")], "raw string, value string")
    with pytest.raises(ValueError, match="raw"):
        rejects.rejected(table, {"value": "number"}, ["raw"])
    with pytest.raises(ValueError, match="colour"):
        rejects.rejected(table, {"value": "colour"})
    with pytest.raises(ValueError, match="missing"):
        rejects.rejected(table, {"amount": "number"})


def test_rejects_need_no_shuffle(spark):
    plan = rejects.rejected(spark.range(9).selectExpr("id", "string(id) v"), {"v": "number"}, ["id"])
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def _sheets(spark, n):
    return {"a": spark.range(n), "b": spark.createDataFrame([("BU24/0001-M1", n)], "site string, n long")}


def test_report_changes_as_a_whole(spark, tmp_path):
    folder = str(tmp_path / "report")
    with pytest.raises(ValueError, match="no report"):
        versions.read_report(spark, folder, "a")
    versions.write_report(_sheets(spark, 3), folder)
    failing = _sheets(spark, 5)
    failing["b"] = failing["b"].withColumn("n", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        versions.write_report(failing, folder)
    assert versions.read_report(spark, folder, "a").count() == 3
    assert rows(versions.read_report(spark, folder, "b"), "site") == [("BU24/0001-M1", 3)]
    old = versions.read_report(spark, folder, "a")
    versions.write_report(_sheets(spark, 5), folder)
    assert versions.read_report(spark, folder, "a").count() == 5
    assert old.count() == 3  # a reader that began before keeps its run
    with pytest.raises(ValueError, match="'c'"):
        versions.read_report(spark, folder, "c")


def test_report_in_folders_by_site(spark, tmp_path):
    folder = str(tmp_path / "report")
    versions.write_report(_sheets(spark, 3) | {"a": _sheets(spark, 4)["b"]}, folder, files.write_by_site)
    back = versions.read_report(spark, folder, "a")
    assert back.columns == ["site", "n"] and rows(back, "site") == [("BU24/0001-M1", 4)]

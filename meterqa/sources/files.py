"""CSV lists that users keep, and the report sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterqa.functions.calendar import parse_day
from meterqa.functions.names import file_safe
from meterqa.schema import REPORTING_MODES


def read_site_list(spark: SparkSession, path: str) -> DataFrame:
    """One site per line, no header; line ends, blanks, quotes around a name and empty lines go.

    A line is one name whole, so a composite name keeps its comma.
    """
    name = F.regexp_replace(F.trim(F.regexp_replace("value", r"[\r\n]+", "")), '^"(.*)"$', "$1")
    return spark.read.text(path).select(F.trim(name).alias("site")).filter(F.col("site") != "")


def read_keys(spark: SparkSession, path: str, header: str, name: str) -> DataFrame:
    """One key column of a CSV with a header, under the library's name."""
    table = spark.read.option("header", True).csv(path)
    if header not in table.columns:
        raise ValueError(f"no column {header!r} in {path}; found {table.columns}")
    return table.select(F.trim(F.col(header)).alias(name)).na.drop().filter(F.col(name) != "")


def read_reporting_modes(spark: SparkSession, path: str) -> DataFrame:
    """Reporting modes written by :func:`write_csv` (columns by header order)."""
    return spark.read.schema(REPORTING_MODES).csv(path, header=True)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def weekly_report_path(folder: str, week_end: str) -> str:
    """The report's name carries the day its week ends."""
    return f"{folder.rstrip('/')}/missing_data_report_week_ending_{parse_day(week_end)}"


def write_by_site(
    df: DataFrame, path: str, by_measurement: bool = False, fmt: str = "parquet"
) -> str:
    """One folder per site (and measurement), names made safe for paths.

    The rebalance hint gathers a site's rows into few files and splits a site
    that is too large for one task. Each file is in order of date and hour.
    """
    parts = ["site_file"] + (["measurement_file"] if by_measurement else [])
    keyed = df.withColumn("site_file", file_safe(F.col("site")))
    if by_measurement:
        keyed = keyed.withColumn("measurement_file", F.col("measurement"))
    order = [c for c in ("month", "date", "hour") if c in df.columns]
    sorted_ = keyed.hint("rebalance", *parts).sortWithinPartitions(*parts, *order)
    writer = sorted_.write.mode("overwrite").partitionBy(*parts)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def write_statistics(sheets: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> list[str]:
    """A statistics workbook as a folder: one table per sheet, one part per site."""
    return [
        write_by_site(df, f"{folder.rstrip('/')}/{name}", fmt=fmt) for name, df in sheets.items()
    ]


"""Daily abstraction from the warehouse table, per data source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterqa.functions.units import measured_volume
from meterqa.operators.lagged import previous_reading
from meterqa.sources.tables import Keys, as_number, for_keys

SERIES = ["site_id", "attribute_name", "data_source"]


def scan_sites(warehouse: DataFrame, sites: Keys | None) -> DataFrame:
    """Readings of some sites; a value that is NaN, or text that is no number, is null."""
    value = as_number(warehouse, "observation_value")
    rows = warehouse.withColumn("observation_value", value)
    return for_keys(rows, "site_id", sites)


def with_previous(warehouse: DataFrame, grain: str = "day") -> DataFrame:
    """Previous value and time within site, attribute and source.

    The table may hold several readings at one time; then the smaller value
    counts as the earlier one.
    """
    return previous_reading(
        warehouse,
        SERIES,
        grain=grain,
        time="observation_date_time",
        value="observation_value",
        unique_times=False,
    )


def with_measured_value(lagged: DataFrame, rule: str = "as_published") -> DataFrame:
    return lagged.withColumn(
        "measured_value",
        measured_volume(
            F.col("attribute_name"),
            F.col("observation_value"),
            F.col("prev_value"),
            F.col("prev_time"),
            F.col("observation_date_time"),
            rule,
        ),
    )


def daily_by_source(measured: DataFrame) -> DataFrame:
    """Sum of the non-negative values per site, day and source."""
    return (
        measured.filter(F.col("measured_value") >= 0)
        .groupBy("site_id", F.col("date"), "data_source")
        .agg(F.sum("measured_value").alias("daily_measured_value"))
    )


def reconcile_sources(daily: DataFrame) -> DataFrame:
    """How many sources report a site and day, and how far apart they are.

    A window over the day's few sources instead of joining the sums to
    themselves.
    """
    day = W.partitionBy("site_id", "date")
    return daily.withColumns(
        {
            "duplicate_days": F.count(F.lit(1)).over(day),
            "max_value": F.max("daily_measured_value").over(day),
            "min_value": F.min("daily_measured_value").over(day),
        }
    ).withColumn("difference", F.col("max_value") - F.col("min_value"))

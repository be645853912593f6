"""Measurement catalog and the choice of one measurement per site and day.

A site may hold several overlapping series. They are stitched in order of
their start: a series counts from the day after everything before it ended.
The catalog has a handful of rows per site, so its windows stay small.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterqa.functions.calendar import day_lit, midnight_like
from meterqa.schema import ACCEPTED_MEASUREMENTS, DEFAULT_SERIES_START

Day = str | dt.date


def accepted_measurements(df: DataFrame) -> DataFrame:
    return df.filter(F.col("measurement").isin(list(ACCEPTED_MEASUREMENTS)))


def with_default_start(catalog: DataFrame) -> DataFrame:
    start = midnight_like(catalog, "from_ts", DEFAULT_SERIES_START)
    return catalog.withColumn("from_ts", F.coalesce("from_ts", start))


def process_catalog(
    catalog: DataFrame, from_date: Day | None = None, to_date: Day | None = None
) -> DataFrame:
    """Accepted series with their first and last day, clipped to the window.

    A series that ends at or before the window's first midnight, or starts on
    or after its last day, is dropped; so is one without an end.
    """
    rows = with_default_start(accepted_measurements(catalog)).filter(F.col("to_ts").isNotNull())
    first_day, last_day = F.to_date("from_ts"), F.to_date("to_ts")
    if from_date is not None:
        rows = rows.filter(F.col("to_ts") > midnight_like(rows, "to_ts", from_date))
        first_day = F.greatest(first_day, day_lit(from_date))
    if to_date is not None:
        rows = rows.filter(F.col("from_ts") < midnight_like(rows, "from_ts", to_date))
        last_day = F.least(last_day, day_lit(to_date))
    return rows.select(
        "site",
        "measurement",
        "from_ts",
        "to_ts",
        first_day.alias("from_date"),
        last_day.alias("to_date"),
    )


def stitch_plan(processed: DataFrame) -> DataFrame:
    """Days each series contributes, with skipped series left in as ``taken = false``."""
    order = W.partitionBy("site").orderBy("from_ts", "measurement")
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    up_to_here = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    free_from = F.greatest(
        F.first("from_date").over(up_to_here),
        F.date_add(F.max("to_date").over(earlier), 1),
    )
    return processed.select(
        "site",
        "measurement",
        F.row_number().over(order).cast("bigint").alias("segment_no"),
        free_from.alias("start_date"),
        F.col("to_date").alias("end_date"),
        (free_from <= F.col("to_date")).alias("taken"),
    )


def in_segments(rows: DataFrame, plan: DataFrame, day: Column) -> DataFrame:
    """Rows whose day falls in a taken segment of their own series."""
    taken = plan.filter("taken").select(
        "site", "measurement", "segment_no", "start_date", "end_date"
    )
    return (
        rows.withColumn("_day", day)
        .join(taken, ["site", "measurement"])
        .filter(F.col("_day").between(F.col("start_date"), F.col("end_date")))
        .drop("_day", "start_date", "end_date")
    )


def stitched_readings(readings: DataFrame, plan: DataFrame, day: Column) -> DataFrame:
    """:func:`in_segments` for single readings.

    The plan meets the days of each series first, so that readings are dealt
    by series and day, and no long series lies in one task.
    """
    dated = readings.withColumn("_date", day)
    days = in_segments(
        dated.select("site", "measurement", "_date").distinct(), plan, F.col("_date")
    )
    return dated.join(days, ["site", "measurement", "_date"]).drop("_date")


def whole_extent_plan(processed: DataFrame) -> DataFrame:
    """Plan that keeps every series over its own extent, overlaps included."""
    return processed.select(
        "site",
        "measurement",
        F.lit(1).cast("bigint").alias("segment_no"),
        F.col("from_date").alias("start_date"),
        F.col("to_date").alias("end_date"),
        F.lit(True).alias("taken"),
    )


def known_sites(requested: DataFrame, archive_sites: DataFrame) -> DataFrame:
    """Requested sites that the archive holds."""
    held = archive_sites.select(F.col(archive_sites.columns[0]).alias("site"))
    return requested.join(held, "site", "left_semi")


def unknown_sites(requested: DataFrame, archive_sites: DataFrame) -> DataFrame:
    """Requested sites that the archive does not hold."""
    held = archive_sites.select(F.col(archive_sites.columns[0]).alias("site"))
    return requested.join(held, "site", "left_anti")

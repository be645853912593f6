"""Statistics per day, month and site."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterqa.functions.calendar import month_label
from meterqa.functions.rounding import round_half_even

FLAGS = ("sd5", "sd10", "sd20")


def day_rollup(flagged: DataFrame) -> DataFrame:
    """All that later statistics need, one row per site, measurement and day.

    Volumes come shuffled by these keys already, so this is the last step that
    sees single readings.
    """
    kept = F.when(F.col("vol") >= 0, F.col("vol"))
    positive = F.when(F.col("vol") > 0, F.col("vol"))
    negative = F.when(F.col("vol") < 0, F.col("vol"))
    return flagged.groupBy("site", "measurement", "date").agg(
        F.count(kept).alias("reports"),
        F.sum(kept).alias("sum_kept"),
        F.count(negative).alias("negatives"),
        F.sum(negative).alias("negative_sum"),
        F.min(positive).alias("min_positive"),
        F.sum(positive).alias("sum_positive"),
        F.count(positive).alias("n_positive"),
        F.max(kept).alias("max_kept"),
        *[F.sum(flag).alias(flag) for flag in FLAGS],
    )


def daily_stats(rollup: DataFrame) -> DataFrame:
    """Reports and spikes per site and day; days with negatives only do not count."""
    return (
        rollup.filter(F.col("reports") > 0)
        .groupBy("site", "date")
        .agg(
            F.max("measurement").alias("measurement"),
            F.sum("reports").alias("reports"),
            *[F.sum(flag).alias(flag) for flag in FLAGS],
            F.min("min_positive").alias("min_positive"),
            F.sum("sum_positive").alias("sum_positive"),
            F.sum("n_positive").alias("n_positive"),
            F.max("max_kept").alias("max_kept"),
        )
    )


def negatives_per_month(rollup: DataFrame) -> DataFrame:
    """Same as ``volumes.negatives_by_month``, from day rows."""
    return (
        rollup.filter(F.col("negatives") > 0)
        .groupBy("site", month_label(F.col("date")).alias("month"))
        .agg(
            F.sum("negatives").alias("negative_value_count"),
            F.sum("negative_sum").alias("negative_value_sum"),
        )
    )


def totals_per_day(rollup: DataFrame) -> DataFrame:
    """Readings and volume per site and day without negatives, from day rows."""
    return (
        rollup.filter(F.col("reports") > 0)
        .groupBy("site", "date")
        .agg(F.sum("reports").alias("readings"), F.sum("sum_kept").alias("volume"))
    )


def _mean_positive():
    return F.try_divide(F.sum("sum_positive"), F.sum("n_positive").cast("double"))


def _extraction():
    """Smallest, mean and largest positive volume; all null when there is none."""
    return [
        round_half_even(F.min("min_positive"), 3).alias("min_extraction"),
        round_half_even(_mean_positive(), 1).alias("mean_extraction"),
        round_half_even(F.max(F.when(F.col("n_positive") > 0, F.col("max_kept"))), 1).alias(
            "max_extraction"
        ),
    ]


def monthly_stats(daily: DataFrame) -> DataFrame:
    """Days, reports, spikes and extraction per site and month.

    Extraction is folded into the daily rows, so months without any keep nulls
    and no join of two monthly tables is needed.
    """
    return daily.groupBy("site", month_label(F.col("date")).alias("month")).agg(
        F.max("measurement").alias("meas_type"),
        F.count(F.lit(1)).alias("days_with_data"),
        F.sum("reports").alias("total_reports"),
        *_extraction(),
        *[F.sum(flag).alias(f"spikes_{flag}") for flag in FLAGS],
    )


def monthly_extraction(volumes: DataFrame) -> DataFrame:
    """Extraction statistics of the positive volumes alone."""
    return (
        volumes.filter(F.col("vol") > 0)
        .groupBy("site", month_label(F.col("date")).alias("month"))
        .agg(
            round_half_even(F.min("vol"), 3).alias("min_extraction"),
            round_half_even(F.avg("vol"), 1).alias("mean_extraction"),
            round_half_even(F.max("vol"), 1).alias("max_extraction"),
        )
    )


def quality_summary(rollup: DataFrame, keys: Sequence[str] = ("site",)) -> DataFrame:
    """One quality row per site or per site and measurement.

    Days and measurements count exactly, over day rows.
    """
    has_data = F.col("reports") > 0
    day = F.when(has_data, F.col("date"))
    start, end = F.min(day), F.max(day)
    max_kept = F.max("max_kept")
    return rollup.groupBy(*keys).agg(
        F.count_distinct(F.when(has_data, F.col("measurement"))).alias("meas_used"),
        start.alias("start_date"),
        end.alias("end_date"),
        (F.datediff(end, start) + 1).cast("bigint").alias("total_days"),
        F.count_if(has_data).alias("days_with_data"),
        F.sum("reports").alias("total_reports"),
        round_half_even(F.min("min_positive"), 3).alias("min_extraction"),
        round_half_even(_mean_positive(), 1).alias("mean_extraction"),
        round_half_even(max_kept, 1).alias("max_extraction"),
        F.sum("negatives").alias("negative_values"),
        *[F.sum(flag).alias(f"spikes_{flag}") for flag in FLAGS],
    )

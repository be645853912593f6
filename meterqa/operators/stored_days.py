"""A stored table of day rows, kept up day by day, from which the reports need no reading again.

A row holds what a day's readings of a series give by themselves: counts, the last time, and the state of its volumes; of a register,
the state of the differences inside the day and its first and last value. The difference over midnight is taken when days
are read, from the last value of the day before, so a day that is replaced leaves no other row wrong.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterqa.functions.calendar import is_midnight
from meterqa.operators.day_states import DAY, REGISTER, STATE, state_columns
from meterqa.operators.series import in_segments
from meterqa.sources import archive
from meterqa.sources.tables import as_number

#: Rows, values and rows at midnight, the last time, and the values that join the day to its neighbours.
PLAIN = {
    "n_rows": "count(1)",
    "n_values": "count(value)",
    "midnight_rows": "count_if({midnight})",
    "midnight_values": "count(case when {midnight} then value end)",
    "last_time": "max(date_time)",
    "first_value": "min_by(value, date_time)",
    "last_value": "max_by(value, date_time)",
}


def day_rows(readings: DataFrame) -> DataFrame:
    """One row per site, measurement and day; readings without a site, measurement or time are left out.

    Registers are sorted within a day for their differences; all other readings are aggregated before the shuffle.
    """
    rows = readings.withColumns({"value": as_number(readings, "value"), "date": F.to_date("date_time")})
    rows = rows.filter("site is not null and measurement is not null and date is not null")
    rows = rows.withColumn("_midnight", is_midnight(F.col("date_time")))
    plain = [F.expr(f"{sql.format(midnight='_midnight')} as {name}") for name, sql in PLAIN.items()]
    standing = rows.filter(f"not {REGISTER}").groupBy(*DAY).agg(*plain, *state_columns("value"))
    inside = W.partitionBy(*DAY).orderBy("date_time", "value")
    registers = rows.filter(REGISTER).repartition(*DAY).withColumn("vol", F.col("value") - F.lag("value").over(inside))
    return standing.unionByName(registers.groupBy(*DAY).agg(*plain, *state_columns("vol")))


def refresh_days(spark: SparkSession, archive_path: str, path: str, since: int | None = None) -> list[dt.date]:
    """Bring the stored day rows up to the deliveries from ``since`` on (all without it); returns the days replaced.

    Only those days are read and only their folders replaced, so a run that is repeated changes nothing.
    """
    days = archive.touched_days(spark, archive_path, since or 0)
    if days:
        rows = day_rows(archive.current_readings(spark, archive_path, days if since is not None else None))
        archive.replace_parts(rows, path, "date")
    return days


def stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _with_first(rows: DataFrame) -> DataFrame:
    """States with the register's first difference of the day ``vol`` merged in; null ``vol`` changes nothing."""
    mean = "try_divide(sum_positive, cast(n_positive as double))"
    added = {
        "reports": "reports + if(vol >= 0, 1, 0)",
        "sum_kept": "if(vol >= 0, coalesce(sum_kept, 0d) + vol, sum_kept)",
        "negatives": "negatives + if(vol < 0, 1, 0)",
        "negative_sum": "if(vol < 0, coalesce(negative_sum, 0d) + vol, negative_sum)",
        "min_positive": "if(vol > 0, least(min_positive, vol), min_positive)",
        "sum_positive": "if(vol > 0, coalesce(sum_positive, 0d) + vol, sum_positive)",
        "n_positive": "n_positive + if(vol > 0, 1, 0)",
        "max_kept": "if(vol >= 0, greatest(max_kept, vol), max_kept)",
        "squares": f"squares + if(vol > 0 and n_positive > 0, pow(vol - {mean}, 2) * n_positive / (n_positive + 1), 0d)",
    }
    return rows.selectExpr(*DAY, *[f"{added[c]} as {c}" for c in STATE])


def days_of_plan(days: DataFrame, plan: DataFrame, combined: bool = True) -> DataFrame:
    """Day states of a stitched plan, or with ``combined`` false of series by themselves, from stored day rows."""
    held = in_segments(days, plan, F.col("date"))
    chain = W.partitionBy("site") if combined else W.partitionBy("site", "measurement")
    before = F.lag("last_value").over(chain.orderBy("date"))
    vol = F.when(F.expr(REGISTER), F.col("first_value") - before)
    return _with_first(held.withColumn("vol", vol))


def counts_per_day(days: DataFrame, measurement: str) -> DataFrame:
    """(site, date, all_day, at_midnight) of one measurement, as ``reporting.readings_per_day`` finds them."""
    return days.filter(F.col("measurement") == measurement).select(
        "site", "date", F.col("n_values").alias("all_day"), F.col("midnight_values").alias("at_midnight")
    )

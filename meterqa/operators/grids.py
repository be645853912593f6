"""Daily and hourly totals and their gap-filled calendars.

Totals are aggregated map-side, so a busy site sends one row per day (or hour)
and task. Gaps are filled from the distance to the next row: no calendar table
is built and nothing is joined. A window per site then sees at most one row
per day or hour of its calendar, however many readings there were.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def daily_counts(readings: DataFrame, keys: Sequence[str] = ("site",)) -> DataFrame:
    return readings.groupBy(*keys, F.to_date("date_time").alias("date")).agg(
        F.count("value").alias("readings")
    )


def _totals(column: str) -> list[Column]:
    return [
        F.count(column).alias("readings"),
        F.coalesce(F.sum(column), F.lit(0.0)).alias("volume"),
    ]


def daily_totals(
    readings: DataFrame, value: str = "value", keys: Sequence[str] = ("site",)
) -> DataFrame:
    return readings.groupBy(*keys, F.to_date("date_time").alias("date")).agg(*_totals(value))


def hourly_totals(
    readings: DataFrame, value: str = "value", keys: Sequence[str] = ("site",)
) -> DataFrame:
    return readings.groupBy(
        *keys, F.to_date("date_time").alias("date"), F.hour("date_time").alias("hour")
    ).agg(*_totals(value))


def fill_days(
    rows: DataFrame,
    start: Column | None = None,
    end: Column | None = None,
    keys: Sequence[str] = ("site",),
    order: Sequence[str] = ("date",),
    fill: Mapping[str, Column] | None = None,
    constant: Sequence[str] = (),
) -> DataFrame:
    """Add a row for every day without one, between ``start`` and ``end``.

    The bounds default to a site's first and last day and may be expressions of
    the first and last row. Value columns are null on added days unless
    ``fill`` gives them a value; ``constant`` columns are the same on all days.
    ``added`` tells the rows apart.
    """
    fill = dict(fill or {})
    span = W.partitionBy(*keys).orderBy(*order)
    no_days = F.array().cast("array<date>")

    def days(first: Column, last: Column) -> Column:
        return F.when(first <= last, F.sequence(first, last)).otherwise(no_days)

    start = F.col("date") if start is None else start
    end = F.col("date") if end is None else end
    before = F.when(F.col("_first"), days(start, F.date_sub("date", 1))).otherwise(no_days)
    after = days(F.date_add("date", 1), F.coalesce(F.date_sub("_next", 1), end))
    spread = (
        rows.withColumns(
            {
                "_first": F.lag("date").over(span).isNull(),
                "_next": F.lead("date").over(span),
            }
        )
        .withColumn("_day", F.explode(F.concat(before, F.array("date"), after)))
        .withColumn("added", F.col("_day") != F.col("date"))
    )
    values = [c for c in rows.columns if c not in (*keys, "date", *constant)]
    return spread.select(
        *keys,
        F.col("_day").alias("date"),
        *constant,
        *[
            F.when(F.col("added"), fill[c]).otherwise(F.col(c)).alias(c)
            if c in fill
            else F.when(~F.col("added"), F.col(c)).alias(c)
            for c in values
        ],
        "added",
    )


def missing_dates(
    readings: DataFrame, start: Column, end: Column, keys: Sequence[str] = ("site",)
) -> DataFrame:
    """Days of the window on which a site (with any reading in it) has none."""
    days = readings.select(*keys, F.to_date("date_time").alias("date")).distinct()
    return fill_days(days, start, end, keys).filter("added").select(*keys, "date")


def hourly_grid(
    hourly: DataFrame, start: Column, end: Column, keys: Sequence[str] = ("site",)
) -> DataFrame:
    """Hourly totals plus one zero row at hour 0 for each day without data."""
    return fill_days(
        hourly,
        start,
        end,
        keys,
        order=("date", "hour"),
        fill={"hour": F.lit(0), "readings": F.lit(0).cast("bigint"), "volume": F.lit(0.0)},
    )


def drop_last_row(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Leave out the last row of every group."""
    span = W.partitionBy(*keys).orderBy(*order)
    later = F.lead(F.lit(1)).over(span)
    return rows.withColumn("_later", later).filter("_later is not null").drop("_later")


def moving_average(
    grid: DataFrame, days: int, min_days: int, column: str = "volume", alias: str = "ma"
) -> DataFrame:
    """Average of the last ``days`` calendar days if ``min_days`` of them have data."""
    frame = W.partitionBy("site").orderBy("date").rowsBetween(1 - days, 0)
    enough = F.count(column).over(frame) >= min_days
    return grid.withColumn(alias, F.when(enough, F.avg(column).over(frame)))


def moving_average_by_period(
    grid: DataFrame, period: str, column: str = "volume", alias: str = "ma"
) -> DataFrame:
    """Average over each site's own number of days, all of them with data.

    A frame length cannot differ between rows, so the days are measured in
    periods: position / period. The frame then always reaches back just under
    one period, which is the current day and the ``period - 1`` before it.
    """
    whole_period = F.when(F.col(period) > 0, F.col(period).cast("int"))
    origin = F.lit("1970-01-01").cast("date")
    position = F.datediff("date", origin) / F.coalesce(whole_period, F.lit(1)).cast("double")
    frame = "over (partition by site order by _pos range between 0.999999D preceding and current row)"
    full = F.expr(f"count({column}) {frame}") == whole_period
    return (
        grid.withColumn("_pos", position)
        .withColumn(alias, F.when(full, F.expr(f"avg({column}) {frame}")))
        .drop("_pos")
    )

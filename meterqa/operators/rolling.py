"""Averages over hours or minutes, without one task per site.

Readings become one row per site and step before the shuffle. A site's steps are cut into chunks, and a step is also sent to each
later chunk whose averages still reach back to it; a window then works inside a chunk, with the same rows in the
same order as a window over the whole site. With chunks of at least the length of the average that is one copy at most.
No calendar is built: frames are measured in steps, so a gap is a gap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterqa.sources.tables import as_number

DAY_SECONDS = 86400
#: Steps of a chunk, where the caller asks for nothing else.
CHUNK = 4096


def step_totals(readings: DataFrame, seconds: int, keys: Sequence[str] = ("site",)) -> DataFrame:
    """(keys, date, step, readings, volume) of steps with a value; ``step`` counts from 0 at midnight.

    A reading belongs to the step in which its time lies. Readings without a time or a number are left out.
    """
    if seconds < 1 or DAY_SECONDS % seconds:
        raise ValueError("a day must hold a whole number of steps")
    second = F.hour("date_time") * 3600 + F.minute("date_time") * 60 + F.second("date_time")
    rows = readings.withColumn("value", as_number(readings, "value")).filter("value is not null and date_time is not null")
    return rows.groupBy(
        *keys, F.to_date("date_time").alias("date"), F.floor(second / seconds).cast("int").alias("step")
    ).agg(F.count("value").alias("readings"), F.sum("value").alias("volume"))


def rolling_average(
    totals: DataFrame,
    seconds: int,
    steps: int | str,
    min_steps: int | None = None,
    keys: Sequence[str] = ("site",),
    alias: str = "ma",
    chunk: int = CHUNK,
) -> DataFrame:
    """``totals`` of :func:`step_totals` with the average of the last ``steps`` steps that have a value.

    ``steps`` is a number or a column with each site's own; without one above 0 there is no average. Fewer than ``min_steps``
    steps with a value (all of them, by default) give null.
    """
    own = F.col(steps) if isinstance(steps, str) else F.lit(steps)
    length = F.when(own > 0, own.cast("long"))
    at = F.datediff("date", F.lit("1970-01-01").cast("date")).cast("long") * (DAY_SECONDS // seconds) + F.col("step")
    placed = totals.withColumns({"_at": at, "_length": length})
    home = F.floor(F.col("_at") / chunk)
    reach = F.floor((F.col("_at") + F.coalesce("_length", F.lit(1)) - 1) / chunk)
    spread = placed.withColumn("_chunk", F.explode(F.sequence(home, reach)))
    # A frame length cannot differ between rows, so steps are measured in lengths; the frame is just under one of them.
    spread = spread.withColumn(
        "_pos", (F.col("_at") - F.col("_chunk") * chunk) / F.coalesce("_length", F.lit(1)).cast("double")
    )
    group = ", ".join([*keys, "_chunk"])
    frame = f"over (partition by {group} order by _pos range between 0.99999999D preceding and current row)"
    need = _needed(min_steps)
    return (
        spread.withColumns({"_n": F.expr(f"count(volume) {frame}"), "_mean": F.expr(f"avg(volume) {frame}")})
        .filter(home == F.col("_chunk"))
        .withColumn(alias, F.when(F.col("_n") >= need, F.col("_mean")))
        .select(*totals.columns, alias)
    )


def _needed(min_steps: int | None) -> Column:
    return F.col("_length") if min_steps is None else F.when(F.col("_length").isNotNull(), F.lit(min_steps))

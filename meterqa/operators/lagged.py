"""The previous reading of a series, without one task per series.

``lag`` over a whole series puts all rows of a site into one task, and one
site may hold a large share of the archive. Instead the series is cut into
time buckets. Inside a bucket a plain window works; the last reading of every
bucket (map-side aggregated, one row per bucket) is carried to the next bucket
of the series through a window over the bucket rows only.

Readings are shuffled once, by series and bucket. The join that brings the
carried reading has the same keys, and so can every later step per day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterqa.operators.series import in_segments

GRAINS = {"day": ["date"], "hour": ["date", "hour"], "minute": ["date", "hour", "minute"]}


def with_buckets(readings: DataFrame, grain: str = "day", time: str = "date_time") -> DataFrame:
    """Add the bucket columns of a grain; every grain includes the date."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {sorted(GRAINS)}")
    parts = {"date": F.to_date(time), "hour": F.hour(time), "minute": F.minute(time)}
    return readings.withColumns({name: parts[name] for name in GRAINS[grain]})


def bucket_ends(
    bucketed: DataFrame,
    keys: Sequence[str],
    grain: str = "day",
    time: str = "date_time",
    value: str = "value",
) -> DataFrame:
    """Last reading of each series and bucket, for unique timestamps.

    The aggregate keeps two numbers, so it runs as a hash aggregate before the shuffle.
    """
    return bucketed.groupBy(*keys, *GRAINS[grain]).agg(
        F.max_by(value, time).alias("end_value"), F.max(time).alias("end_time")
    )


def chain_buckets(ends: DataFrame, series: Sequence[str], grain: str = "day") -> DataFrame:
    """Give each bucket the last reading of the bucket before it in the series."""
    chain = W.partitionBy(*series).orderBy(*GRAINS[grain])
    return ends.withColumns(
        {
            "carried_value": F.lag("end_value").over(chain),
            "carried_time": F.lag("end_time").over(chain),
        }
    ).drop("end_value", "end_time")


def previous_reading(
    readings: DataFrame,
    keys: Sequence[str],
    series: Sequence[str] | None = None,
    grain: str = "day",
    plan: DataFrame | None = None,
    time: str = "date_time",
    value: str = "value",
    unique_times: bool = True,
    per_series: DataFrame | None = None,
) -> DataFrame:
    """Readings with ``prev_value`` and ``prev_time``.

    ``keys`` name one stored series; ``series`` (a subset) names what the
    buckets are chained along. They differ for a stitched series, where a
    bucket belongs to one measurement but the chain runs over the site. A
    ``plan`` keeps only the buckets of its segments, decided on the bucket
    rows, before the readings are joined. Columns of ``per_series`` (one row
    per series) reach the readings the same way, at no extra shuffle of them.
    Nulls in ``keys`` are values like others; a reading without time comes first.
    """
    bucketed = with_buckets(readings, grain, time)
    on = [*keys, *GRAINS[grain]]
    # One struct as the key: inside it a null equals a null, so series without a source or kind are series too.
    bucket = F.struct(*on)
    tie = [] if unique_times else [value]
    inside = W.partitionBy("_bucket").orderBy(time, *tie)
    # Said outright, or a preceding join on the site would leave a site in one place.
    # The keys travel inside it alone, so that several passes need the same columns and share one shuffle.
    rest = [c for c in bucketed.columns if c not in on]
    out = [F.col("_bucket")[c].alias(c) for c in on]
    dealt = bucketed.select(bucket.alias("_bucket"), *rest).repartition("_bucket")
    if unique_times:
        ends = bucket_ends(bucketed, keys, grain, time, value)
    else:
        # Of equal times the larger value is the later one; the last row of a bucket is found where the rows lie sorted.
        marked = dealt.withColumn("_last", F.row_number().over(inside) == F.count(F.lit(1)).over(W.partitionBy("_bucket")))
        ends = marked.filter("_last").select(*out, F.col(value).alias("end_value"), F.col(time).alias("end_time"))
    if plan is not None:
        ends = in_segments(ends, plan, F.col("date"))
    carried = chain_buckets(ends, series or keys, grain)
    if per_series is not None:
        shared = [c for c in per_series.columns if c in keys]
        carried = carried.join(per_series, shared, "left")
    carried = carried.select(bucket.alias("_bucket"), *[c for c in carried.columns if c not in on])
    stepped = dealt.withColumns(
        {
            "_value": F.lag(value).over(inside),
            "_time": F.lag(time).over(inside),
            "_first": F.row_number().over(inside) == 1,
        }
    )
    beside = [c for c in carried.columns if c not in ("_bucket", "carried_value", "carried_time")]
    return stepped.join(carried, "_bucket").select(
        *out,
        *rest,
        *beside,
        F.when(F.col("_first"), F.col("carried_value")).otherwise(F.col("_value")).alias("prev_value"),
        F.when(F.col("_first"), F.col("carried_time")).otherwise(F.col("_time")).alias("prev_time"),
    )

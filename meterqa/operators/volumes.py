"""Readings to volumes in m3, negatives, and spike flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterqa.functions.calendar import month_label
from meterqa.operators.lagged import previous_reading, with_buckets
from meterqa.operators.series import accepted_measurements
from meterqa.schema import SPIKE_MULTIPLES, WATER_METER
from meterqa.sources.tables import as_number

SERIES = ["site", "measurement"]
SPIKE_RULES = {"sum": "mean + sd * {k}", "product": "mean * sd * {k}"}


def register_to_volume(
    readings: DataFrame,
    plan: DataFrame | None = None,
    boundary: str = "combined",
    grain: str = "day",
    per_site: DataFrame | None = None,
) -> DataFrame:
    """Readings of accepted measurements with ``vol``.

    A register reading counts as its difference from the previous reading; the
    other measurements are volumes already. ``boundary='combined'`` takes the
    previous reading of the stitched site series, so the first register reading
    after another measurement is compared with that measurement's last value
    (needs ``plan``). ``boundary='reset'`` starts every measurement afresh.
    Columns of ``per_site``, such as spike limits, come along with the buckets.
    """
    if boundary == "combined":
        if plan is None:
            raise ValueError("a combined series needs a stitch plan")
        series = ["site"]
    elif boundary == "reset":
        series = SERIES
    else:
        raise ValueError(f"unknown boundary {boundary!r}")
    # Readings of no site are in no series; said outright, so that passes with and without a join share one shuffle.
    accepted = accepted_measurements(readings).filter(F.col("site").isNotNull())
    accepted = accepted.withColumn("value", as_number(readings, "value"))
    rows = previous_reading(accepted, SERIES, series, grain, plan, per_series=per_site)
    vol = F.when(
        F.col("measurement") == WATER_METER, F.col("value") - F.col("prev_value")
    ).otherwise(F.col("value"))
    return rows.withColumn("vol", vol).drop("prev_value", "prev_time")


def plain_volumes(readings: DataFrame, grain: str = "day") -> DataFrame:
    """Readings that are volumes as they stand."""
    numbers = readings.withColumn("value", as_number(readings, "value"))
    return with_buckets(numbers, grain).withColumn("vol", F.col("value"))


def remove_negatives(volumes: DataFrame) -> DataFrame:
    """Null volumes (a register's first reading) go as well."""
    return volumes.filter(F.col("vol") >= 0)


def negatives_by_month(volumes: DataFrame) -> DataFrame:
    return (
        volumes.filter(F.col("vol") < 0)
        .groupBy("site", month_label(F.col("date")).alias("month"))
        .agg(
            F.count("vol").alias("negative_value_count"),
            F.sum("vol").alias("negative_value_sum"),
        )
    )


def spike_params(volumes: DataFrame, keys: Sequence[str] = ("site",)) -> DataFrame:
    """Mean and sample deviation of the positive volumes, and the row counts.

    One map-side combined aggregate; negative and null volumes do not count.
    """
    positive = F.when(F.col("vol") > 0, F.col("vol"))
    return (
        volumes.filter(F.col("vol") >= 0)
        .groupBy(*keys)
        .agg(
            F.avg(positive).alias("mean"),
            F.stddev_samp(positive).alias("sd"),
            F.count("vol").alias("kept_rows"),
            F.count(positive).alias("positive_rows"),
        )
    )


def limit_rule(rule: str = "sum") -> str:
    """The limit of ``k`` deviations; ``rule='product'`` is the older mean * sd * k."""
    if rule not in SPIKE_RULES:
        raise ValueError(f"unknown rule {rule!r}")
    return SPIKE_RULES[rule]


def spike_limits(params: DataFrame, rule: str = "sum", gate: str = "kept_rows") -> DataFrame:
    """Limits per site, null where they do not apply.

    A site needs a deviation of at least 1 and more than 100 rows, counted by
    ``gate``.
    """
    armed = (F.col("sd") >= 1) & (F.col(gate) > 100)
    limit = limit_rule(rule)
    return params.select(
        "site", *[F.when(armed, F.expr(limit.format(k=k))).alias(f"limit{k}") for k in SPIKE_MULTIPLES]
    )


def mark_spikes(volumes: DataFrame) -> DataFrame:
    """``sd5``, ``sd10``, ``sd20`` of volumes that carry their limits."""
    flags = {
        f"sd{k}": F.when(F.col("vol") > F.col(f"limit{k}"), 1).otherwise(0)
        for k in SPIKE_MULTIPLES
    }
    return volumes.withColumns(flags).drop(*[f"limit{k}" for k in SPIKE_MULTIPLES])


def flag_spikes(
    volumes: DataFrame, params: DataFrame, rule: str = "sum", gate: str = "kept_rows"
) -> DataFrame:
    """Add 1 where a volume exceeds its site's limit, else 0.

    The limits join by series and time bucket (the bucket columns that the
    volumes carry), spread over the buckets first, so that no site's volumes
    meet in one task. Where volumes come from :func:`register_to_volume`, pass
    the limits there instead.
    """
    bucket = [c for c in ("site", "measurement", "date", "hour", "minute") if c in volumes.columns]
    buckets = volumes.select(*bucket).distinct()
    spread = buckets.join(spike_limits(params, rule, gate), "site", "left")
    return mark_spikes(volumes.join(spread, bucket, "left"))

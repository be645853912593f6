"""Permits: which ones count, and the limits they set."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterqa.functions.calendar import day_lit
from meterqa.functions.units import rate_to_daily_volume
from meterqa.schema import ACTIVE_CONSENT, CONSENT_DATE_FORMATS, HYDROELECTRIC
from meterqa.sources.tables import as_number

Day = str | dt.date


def as_timestamp(
    df: DataFrame, column: str, formats: Sequence[str] = CONSENT_DATE_FORMATS
) -> Column:
    """A date column as timestamp; the first format that fits a text counts, and one that none fits becomes null."""
    if isinstance(df.schema[column].dataType, T.StringType):
        text = F.trim(column)
        parsed = F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])
        return parsed.cast("timestamp_ntz")
    return F.col(column).cast("timestamp_ntz")


def with_dates(consents: DataFrame, formats: Sequence[str] = CONSENT_DATE_FORMATS) -> DataFrame:
    return consents.withColumns(
        {c: as_timestamp(consents, c, formats) for c in ("from_date", "to_date")}
    )


def exclude_use(consents: DataFrame, use: str = HYDROELECTRIC) -> DataFrame:
    """Leave out one water use; permits with no stated use stay."""
    return consents.filter(~F.col("water_use").eqNullSafe(F.lit(use)))


def minimum_duration(consents: DataFrame, days: int = 10) -> DataFrame:
    """Permits that run for more than ``days`` whole days."""
    return consents.filter(F.timestamp_diff("DAY", "from_date", "to_date") > days)


def overlapping(
    consents: DataFrame, from_date: Day = "1900-07-01", to_date: Day = "2100-06-30"
) -> DataFrame:
    """Permits that start before the range ends and end after it starts."""
    return consents.filter(
        (F.col("from_date") < day_lit(to_date).cast("timestamp_ntz"))
        & (F.col("to_date") > day_lit(from_date).cast("timestamp_ntz"))
    )


def usable_consents(
    consents: DataFrame,
    from_date: Day = "1900-07-01",
    to_date: Day = "2100-06-30",
    include_hydroelectric: bool = False,
    date_formats: Sequence[str] = CONSENT_DATE_FORMATS,
) -> DataFrame:
    rows = consents if include_hydroelectric else exclude_use(consents)
    return overlapping(minimum_duration(with_dates(rows, date_formats)), from_date, to_date)


def effective_consents(consents: DataFrame) -> DataFrame:
    """A site's active permits, else all that share its latest end date.

    The choice per site is a small aggregate joined back, not a window over all
    permits of a site.
    """
    is_active = F.col("consent_status") == ACTIVE_CONSENT
    choice = consents.groupBy("ext_site_id").agg(
        F.coalesce(F.max(is_active), F.lit(False)).alias("_has_active"),
        F.max("to_date").alias("_latest"),
    )
    chosen = F.when(F.col("_has_active"), is_active).otherwise(
        F.col("to_date") == F.col("_latest")
    )
    return consents.join(choice, "ext_site_id").filter(chosen).drop("_has_active", "_latest")


def _numbers(consents: DataFrame) -> DataFrame:
    columns = ("consented_rate", "consented_multiday_volume", "consented_multiday_period")
    return consents.withColumns({c: as_number(consents, c) for c in columns})


def site_limits(consents: DataFrame) -> DataFrame:
    """Limits of the effective permits, straight from all permits.

    Same result as ``consent_limits(effective_consents(...))`` from one
    aggregate: permits are summed per end date, then the active sums or those
    of the latest date are picked. No permit is joined or sorted.
    """
    active = F.coalesce(F.col("consent_status") == ACTIVE_CONSENT, F.lit(False))
    by_date = _numbers(consents).groupBy("ext_site_id", active.alias("active"), "to_date").agg(
        F.sum("consented_rate").alias("rate"),
        F.sum("consented_multiday_volume").alias("volume"),
        F.max("consented_multiday_period").alias("period"),
    )
    when_active = {c: F.when(F.col("active"), F.col(c)) for c in ("rate", "volume", "period")}
    picked = by_date.groupBy("ext_site_id").agg(
        F.max("active").alias("has_active"),
        F.struct(
            F.sum(when_active["rate"]).alias("rate"),
            F.sum(when_active["volume"]).alias("volume"),
            F.max(when_active["period"]).alias("period"),
        ).alias("sums"),
        F.max_by(F.struct("rate", "volume", "period"), F.col("to_date")).alias("latest"),
    )
    chosen = F.when(F.col("has_active"), F.col("sums")).otherwise(F.col("latest"))
    return (
        picked.select("ext_site_id", chosen.alias("c"))
        .filter(F.col("c").isNotNull())
        .select(
            "ext_site_id",
            F.coalesce("c.rate", F.lit(0.0)).alias("max_rate"),
            F.coalesce("c.volume", F.lit(0.0)).alias("multiday_vol"),
            F.col("c.period").cast("bigint").alias("return_period"),
        )
        .withColumn("max_vol", rate_to_daily_volume(F.col("max_rate")))
    )


def consent_limits(effective: DataFrame) -> DataFrame:
    """Rate, daily volume, multi-day volume and period per take point."""
    return (
        _numbers(effective)
        .groupBy("ext_site_id")
        .agg(
            F.coalesce(F.sum("consented_rate"), F.lit(0.0)).alias("max_rate"),
            F.coalesce(F.sum("consented_multiday_volume"), F.lit(0.0)).alias("multiday_vol"),
            F.max("consented_multiday_period").cast("bigint").alias("return_period"),
        )
        .withColumn("max_vol", rate_to_daily_volume(F.col("max_rate")))
    )

"""Unit conversions between rates and volumes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterqa.functions.calendar import hour_boundaries, second_boundaries
from meterqa.functions.rounding import round_half_even
from meterqa.schema import WAREHOUSE_AVERAGE_FLOW, WAREHOUSE_FLOW, WATER_METER

# fixed values
LITRES_PER_M3 = 1000.0
SECONDS_PER_DAY = 86400.0
M3_PER_DAY_PER_LITRE_PER_SECOND = 86.4


def daily_volume_to_rate(volume: Column) -> Column:
    """m3 in a day to L/s."""
    return volume * F.lit(LITRES_PER_M3 / SECONDS_PER_DAY)


def rate_to_daily_volume(rate: Column) -> Column:
    """L/s to m3 in a day, two decimals."""
    return round_half_even(rate * F.lit(M3_PER_DAY_PER_LITRE_PER_SECOND), 2)


def multiday_reference(volume: Column, period: Column) -> Column:
    """Permitted volume per day of a multi-day condition."""
    return round_half_even(F.try_divide(volume, period.cast("double")), 1)


def measured_volume(
    attribute: Column,
    value: Column,
    previous_value: Column,
    previous_time: Column,
    time: Column,
    rule: str = "as_published",
) -> Column:
    """Volume of a warehouse reading.

    ``as_published`` keeps the published formulas, whose units do not work out;
    ``physical`` multiplies a flow by the time it ran. No elapsed time gives null.
    """
    seconds = second_boundaries(previous_time, time).cast("double")
    hours = hour_boundaries(previous_time, time).cast("double")
    if rule == "as_published":
        flow = F.try_divide(value * F.lit(LITRES_PER_M3), seconds)
        average_flow = F.try_divide(value, hours)
    elif rule == "physical":
        flow = value * seconds / F.lit(LITRES_PER_M3)
        average_flow = value * hours
    else:
        raise ValueError(f"unknown rule {rule!r}")
    return (
        F.when(attribute == WATER_METER, value - previous_value)
        .when(attribute == WAREHOUSE_FLOW, flow)
        .when(attribute == WAREHOUSE_AVERAGE_FLOW, average_flow)
        .otherwise(value)
    )

"""Rounding and truncation as the reports print them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(value: Column, places: int) -> Column:
    """Banker's rounding of a double; Spark's own ``round`` is half-up."""
    scale = float(10**places)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def truncate(value: Column) -> Column:
    """Whole part, toward zero."""
    return value.cast("bigint")

"""Days with data as bitmaps: one row per key and year, six numbers of 64 bits.

Bits of parts are joined by OR before and after the shuffle, so a row leaves each task for a key and year however many readings or days
it saw. Distinct days are counted bits, missing days the bits that are not set; no window over a site is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 6


def day_bits(dated: DataFrame, keys: Sequence[str] = ("site",), day: str = "date") -> DataFrame:
    """``keys``, year and the words ``days0`` to ``days5``; a row without a day adds nothing."""
    at = F.dayofyear(day) - 1
    bit = F.expr(f"shiftleft(1l, (dayofyear({day}) - 1) % 64)")
    words = [
        F.coalesce(F.bit_or(F.when(F.floor(at / 64) == k, bit)), F.lit(0).cast("long")).alias(f"days{k}") for k in range(WORDS)
    ]
    return dated.filter(F.col(day).isNotNull()).groupBy(*keys, F.year(day).alias("year")).agg(*words)


def merged_bits(bitmaps: DataFrame, keys: Sequence[str] = ("site",)) -> DataFrame:
    """Bitmaps of several tables or of finer keys as one."""
    return bitmaps.groupBy(*keys, "year").agg(*[F.bit_or(f"days{k}").alias(f"days{k}") for k in range(WORDS)])


def _count() -> Column:
    return F.expr(" + ".join(f"bit_count(days{k})" for k in range(WORDS))).cast("bigint")


def distinct_days(bitmaps: DataFrame, keys: Sequence[str] = ("site",)) -> DataFrame:
    """``keys`` and the number of distinct days, the first and the last."""
    days = F.expr("sequence(make_date(year, 1, 1), make_date(year, 12, 31))")
    held = F.filter(days, _is_set)
    return (
        bitmaps.withColumns({"_n": _count(), "_first": F.array_min(held), "_last": F.array_max(held)})
        .groupBy(*keys)
        .agg(F.sum("_n").alias("days_with_data"), F.min("_first").alias("start_date"), F.max("_last").alias("end_date"))
    )


def _is_set(day: Column) -> Column:
    at = F.dayofyear(day) - 1
    word = F.element_at(F.array(*[F.col(f"days{k}") for k in range(WORDS)]), (F.floor(at / 64) + 1).cast("int"))
    return F.getbit(word, at % 64) == 1


def missing_days(bitmaps: DataFrame, start: Column, end: Column, keys: Sequence[str] = ("site",)) -> DataFrame:
    """Days of the window on which a key (with any day in it) has none.

    Years without a day of a key are made up from its other years, so a gap of years is missing too.
    """
    years = F.sequence(F.year(start), F.year(end))
    held = bitmaps.filter(F.col("year").between(F.year(start), F.year(end)))
    # A key's rows of the window's years, of which there are few, meet as one map.
    words = F.struct(*[F.col(f"days{k}") for k in range(WORDS)])
    by_year = held.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("year", words.alias("words")))).alias("of"))
    each = by_year.select(*keys, "of", F.explode(years).alias("year"))
    each = each.select(
        *keys, "year", *[F.coalesce(F.col("of")[F.col("year")][f"days{k}"], F.lit(0).cast("long")).alias(f"days{k}") for k in range(WORDS)]
    )
    first = F.greatest(start, F.make_date("year", F.lit(1), F.lit(1)))
    last = F.least(end, F.make_date("year", F.lit(12), F.lit(31)))
    gaps = F.filter(F.sequence(first, last), lambda d: ~_is_set(d))
    inside = F.exists(F.sequence(first, last), _is_set)
    some = each.withColumns({"_gaps": gaps, "_inside": inside})
    known = some.filter("_inside").select(*keys).distinct()
    return some.join(known, list(keys), "left_semi").select(*keys, F.explode("_gaps").alias("date"))

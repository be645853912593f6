"""Dates, labels and date windows.

All of it works on TIMESTAMP_NTZ and DATE, so no session time zone can move a
reading to another day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_day(text: str | dt.date) -> dt.date:
    """A ``YYYY-MM-DD`` job argument; anything else raises ValueError."""
    if isinstance(text, dt.date):
        return text
    return dt.datetime.strptime(text, "%Y-%m-%d").date()


def days_before(day: str | dt.date, n: int) -> dt.date:
    return parse_day(day) - dt.timedelta(days=n)


def days_after(day: str | dt.date, n: int) -> dt.date:
    return parse_day(day) + dt.timedelta(days=n)


def day_lit(day: str | dt.date) -> Column:
    return F.lit(parse_day(day)).cast("date")


def midnight_like(df: DataFrame, column: str, day: str | dt.date) -> Column:
    """Midnight as a literal of the column's own type, so the filter reaches the scan."""
    return F.lit(f"{parse_day(day)} 00:00:00").cast(df.schema[column].dataType)


def is_midnight(ts: Column) -> Column:
    return (F.hour(ts) == 0) & (F.minute(ts) == 0) & (F.extract(F.lit("SECOND"), ts) == 0)


def month_label(day: Column) -> Column:
    """``2024-01``"""
    return F.date_format(F.to_date(day), "yyyy-MM")


def month_day_label(day: Column) -> Column:
    """``1/9``: month and day without padding."""
    return F.date_format(F.to_date(day), "M/d")


def year_month_day_label(day: Column) -> Column:
    """``2024/1/9``"""
    return F.date_format(F.to_date(day), "y/M/d")


def padded_day(day: Column) -> Column:
    """``09``"""
    return F.date_format(F.to_date(day), "dd")


def water_year_start(day: Column) -> Column:
    """1 July on or before the day."""
    year = F.year(day) - F.when(F.month(day) <= 6, 1).otherwise(0)
    return F.make_date(year, F.lit(7), F.lit(1))


def _epoch_days(ts: Column) -> Column:
    return F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")


def second_boundaries(earlier: Column, later: Column) -> Column:
    """How many whole-second marks lie between two timestamps."""

    def mark(ts: Column) -> Column:
        in_day = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
        return _epoch_days(ts) * 86400 + in_day

    return mark(later) - mark(earlier)


def hour_boundaries(earlier: Column, later: Column) -> Column:
    """How many full-hour marks lie between two timestamps (10:59 to 11:01 is one)."""

    def mark(ts: Column) -> Column:
        return _epoch_days(ts) * 24 + F.hour(ts)

    return mark(later) - mark(earlier)

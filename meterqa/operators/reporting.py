"""How often a meter normally reports, and how complete its last week is."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterqa.functions.calendar import (
    day_lit,
    days_after,
    days_before,
    is_midnight,
    midnight_like,
    parse_day,
)
from meterqa.functions.rounding import round_half_even
from meterqa.schema import (
    COMPLIANCE_VOLUME,
    STATUS_KEY_ERROR,
    STATUS_MODE_ZERO,
    STATUS_NO_WEEK,
    STATUS_VALUE_ERROR,
)
from meterqa.sources.tables import observations_range

Day = str | dt.date

YEAR_DAYS = 365
QUARTER_DAYS = 91


def mode_windows(as_of: Day) -> list[tuple[int, str, dt.date, dt.date]]:
    """The year up to a day and its four quarters going back, in order of preference."""
    as_of = parse_day(as_of)
    windows = [(0, "Annual", days_before(as_of, YEAR_DAYS), as_of)]
    for q in range(1, 5):
        end = days_before(as_of, QUARTER_DAYS * (q - 1))
        windows.append((q, f"Qtr{q}", days_before(end, QUARTER_DAYS), end))
    return windows


def readings_per_day(observations: DataFrame, as_of: Day) -> DataFrame:
    year = observations_range(
        observations,
        measurements=[COMPLIANCE_VOLUME],
        from_date=days_before(as_of, YEAR_DAYS),
        to_date=as_of,
    )
    at_midnight = F.when(is_midnight(F.col("date_time")), F.col("value"))
    return year.groupBy("site", F.to_date("date_time").alias("date")).agg(
        F.count("value").alias("all_day"), F.count(at_midnight).alias("at_midnight")
    )


def window_modes(observations: DataFrame, as_of: Day) -> DataFrame:
    """:func:`modes_of_days` of the readings of the year."""
    return modes_of_days(readings_per_day(observations, as_of), as_of)


def modes_of_days(daily: DataFrame, as_of: Day) -> DataFrame:
    """Mode of the daily reading count per site and window, empty days as 0.

    The archive is read and shuffled once, as daily counts. A window ends at a
    midnight, so its last day has only that reading. Empty days are not built:
    they are the window's length less its days with readings. Ties go to the
    smaller count.
    """
    windows = mode_windows(as_of)
    day = F.col("date")
    entries = F.array(
        *[
            F.when(
                day.between(day_lit(start), day_lit(end)),
                F.struct(
                    F.lit(no).alias("window_no"),
                    F.when(day == day_lit(end), F.col("at_midnight"))
                    .otherwise(F.col("all_day"))
                    .alias("readings"),
                ),
            )
            for no, _, start, end in windows
        ]
    )
    lengths = F.create_map(
        *[F.lit(x) for no, _, start, end in windows for x in (no, (end - start).days + 1)]
    )
    histogram = (
        daily.filter(day.between(day_lit(windows[0][2]), day_lit(as_of)))
        .withColumn("entry", F.explode(F.filter(entries, lambda e: e.isNotNull())))
        .select("site", "entry.window_no", "entry.readings")
        .groupBy("site", "window_no", "readings")
        .agg(F.count(F.lit(1)).alias("days"))
    )
    seen = F.col("readings") > 0
    best = F.max(F.when(seen, F.struct(F.col("days"), (-F.col("readings")).alias("negated"))))
    return (
        histogram.groupBy("site", "window_no")
        .agg(best.alias("best"), F.sum(F.when(seen, F.col("days"))).alias("busy_days"))
        .withColumn("window_days", lengths[F.col("window_no")].cast("bigint"))
        .withColumn(
            "empty_days", F.col("window_days") - F.coalesce("busy_days", F.lit(0).cast("bigint"))
        )
        .withColumn(
            "by_count", F.col("best").isNotNull() & (F.col("best.days") > F.col("empty_days"))
        )
        .select(
            "site",
            "window_no",
            F.when(F.col("by_count"), -F.col("best.negated"))
            .otherwise(F.lit(0).cast("bigint"))
            .alias("mode"),
            F.when(F.col("by_count"), F.col("best.days"))
            .otherwise(F.col("empty_days"))
            .alias("mode_days"),
            "window_days",
        )
    )


def _share():
    return round_half_even(F.col("mode_days") / F.col("window_days"), 2)


def annual_mode(observations: DataFrame, as_of: Day) -> DataFrame:
    """Mode and its share of the days of the year window."""
    return (
        window_modes(observations, as_of)
        .filter("window_no = 0")
        .select("site", "mode", _share().alias("mode_freq"))
    )


def reporting_modes(observations: DataFrame, as_of: Day) -> DataFrame:
    """:func:`pick_modes` of the readings of the year."""
    return pick_modes(window_modes(observations, as_of), as_of)


def pick_modes(modes: DataFrame, as_of: Day) -> DataFrame:
    """Annual mode, or the first non-zero quarter when that is 0.

    The share is given for annual modes only. Sites without a reading in the
    year are left out; names that stand for several meters are skipped by the
    caller (``is_composite``).
    """
    names = F.create_map(*[F.lit(x) for no, name, _, _ in mode_windows(as_of) for x in (no, name)])
    nonzero = F.when(F.col("mode") != 0, F.struct("window_no", "mode"))
    return (
        modes.groupBy("site")
        .agg(
            F.min(nonzero).alias("pick"),
            F.max(F.when(F.col("window_no") == 0, _share())).alias("annual_freq"),
        )
        .withColumn("window_no", F.coalesce("pick.window_no", F.lit(0)))
        .select(
            "site",
            F.coalesce("pick.mode", F.lit(0).cast("bigint")).alias("mode"),
            F.when(F.col("window_no") == 0, F.col("annual_freq")).alias("mode_freq"),
            names[F.col("window_no")].alias("method"),
        )
    )


def week_and_year(observations: DataFrame, week_end: Day) -> DataFrame:
    """Per site: readings in the week, and the latest reading in week and year.

    The week runs over the 7 days up to ``week_end`` and includes the midnight
    that closes it; the year ends at the same midnight.
    """
    end = days_after(week_end, 1)
    rows = observations_range(
        observations,
        measurements=[COMPLIANCE_VOLUME],
        from_date=days_before(end, YEAR_DAYS),
        to_date=end,
    )
    in_week = F.col("date_time") >= midnight_like(rows, "date_time", days_before(end, 7))
    return rows.groupBy("site").agg(
        F.count(F.when(in_week, F.col("value"))).alias("week_readings"),
        F.max(F.when(in_week, F.col("date_time"))).alias("week_last"),
        F.max("date_time").alias("year_last"),
    )


def week_and_year_of_days(days: DataFrame, week_end: Day) -> DataFrame:
    """:func:`week_and_year` from stored day rows; of the last day only its midnight counts."""
    end = days_after(week_end, 1)
    last_day = F.col("date") == day_lit(end)
    rows = days.filter(
        (F.col("measurement") == COMPLIANCE_VOLUME)
        & F.col("date").between(day_lit(days_before(end, YEAR_DAYS)), day_lit(end))
        & (~last_day | (F.col("midnight_rows") > 0))
    ).withColumns(
        {
            "_count": F.when(last_day, F.col("midnight_values")).otherwise(F.col("n_values")),
            "_last": F.when(last_day, F.col("date").cast("timestamp_ntz")).otherwise(F.col("last_time")),
        }
    )
    in_week = F.col("date") >= day_lit(days_before(end, 7))
    return rows.groupBy("site").agg(
        F.coalesce(F.sum(F.when(in_week, F.col("_count"))), F.lit(0)).cast("bigint").alias("week_readings"),
        F.max(F.when(in_week, F.col("_last"))).alias("week_last"),
        F.max("_last").alias("year_last"),
    )


def percent_complete(week_readings, mode):
    """Readings of eight calendar days, less the closing midnight, against the mode."""
    expected = (mode * 7).cast("double")
    return round_half_even(F.try_divide((week_readings - 1).cast("double"), expected) * 100.0, 1)


def weekly_completeness(modes: DataFrame, observations: DataFrame, week_end: Day) -> DataFrame:
    """Completeness and last reading of the sites with readings in the week."""
    return (
        modes.join(week_and_year(observations, week_end), "site")
        .filter(F.col("week_last").isNotNull() & (F.col("mode") > 0))
        .select(
            "site",
            F.col("mode").cast("bigint").alias("mode"),
            percent_complete(F.col("week_readings"), F.col("mode")).alias("perc_complete"),
            F.col("week_last").alias("last_report"),
        )
    )


def weekly_missing_report(
    modes: DataFrame, observations: DataFrame, archive_sites: DataFrame, week_end: Day
) -> DataFrame:
    """:func:`missing_report` of the readings of the year."""
    return missing_report(modes, week_and_year(observations, week_end), archive_sites)


def missing_report(modes: DataFrame, weeks: DataFrame, archive_sites: DataFrame) -> DataFrame:
    """One row per site of the mode table: a percentage, or a status saying why not.

    A site unknown to the archive gets ``Key error``; a null mode is treated as
    a site without a usable week.
    """
    held = archive_sites.select(F.col(archive_sites.columns[0]).alias("site")).distinct()
    joined = modes.join(held.withColumn("held", F.lit(True)), "site", "left").join(
        weeks, "site", "left"
    )
    in_week = F.col("week_last").isNotNull() & F.col("mode").isNotNull()
    known = F.coalesce("held", F.lit(False))
    status = (
        F.when(~known, STATUS_KEY_ERROR)
        .when(in_week & (F.col("mode") > 0), F.lit(None).cast("string"))
        .when(in_week & (F.col("mode") == 0), STATUS_MODE_ZERO)
        .when(F.col("year_last").isNotNull(), STATUS_NO_WEEK)
        .otherwise(STATUS_VALUE_ERROR)
    )
    percent = F.when(
        known & in_week & (F.col("mode") > 0),
        percent_complete(F.col("week_readings"), F.col("mode")),
    )
    last = F.when(known, F.when(in_week, F.col("week_last")).otherwise(F.col("year_last")))
    return joined.select(
        "site",
        F.col("mode").cast("bigint").alias("mode"),
        percent.alias("perc_complete"),
        status.alias("status"),
        last.alias("last_report"),
    )

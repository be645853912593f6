"""Reports over a list of sites; one site is a list of one.

Every function builds one lazy plan for all sites. ``sites`` may be a list, a
DataFrame or ``None`` for the whole archive.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterqa.functions.calendar import (
    day_lit,
    days_after,
    days_before,
    month_day_label,
    month_label,
    padded_day,
    water_year_start,
    year_month_day_label,
)
from meterqa.functions.names import external_site, is_composite
from meterqa.functions.rounding import truncate
from meterqa.functions.units import daily_volume_to_rate, multiday_reference
from meterqa.operators import consents as con
from meterqa.operators import (
    day_states,
    grids,
    meters,
    reporting,
    series,
    summaries,
    volumes,
    warehouse,
)
from meterqa.schema import COMPLIANCE_VOLUME
from meterqa.sources.tables import Keys, external_sites, for_keys, observations_range

Day = str | dt.date


# --- missing data -------------------------------------------------------------


def reporting_modes(observations: DataFrame, as_of: Day, sites: Keys | None = None) -> DataFrame:
    """Normal number of readings per day for every single-meter site."""
    rows = for_keys(observations, "site", sites)
    rows = rows.filter(~is_composite(F.col("site")))
    return reporting.reporting_modes(rows, as_of)


def weekly_missing_report(
    modes: DataFrame, observations: DataFrame, archive_sites: DataFrame, week_end: Day
) -> DataFrame:
    return reporting.weekly_missing_report(modes, observations, archive_sites, week_end)


def daily_plot_table(observations: DataFrame, as_of: Day, sites: Keys | None = None) -> DataFrame:
    """Daily readings and volume of the last 365 days, empty days null."""
    start = days_before(as_of, 365)
    rows = observations_range(observations, sites, [COMPLIANCE_VOLUME], start, as_of)
    grid = grids.fill_days(grids.daily_totals(rows), day_lit(start), day_lit(as_of))
    return grid.select(
        "site",
        "date",
        month_label(F.col("date")).alias("month"),
        F.dayofmonth("date").alias("day"),
        "readings",
        "volume",
    )


def hourly_plot_table(observations: DataFrame, as_of: Day, sites: Keys | None = None) -> DataFrame:
    """Hourly readings and volume of the last 31 days, empty days one zero row."""
    start = days_before(as_of, 31)
    rows = observations_range(observations, sites, [COMPLIANCE_VOLUME], start, as_of)
    grid = grids.hourly_grid(grids.hourly_totals(rows), day_lit(start), day_lit(as_of))
    return grid.select(
        "site",
        "date",
        "hour",
        month_day_label(F.col("date")).alias("day"),
        padded_day(F.col("date")).alias("day_val"),
        "readings",
        truncate(F.col("volume")).alias("volume_int"),
        "volume",
    )


def month_hourly_table(
    observations: DataFrame, start: Day, sites: Keys | None = None, grain: str = "day"
) -> DataFrame:
    """Hourly volume per measurement for 35 days; negatives stay in.

    Registers are differenced within the window only, so the first reading of
    a register has no volume. The last row of every table is dropped.
    """
    end = days_after(start, 35)
    rows = observations_range(observations, sites, None, start, end)
    vols = volumes.register_to_volume(rows, boundary="reset", grain=grain)
    keys = ["site", "measurement"]
    grid = grids.hourly_grid(
        grids.hourly_totals(vols, "vol", keys), day_lit(start), day_lit(end), keys
    )
    return grids.drop_last_row(grid, keys, ["date", "hour"]).select(
        *keys,
        "date",
        F.year("date").alias("year"),
        "hour",
        year_month_day_label(F.col("date")).alias("day"),
        padded_day(F.col("date")).alias("day_val"),
        "readings",
        truncate(F.col("volume")).alias("volume_int"),
        "volume",
    )


# --- quality assessment ---------------------------------------------------------


def _with_missing(requested: DataFrame, held: DataFrame, summary: DataFrame) -> DataFrame:
    """Requested sites left-joined to their summary; ``in_archive`` says Y or N.

    A site that is requested twice appears once.
    """
    known = held.select(F.col(held.columns[0]).alias("site")).distinct()
    return (
        requested.select("site")
        .distinct()
        .join(known.withColumn("_held", F.lit("Y")), "site", "left")
        .withColumn("in_archive", F.coalesce("_held", F.lit("N")))
        .drop("_held")
        .join(summary, "site", "left")
    )


def quality_combined(
    observations: DataFrame, catalog: DataFrame, requested: DataFrame, grain: str = "day"
) -> DataFrame:
    """Quality of each requested site's stitched series."""
    # The plan covers the requested sites only, so readings need no join with them.
    cat = for_keys(catalog, "site", requested.select("site"))
    processed = series.process_catalog(cat)
    days = day_states.flagged_days(observations, series.stitch_plan(processed), grain=grain)
    types = series.accepted_measurements(cat).groupBy("site").agg(
        F.count(F.lit(1)).alias("meas_types")
    )
    summary = types.join(summaries.quality_summary(days), "site", "left")
    return _with_missing(requested, catalog.select("site"), summary).withColumn(
        "meas_types",
        F.when(F.col("in_archive") == "Y", F.coalesce("meas_types", F.lit(0).cast("bigint"))),
    )


def quality_by_measurement(
    observations: DataFrame, catalog: DataFrame, requested: DataFrame, grain: str = "day"
) -> DataFrame:
    """Quality of each measurement over its own extent.

    Spike limits come from the stitched series and need more than 100 positive
    volumes there.
    """
    cat = for_keys(catalog, "site", requested.select("site"))
    processed = series.process_catalog(cat)
    days = day_states.flagged_days(
        observations,
        series.stitch_plan(processed),
        series.whole_extent_plan(processed),
        grain,
        gate="positive_rows",
    )
    stats = summaries.quality_summary(days, ["site", "measurement"]).drop("meas_used")
    summary = processed.select("site", "measurement").join(stats, ["site", "measurement"], "left")
    return _with_missing(requested, catalog.select("site"), summary)


# --- time series ----------------------------------------------------------------


def _listed(sites: Keys | None) -> Keys | None:
    """Sites that the scan itself filters; a table of sites restricts the plan instead."""
    return None if isinstance(sites, DataFrame) else sites


def stitched_volumes(
    observations: DataFrame,
    catalog: DataFrame,
    sites: Keys | None = None,
    from_date: Day | None = None,
    to_date: Day | None = None,
    grain: str = "day",
) -> DataFrame:
    """Volumes of the stitched series, optionally of a date window."""
    rows = observations_range(
        observations, _listed(sites), None, from_date, to_date, whole_days=True
    )
    processed = series.process_catalog(for_keys(catalog, "site", sites), from_date, to_date)
    return volumes.register_to_volume(rows, series.stitch_plan(processed), grain=grain)


def flagged_volumes(
    readings: DataFrame, plan: DataFrame, grain: str = "day", rule: str = "sum"
) -> DataFrame:
    """Stitched volumes with spike flags.

    The readings are read from one shuffle twice, for the limits and for the
    flags; the limits travel with the series buckets.
    """
    params = volumes.spike_params(volumes.register_to_volume(readings, plan, grain=grain))
    return volumes.mark_spikes(
        volumes.register_to_volume(
            readings, plan, grain=grain, per_site=volumes.spike_limits(params, rule)
        )
    )


def monthly_statistics(flagged: DataFrame) -> DataFrame:
    """Monthly statistics of volumes with spike flags."""
    return summaries.monthly_stats(summaries.daily_stats(summaries.day_rollup(flagged)))


def stitched_days(
    observations: DataFrame,
    catalog: DataFrame,
    sites: Keys | None = None,
    from_date: Day | None = None,
    to_date: Day | None = None,
    grain: str = "day",
) -> DataFrame:
    """One row per site and day of the stitched series, with all later reports need.

    Write this table once and build the statistics and the daily series from
    it; the readings are then shuffled once for all of them.
    """
    rows = observations_range(
        observations, _listed(sites), None, from_date, to_date, whole_days=True
    )
    processed = series.process_catalog(for_keys(catalog, "site", sites), from_date, to_date)
    return day_states.flagged_days(rows, series.stitch_plan(processed), grain=grain)


def statistics_from_days(days: DataFrame, processed: DataFrame) -> dict[str, DataFrame]:
    """The three tables of the statistics workbook."""
    return {
        "measurements": processed,
        "negatives_removed": summaries.negatives_per_month(days),
        "monthly_statistics": summaries.monthly_stats(summaries.daily_stats(days)),
    }


def monthly_pack(
    observations: DataFrame,
    catalog: DataFrame,
    sites: Keys | None = None,
    from_date: Day | None = None,
    to_date: Day | None = None,
    grain: str = "day",
) -> dict[str, DataFrame]:
    """Statistics workbook straight from the readings."""
    days = stitched_days(observations, catalog, sites, from_date, to_date, grain)
    processed = series.process_catalog(for_keys(catalog, "site", sites), from_date, to_date)
    return statistics_from_days(days, processed)


def _daily(table: DataFrame) -> DataFrame:
    """Daily totals of volumes, or of the day rows of ``stitched_days``."""
    if "vol" in table.columns:
        return grids.daily_totals(volumes.remove_negatives(table), "vol")
    return summaries.totals_per_day(table)


def _water_year_grid(daily: DataFrame, constant: Sequence[str] = ()) -> DataFrame:
    """Daily totals from the start of a site's first water year to its last day."""
    return grids.fill_days(daily, water_year_start(F.col("date")), constant=constant)


def _series_columns(grid: DataFrame, fill_readings: bool) -> list:
    readings = F.col("readings")
    if fill_readings:
        readings = F.coalesce(readings, F.lit(0).cast("bigint"))
    return [
        F.col("date"),
        month_label(F.col("date")).alias("month"),
        F.dayofmonth("date").alias("day"),
        readings.alias("readings"),
        F.col("volume"),
        daily_volume_to_rate(F.col("volume")).alias("rate"),
    ]


def daily_series(table: DataFrame, fill_readings: bool = True) -> DataFrame:
    """Daily volume, rate and 30-day average (at least 21 days with data).

    Takes volumes, or the day rows of ``stitched_days``.
    """
    grid = grids.moving_average(_water_year_grid(_daily(table)), 30, 21, alias="ma30")
    return grid.select("site", *_series_columns(grid, fill_readings), "ma30")


def daily_series_consent(table: DataFrame, consents: DataFrame) -> DataFrame:
    """Daily series with the permit's average and reference lines.

    Limits belong to the take point and apply to each of its meters; sites
    without a permit keep nulls.
    """
    limits = con.site_limits(consents)
    daily = _daily(table).withColumn("ext_site_id", external_site(F.col("site")))
    # Joined before the gaps are filled, so the grid stays where its site is.
    grid = _water_year_grid(daily.join(limits, "ext_site_id", "left"), limits.columns)
    grid = grids.moving_average_by_period(grid, "return_period")
    base = grid.select(
        "site",
        *_series_columns(grid, True),
        "ma",
        "max_vol",
        multiday_reference(F.col("multiday_vol"), F.col("return_period")).alias("ref_line"),
        "max_rate",
    )
    return base.withColumns(
        {
            name: F.coalesce(F.col(value) > F.col(limit), F.lit(False))
            for name, value, limit in (
                ("over_max_vol", "volume", "max_vol"),
                ("over_ref_line", "ma", "ref_line"),
                ("over_max_rate", "rate", "max_rate"),
            )
        }
    )


# --- meter lists ------------------------------------------------------------------


def meters_from_sites(
    consents: DataFrame, archive_sites: DataFrame, ext_site_ids: Keys, **options
) -> DataFrame:
    usable = con.usable_consents(for_keys(consents, "ext_site_id", ext_site_ids), **options)
    return meters.meter_list(usable, archive_sites)


def meters_from_consents(
    consents: DataFrame, archive_sites: DataFrame, record_numbers: Keys, **options
) -> DataFrame:
    usable = con.usable_consents(for_keys(consents, "record_number", record_numbers), **options)
    return meters.meter_list(usable, archive_sites)


def meters_from_catchment(
    consents: DataFrame,
    archive_sites: DataFrame,
    ext_sites: DataFrame,
    where: Mapping[str, Sequence[str]],
    **options,
) -> DataFrame:
    ids = external_sites(ext_sites, where).select("ext_site_id")
    return meters_from_sites(consents, archive_sites, ids, **options)


# --- warehouse --------------------------------------------------------------------


def warehouse_daily(
    observations: DataFrame,
    sites: Keys | None = None,
    rule: str = "as_published",
    grain: str = "day",
) -> DataFrame:
    """Daily abstraction per source with the spread between sources, unordered."""
    rows = warehouse.scan_sites(observations, sites)
    measured = warehouse.with_measured_value(warehouse.with_previous(rows, grain), rule)
    return warehouse.reconcile_sources(warehouse.daily_by_source(measured))

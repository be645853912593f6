"""``queries()`` entries: one per operator and report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import views as v
from meterqa.functions import calendar as cal
from meterqa.functions import names, units
from meterqa.functions.rounding import round_half_even, truncate
from meterqa.operators import consents as con
from meterqa.operators import (
    accounts,
    day_bitmaps,
    day_states,
    grids,
    meters,
    reporting,
    rolling,
    series,
    stored_days,
    summaries,
    volumes,
    warehouse,
)
from meterqa.plans import reports
from meterqa.schema import COMPLIANCE_VOLUME
from meterqa.sources import archive, files, layout, rejects, tables, versions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _shown(df: DataFrame) -> DataFrame:
    """Dates as ISO text, as the reports are read outside Spark."""
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name)
            if isinstance(f.dataType, T.DateType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf_dir: _shown(fn(spark, sf_dir))
    return fn


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    """Sums depend on the order of addition in the last digits; show fewer."""
    return df.withColumns({c: round_half_even(F.col(c), places) for c in columns})


def floated(df: DataFrame, *columns: str) -> DataFrame:
    """Counts that may be absent, as doubles: clients differ in how they show null integers."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


# --- scans ----------------------------------------------------------------------


@query
def scan_observations_range(spark, d):
    return tables.observations_range(
        v.readings(spark, d), None, ["Compliance Volume", "Volume"], "2024-01-05", "2024-01-15"
    )


@query
def measurement_catalog(spark, d):
    return tables.measurement_catalog(v.readings(spark, d))


@query
def site_list(spark, d):
    return tables.site_list(v.readings(spark, d))


@query
def consents_by_key(spark, d):
    keys = v.requested(spark, d).select(names.external_site(F.col("site")).alias("k"))
    return tables.for_keys(v.consents(spark, d), "ext_site_id", keys)


@query
def ext_sites_filtered(spark, d):
    return tables.external_sites(
        v.ext_sites(spark, d), {"swaz_name": ["Zone 1", "Zone 2", "Zone 4"]}
    )


@query
def wh_scan_sites(spark, d):
    return warehouse.scan_sites(v.warehouse(spark, d), v.requested(spark, d))


# --- filters --------------------------------------------------------------------


@query
def measurement_whitelist(spark, d):
    return series.accepted_measurements(v.readings(spark, d))


@query
def site_slice(spark, d):
    return tables.site_slice(tables.site_list(v.readings(spark, d)), 3, 8)


@query
def skip_composite_sites(spark, d):
    rows = v.faulty_names(spark, d).select("site")
    return rows.filter(~names.is_composite(F.col("site")))


@query
def remove_negatives(spark, d):
    kept = volumes.remove_negatives(volumes.plain_volumes(v.all_volumes(spark, d)))
    return kept.select("site", "date_time", "vol")


@query
def consents_exclude_use(spark, d):
    return con.exclude_use(v.consents(spark, d)).select("record_number", "water_use")


@query
def consents_min_duration(spark, d):
    rows = con.minimum_duration(con.with_dates(v.consents_as_text(spark, d)))
    return rows.select("record_number", "from_date", "to_date")


@query
def consents_overlap(spark, d):
    rows = con.overlapping(con.with_dates(v.consents(spark, d)), "1996-07-01", "1997-06-30")
    return rows.select("record_number", "from_date", "to_date")


@query
def site_id_pattern(spark, d):
    rows = v.faulty_names(spark, d).select("site")
    return rows.filter(names.looks_like_site_id(F.col("site")))


@query
def clip_catalog(spark, d):
    return series.process_catalog(v.catalog(spark, d), *v.WINDOW)


@query
def catalog_default_start(spark, d):
    return series.with_default_start(v.catalog(spark, d))


@query
def catalog_processed(spark, d):
    return series.process_catalog(v.catalog(spark, d))


@query
def valid_sites(spark, d):
    held = tables.site_list(v.readings(spark, d))
    return series.known_sites(v.requested(spark, d), held)


@query
def missing_sites(spark, d):
    held = tables.site_list(v.readings(spark, d))
    return series.unknown_sites(v.requested(spark, d), held).withColumn(
        "in_archive", F.lit("N")
    )


# --- stitching and volumes --------------------------------------------------------


def _plan(spark, d, *window):
    return series.stitch_plan(series.process_catalog(v.catalog(spark, d), *window))


def _stitched(spark, d, *window):
    return volumes.register_to_volume(v.readings(spark, d), _plan(spark, d, *window), grain=v.GRAIN)


@query
def stitch_plan(spark, d):
    return _plan(spark, d)


@query
def stitched_series(spark, d):
    rows = series.accepted_measurements(v.readings(spark, d))
    return series.stitched_readings(rows, _plan(spark, d), F.to_date("date_time"))


@query
def register_to_volume(spark, d):
    return _stitched(spark, d).select("site", "measurement", "date_time", "value", "vol")


@query
def register_to_volume_laid_out(spark, d):
    """The same from an archive of months and buckets."""
    folder = v.work_folder(spark)
    name = f"laid_out_{folder.rsplit('/', 1)[-1]}"
    layout.lay_out(v.readings(spark, d), name, folder, 8)
    found = layout.laid_out_volumes(spark, name, _plan(spark, d))
    return found.select("site", "measurement", "date_time", "value", "vol")


@query
def reading_accounts(spark, d):
    """What became of every reading of the stitched series; some readings have no value."""
    rows = v.text_readings(spark, d)
    plan = _plan(spark, d)
    return accounts.reading_accounts(rows, plan, day_states.flagged_days(rows, plan, grain=v.GRAIN))


@query
def register_to_volume_reset(spark, d):
    rows = volumes.register_to_volume(v.readings(spark, d), boundary="reset", grain=v.GRAIN)
    return rows.select("site", "measurement", "date_time", "value", "vol")


@query
def negatives_by_month(spark, d):
    return rounded(
        volumes.negatives_by_month(_stitched(spark, d)), 4, "negative_value_sum"
    )


@query
def spike_params(spark, d):
    return rounded(volumes.spike_params(_stitched(spark, d)), 4, "mean", "sd")


def _flags(spark, d, rule):
    kept = volumes.remove_negatives(volumes.plain_volumes(v.all_volumes(spark, d)))
    flagged = volumes.flag_spikes(kept, volumes.spike_params(kept), rule=rule)
    return flagged.select("site", "date_time", "vol", "sd5", "sd10", "sd20")


@query
def spike_flags(spark, d):
    return _flags(spark, d, "sum")


@query
def spike_flags_product(spark, d):
    return _flags(spark, d, "product")


# --- totals and grids ---------------------------------------------------------------


def _compliance(spark, d, start, end):
    return tables.observations_range(
        v.readings(spark, d), None, ["Compliance Volume"], start, end
    )


@query
def daily_counts(spark, d):
    return grids.daily_counts(series.accepted_measurements(v.readings(spark, d)))


@query
def daily_totals(spark, d):
    return grids.daily_totals(v.long_series(spark, d))


@query
def hourly_totals(spark, d):
    rows = series.accepted_measurements(v.readings(spark, d))
    return rounded(grids.hourly_totals(rows), 4, "volume")


@query
def daily_grid_zero_fill(spark, d):
    zero = F.lit(0).cast("bigint")
    counts = grids.daily_counts(v.long_series(spark, d))
    return grids.fill_days(counts, fill={"readings": zero}).drop("added")


@query
def daily_grid_null_fill(spark, d):
    grid = grids.fill_days(grids.daily_totals(v.long_series(spark, d))).drop("added")
    return floated(grid, "readings")


@query
def missing_dates(spark, d):
    rows = _compliance(spark, d, "2023-12-12", v.PLOT_AS_OF)
    return grids.missing_dates(rows, cal.day_lit("2023-12-12"), cal.day_lit(v.PLOT_AS_OF))


@query
def hourly_grid(spark, d):
    hourly = grids.hourly_totals(_compliance(spark, d, "2023-12-12", v.PLOT_AS_OF))
    grid = grids.hourly_grid(hourly, cal.day_lit("2023-12-12"), cal.day_lit(v.PLOT_AS_OF))
    return rounded(grid.drop("added"), 4, "volume")


@query
def daily_plot_table(spark, d):
    table = reports.daily_plot_table(v.readings(spark, d), v.PLOT_AS_OF)
    return floated(rounded(table, 4, "volume"), "readings")


@query
def hourly_plot_table(spark, d):
    return rounded(reports.hourly_plot_table(v.readings(spark, d), v.PLOT_AS_OF), 4, "volume")


@query
def month_hourly_grid(spark, d):
    table = reports.month_hourly_table(v.readings(spark, d), v.MONTH_START, grain=v.GRAIN)
    return rounded(table, 4, "volume")


@query
def moving_avg_30(spark, d):
    grid = grids.fill_days(grids.daily_totals(v.long_series(spark, d)))
    return rounded(
        grids.moving_average(grid, 30, 21, alias="ma30").select("site", "date", "ma30"), 6, "ma30"
    )


@query
def moving_avg_consent(spark, d):
    grid = grids.fill_days(grids.daily_totals(v.long_series(spark, d)))
    limits = con.consent_limits(con.effective_consents(v.consents(spark, d)))
    joined = grid.withColumn("ext_site_id", names.external_site(F.col("site"))).join(
        limits, "ext_site_id", "left"
    )
    averaged = grids.moving_average_by_period(joined, "return_period")
    return rounded(averaged.select("site", "date", "return_period", "ma"), 6, "ma")


@query
def rolling_avg_hourly(spark, d):
    """The last 24 hours of every hour with a reading, where 12 of them have one."""
    hours = rolling.step_totals(v.all_volumes(spark, d), 3600)
    return rounded(rolling.rolling_average(hours, 3600, 24, 12, chunk=100), 6, "volume", "ma")


@query
def rolling_avg_by_period(spark, d):
    """Quarter hours, over each site's own number of hours of two to seven."""
    own = F.col("site").substr(3, 2).cast("int") % 6
    steps = rolling.step_totals(v.all_volumes(spark, d), 900).withColumn("period", 4 * (2 + own))
    return rounded(rolling.rolling_average(steps, 900, "period", 3), 6, "volume", "ma")


# --- statistics -----------------------------------------------------------------------


@query
def daily_stats(spark, d):
    flagged = reports.flagged_volumes(v.readings(spark, d), _plan(spark, d), v.GRAIN)
    daily = summaries.daily_stats(summaries.day_rollup(flagged))
    return daily.select("site", "date", "measurement", "reports", "sd5", "sd10", "sd20")


@query
def monthly_extraction(spark, d):
    return summaries.monthly_extraction(volumes.plain_volumes(v.long_series(spark, d)))


@query
def monthly_stats(spark, d):
    vols = volumes.plain_volumes(v.long_series(spark, d))
    return reports.monthly_statistics(volumes.flag_spikes(vols, volumes.spike_params(vols)))


@query
def monthly_stats_stitched(spark, d):
    pack = reports.monthly_pack(v.readings(spark, d), v.catalog(spark, d), grain=v.GRAIN)
    return pack["monthly_statistics"]


@query
def negatives_removed(spark, d):
    pack = reports.monthly_pack(v.readings(spark, d), v.catalog(spark, d), grain=v.GRAIN)
    return rounded(pack["negatives_removed"], 4, "negative_value_sum")


@query
def monthly_stats_windowed(spark, d):
    start, end = v.WINDOW
    pack = reports.monthly_pack(
        v.readings(spark, d), v.catalog(spark, d), None, start, end, grain=v.GRAIN
    )
    return pack["monthly_statistics"]


@query
def daily_series_consent_windowed(spark, d):
    start, end = v.WINDOW
    days = reports.stitched_days(v.readings(spark, d), v.catalog(spark, d), None, start, end, v.GRAIN)
    table = reports.daily_series_consent(days, v.consents(spark, d))
    return rounded(table, 4, "volume", "rate", "ma").transform(lambda t: rounded(t, 2, "max_rate"))


_QA_COUNTS = [
    "total_days",
    "days_with_data",
    "total_reports",
    "negative_values",
    "spikes_sd5",
    "spikes_sd10",
    "spikes_sd20",
]


@query
def qa_combined(spark, d):
    table = reports.quality_combined(
        v.readings(spark, d), v.catalog(spark, d), v.requested(spark, d), grain=v.GRAIN
    )
    return floated(table, "meas_types", "meas_used", *_QA_COUNTS)


@query
def qa_by_measurement(spark, d):
    table = reports.quality_by_measurement(
        v.readings(spark, d), v.catalog(spark, d), v.requested(spark, d), grain=v.GRAIN
    )
    return floated(table, *_QA_COUNTS)


@query
def nan_readings(spark, d):
    """Quality of readings whose values are text, NaN among them."""
    table = reports.quality_combined(
        v.text_readings(spark, d), v.catalog(spark, d), v.requested(spark, d), grain=v.GRAIN
    )
    return floated(table, "meas_types", "meas_used", *_QA_COUNTS)


# --- reporting frequency ----------------------------------------------------------------


@query
def reporting_mode_annual(spark, d):
    return reporting.annual_mode(v.mode_readings(spark, d), v.MODES_AS_OF)


@query
def reporting_modes(spark, d):
    return reports.reporting_modes(v.mode_readings(spark, d), v.MODES_AS_OF)


def _modes_with_others(spark, d):
    """Modes of the archive, and an assumed 24 a day for the other requested sites."""
    found = reports.reporting_modes(v.mode_readings(spark, d), v.MODES_AS_OF)
    others = (
        v.requested(spark, d)
        .join(found, "site", "left_anti")
        .select("site", F.lit(24).cast("bigint").alias("mode"))
    )
    return found.select("site", "mode").unionByName(others)


@query
def weekly_completeness(spark, d):
    return reporting.weekly_completeness(
        _modes_with_others(spark, d), v.mode_readings(spark, d), v.WEEK_END
    )


@query
def weekly_missing_report(spark, d):
    return reports.weekly_missing_report(
        _modes_with_others(spark, d),
        v.mode_readings(spark, d),
        v.week_sites(spark, d),
        v.WEEK_END,
    )


def _day_rows(spark, d):
    return stored_days.day_rows(v.mode_readings(spark, d))


@query
def modes_from_days(spark, d):
    daily = stored_days.counts_per_day(_day_rows(spark, d), COMPLIANCE_VOLUME)
    modes = reporting.modes_of_days(daily, v.MODES_AS_OF)
    return reporting.pick_modes(modes, v.MODES_AS_OF)


@query
def weekly_report_from_days(spark, d):
    weeks = reporting.week_and_year_of_days(_day_rows(spark, d), v.WEEK_END)
    return reporting.missing_report(_modes_with_others(spark, d), weeks, v.week_sites(spark, d))


@query
def incremental_days(spark, d):
    """Spike parameters from stored days that three deliveries brought up to date; the second corrects, the third is late and repeats."""
    folder = v.work_folder(spark)
    paths = f"{folder}/archive", f"{folder}/days"
    for no, rows in enumerate(v.deliveries(spark, d)):
        archive.deliver(rows, paths[0], no)
        stored_days.refresh_days(spark, *paths, since=no)
    days = stored_days.days_of_plan(stored_days.stored(spark, paths[1]), _plan(spark, d))
    return rounded(day_states.merged_params(days), 4, "mean", "sd")


@query
def stitched_days_from_stored(spark, d):
    """States of the stitched days from day rows, differences over midnight included."""
    days = stored_days.days_of_plan(stored_days.day_rows(v.readings(spark, d)), _plan(spark, d))
    params = day_states.merged_params(days)
    return rounded(params, 4, "mean", "sd")


@query
def missing_dates_bitmaps(spark, d):
    rows = _compliance(spark, d, "2023-12-12", v.PLOT_AS_OF).withColumn("date", F.to_date("date_time"))
    start, end = cal.day_lit("2023-12-12"), cal.day_lit(v.PLOT_AS_OF)
    return day_bitmaps.missing_days(day_bitmaps.day_bits(rows), start, end)


@query
def distinct_days_bitmaps(spark, d):
    dated = v.long_series(spark, d).withColumn("date", F.to_date("date_time"))
    return day_bitmaps.distinct_days(day_bitmaps.day_bits(dated))


# --- consents and daily series -------------------------------------------------------------


@query
def consents_effective(spark, d):
    return con.effective_consents(v.consents(spark, d)).select(
        "ext_site_id", "record_number", "to_date", "consent_status"
    )


@query
def consent_limits(spark, d):
    limits = con.consent_limits(con.effective_consents(v.consents(spark, d)))
    return rounded(limits, 2, "max_rate", "multiday_vol")


@query
def consent_site_limits(spark, d):
    return rounded(con.site_limits(v.consents(spark, d)), 2, "max_rate", "multiday_vol")


@query
def daily_series(spark, d):
    vols = volumes.plain_volumes(v.long_series(spark, d))
    return rounded(reports.daily_series(vols), 6, "rate", "ma30")


@query
def daily_series_stitched(spark, d):
    days = reports.stitched_days(v.readings(spark, d), v.catalog(spark, d), grain=v.GRAIN)
    return rounded(reports.daily_series(days), 4, "volume", "rate", "ma30")


@query
def daily_series_null_readings(spark, d):
    vols = volumes.plain_volumes(v.long_series(spark, d))
    table = reports.daily_series(vols, fill_readings=False).select("site", "date", "readings")
    return floated(table, "readings")


@query
def daily_series_consent(spark, d):
    vols = volumes.plain_volumes(v.long_series(spark, d))
    table = reports.daily_series_consent(vols, v.consents(spark, d))
    return rounded(table, 6, "rate", "ma").transform(lambda t: rounded(t, 2, "max_rate"))


# --- meter lists ----------------------------------------------------------------------------


@query
def consent_meter_join(spark, d):
    found = meters.meters_with_site_id(tables.site_list(v.readings(spark, d)))
    joined = meters.consent_meter_join(v.consents(spark, d), found)
    return joined.select("record_number", "ext_site_id", "site_name")


_METER_COLUMNS = [
    "record_number",
    "ext_site_id",
    "from_date",
    "to_date",
    "water_use",
    "consent_status",
    "site_name",
]


@query
def meters_from_sites(spark, d):
    ids = v.requested(spark, d).select(names.external_site(F.col("site")).alias("k"))
    return reports.meters_from_sites(
        v.consents(spark, d), tables.site_list(v.readings(spark, d)), ids
    ).select(*_METER_COLUMNS)


@query
def meters_from_consents(spark, d):
    numbers = v.table(spark, d, "lineitem").select(
        F.concat(F.lit("CRC"), F.col("l_orderkey").cast("string")).alias("k")
    )
    return reports.meters_from_consents(
        v.consents(spark, d), tables.site_list(v.readings(spark, d)), numbers
    ).select(*_METER_COLUMNS)


@query
def meters_from_catchment(spark, d):
    return reports.meters_from_catchment(
        v.consents(spark, d),
        tables.site_list(v.readings(spark, d)),
        v.ext_sites(spark, d),
        {"swaz_name": ["Zone 1", "Zone 2", "Zone 3"]},
    ).select(*_METER_COLUMNS)


# --- warehouse --------------------------------------------------------------------------------


def _lagged(spark, d):
    return warehouse.with_previous(v.warehouse(spark, d), v.GRAIN)


@query
def wh_lag(spark, d):
    return _lagged(spark, d).select(
        "site_id",
        "attribute_name",
        "data_source",
        "observation_date_time",
        "observation_value",
        "prev_value",
        "prev_time",
    )


def _conversion(spark, d, rule):
    measured = warehouse.with_measured_value(_lagged(spark, d), rule)
    shown = measured.select(
        "site_id",
        "attribute_name",
        "data_source",
        "observation_date_time",
        "measured_value",
        units.daily_volume_to_rate(F.col("measured_value")).alias("rate"),
        units.rate_to_daily_volume(F.col("observation_value")).alias("max_vol"),
        units.multiday_reference(
            F.col("observation_value"), F.dayofmonth("observation_date_time") % 5
        ).alias("ref_line"),
    )
    return rounded(shown, 6, "measured_value", "rate")


@query
def unit_conversion(spark, d):
    return _conversion(spark, d, "as_published")


@query
def unit_conversion_physical(spark, d):
    return _conversion(spark, d, "physical")


@query
def wh_daily_by_source(spark, d):
    daily = warehouse.daily_by_source(warehouse.with_measured_value(_lagged(spark, d)))
    return rounded(daily, 3, "daily_measured_value")


@query
def daily_source_reconcile(spark, d):
    table = reports.warehouse_daily(
        v.warehouse(spark, d), v.requested(spark, d), grain=v.GRAIN
    )
    return rounded(
        table, 3, "daily_measured_value", "max_value", "min_value", "difference"
    ).orderBy("site_id", "date")


@query
def wh_null_sources(spark, d):
    table = reports.warehouse_daily(v.warehouse_gaps(spark, d), grain=v.GRAIN)
    return rounded(table, 3, "daily_measured_value", "max_value", "min_value", "difference")


# --- scalar functions ---------------------------------------------------------------------------


@query
def calendar_labels(spark, d):
    day = F.to_date("date_time")
    return v.readings(spark, d).select(
        "date_time",
        day.alias("date"),
        F.year("date_time").alias("year"),
        F.month("date_time").alias("month_no"),
        F.dayofmonth("date_time").alias("day_no"),
        F.hour("date_time").alias("hour"),
        cal.month_label(F.col("date_time")).alias("month"),
        cal.month_day_label(F.col("date_time")).alias("month_day"),
        cal.year_month_day_label(F.col("date_time")).alias("year_month_day"),
        cal.padded_day(F.col("date_time")).alias("day_val"),
        cal.water_year_start(day).alias("water_year"),
        cal.water_year_start(F.date_add(day, F.hour("date_time") * 15)).alias("later_water_year"),
        F.date_sub(day, 91).alias("quarter_start"),
        truncate(F.col("value")).alias("whole_value"),
    )


@query
def site_name_functions(spark, d):
    site = F.col("site")
    return v.faulty_names(spark, d).select(
        "site",
        names.external_site(site).alias("external_site"),
        names.site_id_from_name(site).alias("site_id"),
        names.file_safe(site).alias("file_name"),
        F.trim(F.concat(site, F.lit("  "))).alias("trimmed"),
        names.is_composite(site).cast("int").alias("composite"),
    )


# --- files and faults -------------------------------------------------------------------


@query
def rejected_readings(spark, d):
    """Values of the text readings that are no numbers."""
    return rejects.rejected(v.text_readings(spark, d), {"value": rejects.NUMBER}, ["site", "measurement", "date_time"])


@query
def rejected_permit_dates(spark, d):
    kinds = {"from_date": rejects.DATE, "to_date": rejects.DATE, "ext_site_id": rejects.SITE}
    return rejects.rejected(v.consents_as_text(spark, d), kinds, ["record_number"])


@query
def rejected_sites(spark, d):
    return rejects.rejected(v.faulty_names(spark, d), {"site": rejects.SITE}, ["swaz_name"])


@query
def report_read_back(spark, d):
    """Monthly statistics written as a report of two tables, one folder per site, and read through the manifest."""
    folder = v.work_folder(spark)
    stats = QUERIES["monthly_stats"](spark, d)
    versions.write_report({"catalog": v.catalog(spark, d)}, folder, files.write_by_site)
    versions.write_report({"statistics": stats, "catalog": v.catalog(spark, d)}, folder, files.write_by_site)
    return versions.read_report(spark, folder, "statistics")


@query
def site_list_read_back(spark, d):
    """Names written as lines and read as a site list; a name with a comma stays whole."""
    folder = v.work_folder(spark)
    v.faulty_names(spark, d).select(F.concat(F.lit('  "'), "site", F.lit('" ')).alias("value")).write.text(folder)
    return files.read_site_list(spark, folder)

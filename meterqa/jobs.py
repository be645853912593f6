"""Batch jobs, one per report.

    spark-submit -m meterqa.jobs quality --observations obs/ --catalog cat/ --sites sites.csv --out qa/

Prompts of an interactive tool are arguments here. Input tables are parquet.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterqa import schema
from meterqa.functions.calendar import parse_day
from meterqa.functions.names import is_composite
from meterqa.operators import accounts, reporting, series, stored_days
from meterqa.operators.consents import with_dates
from meterqa.plans import reports
from meterqa.session import build_session
from meterqa.sources import archive, files, rejects, tables, versions


def _observations(spark: SparkSession, args) -> DataFrame:
    return tables.read_table(spark, args.observations, schema.OBSERVATIONS)


def _catalog(spark: SparkSession, args, observations: DataFrame) -> DataFrame:
    if args.catalog:
        return tables.read_table(spark, args.catalog, schema.CATALOG)
    return tables.measurement_catalog(observations)


def _archive_sites(spark: SparkSession, args, observations: DataFrame | None) -> DataFrame:
    if args.archive_sites:
        return tables.read_table(spark, args.archive_sites, schema.SITES)
    if observations is None:
        raise ValueError("give --archive-sites or --observations")
    return tables.site_list(observations)


def _consents(spark: SparkSession, path: str) -> DataFrame:
    """Permits; their dates may be stored as dates or as text."""
    return schema.require_columns(
        spark.read.parquet(path),
        "record_number",
        "ext_site_id",
        "from_date",
        "to_date",
        "water_use",
        "consent_status",
        "consented_rate",
        "consented_multiday_volume",
        "consented_multiday_period",
    )


def _requested(spark: SparkSession, args, archive: DataFrame) -> DataFrame | None:
    """The sites asked for: a checked single site, a file, or none for all."""
    if args.site:
        one = spark.createDataFrame([(args.site,)], "site string")
        if series.known_sites(one, archive).isEmpty():
            raise ValueError(f"site {args.site!r} is not in the archive")
        return one
    if args.sites:
        return files.read_site_list(spark, args.sites)
    return None


def reporting_modes(spark: SparkSession, args) -> None:
    obs = _observations(spark, args)
    sites = _requested(spark, args, tables.site_list(obs))
    if args.slice:
        sites = tables.site_slice(sites or tables.site_list(obs), *args.slice)
    files.write_csv(reports.reporting_modes(obs, args.as_of, sites), args.out)


def deliver(spark: SparkSession, args) -> None:
    """Add a delivery to the archive and bring the stored day rows up to date; a job that is repeated changes nothing."""
    archive.deliver(_observations(spark, args), args.archive, args.delivery)
    stored_days.refresh_days(spark, args.archive, args.out, since=args.delivery)


def stored_modes(spark: SparkSession, args) -> None:
    """Reporting modes from stored day rows; no reading is scanned."""
    days = stored_days.stored(spark, args.days)
    days = days.filter(~is_composite(F.col("site")))
    daily = stored_days.counts_per_day(days, schema.COMPLIANCE_VOLUME)
    modes = reporting.pick_modes(reporting.modes_of_days(daily, args.as_of), args.as_of)
    files.write_csv(modes, args.out)


def weekly_report(spark: SparkSession, args) -> None:
    obs = _observations(spark, args)
    modes = files.read_reporting_modes(spark, args.modes)
    table = reports.weekly_missing_report(
        modes, obs, _archive_sites(spark, args, obs), args.week_end
    )
    last = F.coalesce(F.col("last_report").cast("string"), F.lit(schema.UNKNOWN_REPORT))
    table = table.withColumn("last_report", last)
    files.write_csv(table, files.weekly_report_path(args.out, args.week_end))


def recent_plots(spark: SparkSession, args) -> None:
    obs = _observations(spark, args)
    sites = _requested(spark, args, tables.site_list(obs))
    files.write_by_site(reports.daily_plot_table(obs, args.as_of, sites), f"{args.out}/daily")
    files.write_by_site(reports.hourly_plot_table(obs, args.as_of, sites), f"{args.out}/hourly")


def month_plots(spark: SparkSession, args) -> None:
    obs = _observations(spark, args)
    sites = _requested(spark, args, tables.site_list(obs))
    table = reports.month_hourly_table(obs, args.start, sites, args.grain)
    files.write_by_site(table, args.out, by_measurement=True)


def quality(spark: SparkSession, args) -> None:
    obs = _observations(spark, args)
    catalog = _catalog(spark, args, obs)
    sites = _requested(spark, args, catalog.select("site").distinct())
    if sites is None:
        sites = catalog.select("site").distinct()
    report = reports.quality_by_measurement if args.by_measurement else reports.quality_combined
    files.write_csv(report(obs, catalog, sites, args.grain), args.out)


def time_series(spark: SparkSession, args) -> None:
    """Statistics tables (``s``), daily series for plots (``p``) or both (``b``).

    The day rows are written first and everything else is built from them. With ``--accounts`` they must account for every reading.
    """
    obs = _observations(spark, args)
    catalog = _catalog(spark, args, obs)
    sites = _requested(spark, args, catalog.select("site").distinct())
    window = (args.from_date, args.to_date)
    days = reports.stitched_days(obs, catalog, sites, *window, grain=args.grain)
    days.write.mode("overwrite").parquet(f"{args.out}/days")
    days = spark.read.schema(days.schema).parquet(f"{args.out}/days")
    if args.accounts:
        plan = series.stitch_plan(series.process_catalog(tables.for_keys(catalog, "site", sites), *window))
        files.write_csv(accounts.reading_accounts(tables.for_keys(obs, "site", sites), plan, days), args.accounts)
        accounts.require_balance(accounts.read_accounts(spark, args.accounts))
    if args.export in ("s", "b"):
        processed = series.process_catalog(tables.for_keys(catalog, "site", sites), *window)
        sheets = reports.statistics_from_days(days, processed)
        if args.versioned:
            versions.write_report(sheets, f"{args.out}/statistics", files.write_by_site)
        else:
            files.write_statistics(sheets, f"{args.out}/statistics")
    if args.export in ("p", "b"):
        if args.consents:
            consents = with_dates(_consents(spark, args.consents), args.date_format)
            table = reports.daily_series_consent(days, consents)
        else:
            table = reports.daily_series(days)
        files.write_by_site(table, f"{args.out}/series")


def meter_list(spark: SparkSession, args) -> None:
    consents = _consents(spark, args.consents)
    if args.rejects:
        kinds = {"from_date": rejects.DATE, "to_date": rejects.DATE, "ext_site_id": rejects.SITE}
        files.write_csv(rejects.rejected(consents, kinds, ["record_number"], args.date_format), args.rejects)
    obs = _observations(spark, args) if args.observations else None
    archive = _archive_sites(spark, args, obs)
    dates = {"date_formats": args.date_format}
    if args.site_ids:
        keys = files.read_keys(spark, args.site_ids, "ExtSiteID", "ext_site_id")
        table = reports.meters_from_sites(consents, archive, keys, **dates)
    elif args.record_numbers:
        keys = files.read_keys(spark, args.record_numbers, "RecordNumber", "record_number")
        table = reports.meters_from_consents(consents, archive, keys, **dates)
    elif args.where:
        column, _, values = args.where.partition("=")
        ext_sites = spark.read.parquet(args.ext_sites)
        where = {column: values.split(";")}
        table = reports.meters_from_catchment(consents, archive, ext_sites, where, **dates)
    else:
        raise ValueError("give --site-ids, --record-numbers or --where")
    files.write_csv(table, args.out)


def warehouse_daily(spark: SparkSession, args) -> None:
    rows = tables.read_table(spark, args.warehouse, schema.WAREHOUSE)
    sites = files.read_site_list(spark, args.sites) if args.sites else None
    table = reports.warehouse_daily(rows, sites, args.rule, args.grain)
    files.write_csv(table.orderBy("site_id", "date", F.col("data_source")), args.out)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="meterqa.jobs")
    parser.add_argument("--master")
    parser.add_argument("--shuffled-bytes", type=int, help="size of the readings to be shuffled")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name, run, *options, observations="required"):
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run, site=None, sites=None, catalog=None, archive_sites=None)
        if observations:
            sub.add_argument("--observations", required=observations == "required")
        for flag, settings in options:
            sub.add_argument(flag, **settings)
        sub.add_argument("--out", required=True)
        return sub

    site, sites = ("--site", {}), ("--sites", {"help": "CSV, one site per line"})
    catalog, archive = ("--catalog", {}), ("--archive-sites", {})
    grain = ("--grain", {"default": "day", "choices": ["day", "hour", "minute"]})
    as_of = ("--as-of", {"required": True, "type": parse_day})
    week_end = ("--week-end", {"required": True, "type": parse_day})
    start = ("--start", {"required": True, "type": parse_day})
    window = (("--from-date", {"type": parse_day}), ("--to-date", {"type": parse_day}))
    part = ("--slice", {"nargs": 2, "type": int, "help": "site positions, from and to"})
    consents, needed = ("--consents", {}), {"required": True}
    formats = {"nargs": "+", "default": list(schema.CONSENT_DATE_FORMATS)}
    dates = ("--date-format", formats | {"help": "of permit dates that are text; the first that fits"})

    job("reporting-modes", reporting_modes, site, sites, as_of, part)
    delivery = (("--archive", needed), ("--delivery", {"required": True, "type": int}))
    job("deliver", deliver, *delivery)
    job("stored-modes", stored_modes, as_of, ("--days", needed), observations=None)
    job("weekly-report", weekly_report, archive, week_end, ("--modes", needed))
    job("recent-plots", recent_plots, site, sites, as_of)
    job("month-plots", month_plots, site, sites, start, grain)
    job(
        "quality",
        quality,
        site,
        sites,
        catalog,
        grain,
        ("--by-measurement", {"action": "store_true"}),
    )
    export = ("--export", {"default": "b", "choices": ["s", "p", "b"]})
    whole = ("--versioned", {"action": "store_true", "help": "statistics in a folder per run, read through a manifest"})
    balance = ("--accounts", {"help": "folder for what became of every reading; the job fails where some are lost"})
    job("time-series", time_series, site, sites, catalog, consents, dates, grain, export, whole, balance, *window)
    job(
        "meter-list",
        meter_list,
        archive,
        ("--consents", needed),
        ("--site-ids", {}),
        ("--record-numbers", {}),
        ("--where", {"help": "column=value;value"}),
        ("--ext-sites", {}),
        ("--rejects", {"help": "folder for permit values that are no dates or sites"}),
        dates,
        observations="optional",
    )
    rule = ("--rule", {"default": "as_published", "choices": ["as_published", "physical"]})
    job(
        "warehouse-daily",
        warehouse_daily,
        sites,
        grain,
        rule,
        ("--warehouse", needed),
        observations=None,
    )
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"meterqa {args.job}", args.master, args.shuffled_bytes)
    args.run(spark, args)


if __name__ == "__main__":
    main()

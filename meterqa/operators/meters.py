"""Meters that belong to permits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterqa.functions.names import site_id_from_name


def meters_with_site_id(sites: DataFrame) -> DataFrame:
    """Archive names with the site id found in them; names without one go."""
    name = F.col(sites.columns[0])
    return sites.select(
        name.alias("site_name"), site_id_from_name(name).alias("ext_site_id")
    ).na.drop("any")


def consent_meter_join(consents: DataFrame, meters: DataFrame) -> DataFrame:
    """Every permit with every meter of its take point."""
    return consents.join(meters, "ext_site_id")


def first_consent_per_site(consents: DataFrame) -> DataFrame:
    """The first permit of each take point, by number and start.

    ``row_number = 1`` lets Spark keep one row per key and task before the
    shuffle, however many permits a take point has.
    """
    rest = [c for c in consents.columns if c not in ("record_number", "from_date")]
    order = W.partitionBy("ext_site_id").orderBy("record_number", "from_date", *sorted(rest))
    return consents.withColumn("_rn", F.row_number().over(order)).filter("_rn = 1").drop("_rn")


def meter_list(consents: DataFrame, sites: DataFrame) -> DataFrame:
    """One row per meter with the first permit of its take point.

    The first permit depends on the take point only, so it is chosen before
    the join and the join never multiplies rows.
    """
    meters = meters_with_site_id(sites).dropDuplicates(["site_name"])
    return consent_meter_join(first_consent_per_site(consents), meters)

"""Site names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterqa.schema import SITE_ID_PATTERN


def external_site(site: Column) -> Column:
    """Take point of a meter: the text before the first dash."""
    return F.substring_index(site, "-", 1)


def site_id_from_name(site_name: Column) -> Column:
    """Site id found in an archive name, null when there is none."""
    return F.nullif(F.regexp_extract(F.upper(site_name), SITE_ID_PATTERN, 0), F.lit(""))


def looks_like_site_id(name: Column) -> Column:
    return name.rlike(SITE_ID_PATTERN)


def file_safe(site: Column) -> Column:
    return F.translate(site, "/", "-")


def is_composite(site: Column) -> Column:
    """Names that stand for several meters hold a comma."""
    return site.contains(",")

"""Scans of the archive, the permit tables and the warehouse."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterqa.functions.calendar import days_after, midnight_like
from meterqa.functions.names import looks_like_site_id
from meterqa.schema import require_columns

Keys = Sequence[str] | DataFrame


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet table with a declared schema; nothing is inferred from the files."""
    return spark.read.schema(schema).parquet(path)


def for_keys(df: DataFrame, column: str, keys: Keys | None) -> DataFrame:
    """Rows whose ``column`` is among the keys; ``None`` keeps all.

    A list becomes a pushed-down IN filter. A DataFrame (its first column)
    becomes a left-semi join. Spark broadcasts the keys where their measured
    size allows; else it shuffles both sides, after its own join filter (a
    Bloom filter of the keys, at most ``runtime.bloomFilter.maxNumBits``) has
    dropped most other rows at the scan. What a hot key leaves is a skewed
    join, which Spark splits.
    """
    if keys is None:
        return df
    if not isinstance(keys, DataFrame):
        return df.filter(F.col(column).isin(list(keys)))
    wanted = keys.select(F.col(keys.columns[0]).alias(column)).filter(F.col(column).isNotNull())
    if isinstance(wanted.schema[column].dataType, T.StringType):
        # True of every text: Spark makes a join filter only of keys that a comparison restricts.
        wanted = wanted.filter(F.col(column) >= "")
    return df.join(wanted, column, "left_semi")


def as_number(df: DataFrame, column: str) -> Column:
    """A value column as numbers: text is parsed, and what is no number, or NaN, is missing."""
    if isinstance(df.schema[column].dataType, T.StringType):
        value = F.col(column).try_cast("double")
    else:
        value = F.col(column)
        if not isinstance(df.schema[column].dataType, T.FractionalType):
            return value
    return F.when(~F.isnan(value), value).alias(column)


def observations_range(
    observations: DataFrame,
    sites: Keys | None = None,
    measurements: Sequence[str] | None = None,
    from_date: str | dt.date | None = None,
    to_date: str | dt.date | None = None,
    whole_days: bool = False,
) -> DataFrame:
    """Readings of some sites and measurements in a date range.

    The range runs from the first midnight to the last midnight, both included,
    so of the last day only a reading at 00:00 counts. With ``whole_days`` all
    of the last day counts. A value that is NaN, or text that is no number,
    is null.
    """
    require_columns(observations, "site", "measurement", "date_time", "value")
    rows = observations.withColumn("value", as_number(observations, "value"))
    if measurements is not None:
        rows = rows.filter(F.col("measurement").isin(list(measurements)))
    if from_date is not None:
        rows = rows.filter(F.col("date_time") >= midnight_like(rows, "date_time", from_date))
    if to_date is not None:
        if whole_days:
            end = midnight_like(rows, "date_time", days_after(to_date, 1))
            rows = rows.filter(F.col("date_time") < end)
        else:
            rows = rows.filter(F.col("date_time") <= midnight_like(rows, "date_time", to_date))
    return for_keys(rows, "site", sites)


def measurement_catalog(observations: DataFrame) -> DataFrame:
    """Extent of every series held: one row per site and measurement."""
    return observations.groupBy("site", "measurement").agg(
        F.min("date_time").alias("from_ts"), F.max("date_time").alias("to_ts")
    )


def site_list(observations: DataFrame) -> DataFrame:
    return observations.select(F.col("site").alias("site_name")).distinct()


#: Names that cut a table of sites into ranges: the ones of smallest hash. A power of two, less one.
CUTS = 255


def site_slice(sites: DataFrame, start: int, stop: int) -> DataFrame:
    """Sites at positions ``start`` to ``stop - 1`` in name order, nulls first.

    Some names, always the same of the same table, cut it into ranges. Ranges are counted, and only the names of those that
    the slice touches are shuffled and numbered, each range by itself. So a slice deep in a long table meets no task with
    all names before it; what a task holds is one range. Equal names lie in one range, in any order among themselves.
    """
    if start < 0:
        raise ValueError("positions count from 0")
    name = sites.columns[0]
    range_, first, cuts = (_free(sites, c) for c in ("_range", "_first", "_cuts"))
    some = sites.select(F.col(name).alias("n")).filter("n is not null").orderBy(F.xxhash64("n"), "n").limit(CUTS)
    bounds = some.agg(F.sort_array(F.collect_set("n"))).scalar()
    # The number of cuts below the name, found by halving; there are ``CUTS`` at most.
    halves = F.array(*[F.lit(2**i) for i in reversed(range(CUTS.bit_length()))])
    found = F.aggregate(
        halves, F.lit(0), lambda at, half: F.when(F.get(cuts, at + half - 1) < F.col(name), at + half).otherwise(at)
    )
    dealt = sites.withColumn(cuts, bounds).withColumn(range_, found).drop(cuts)
    counts = dealt.groupBy(F.col(range_).alias("r")).agg(F.count(F.lit(1)).alias("n"))
    # One row per range, whatever the table.
    before = W.orderBy("r").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("r", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("f"))
    touched = starts.filter((F.col("f") < stop) & (F.col("f") + F.col("n") > start))
    firsts = touched.agg(F.map_from_entries(F.collect_list(F.struct("r", "f")))).scalar()
    near = dealt.withColumn(first, F.try_element_at(firsts, F.col(range_))).filter(F.col(first).isNotNull())
    at = F.col(first) + F.row_number().over(W.partitionBy(range_).orderBy(name)) - 1
    placed = near.withColumn(first, at).filter(F.col(first).between(start, stop - 1))
    return placed.orderBy(first).select(*sites.columns)


def _free(df: DataFrame, wish: str) -> str:
    while wish in df.columns:
        wish = f"_{wish}"
    return wish


def external_sites(
    ext_sites: DataFrame, where: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Take points with their position and the columns filtered on.

    Only names that look like a site id are kept.
    """
    if where is not None and not isinstance(where, Mapping):
        raise ValueError("where must be None or a mapping of column to values")
    columns = ["ext_site_id", "nztmx", "nztmy"]
    rows = ext_sites
    for column, values in (where or {}).items():
        if column not in columns:
            columns.append(column)
        rows = for_keys(rows, column, values)
    return rows.select(*columns).filter(looks_like_site_id(F.col("ext_site_id")))

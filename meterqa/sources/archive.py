"""An archive of deliveries, laid out by day, in which late and corrected readings are deliveries like others.

A reading counts as its latest delivery has it; a delivery that repeats a time counts its larger value, and one without a value
withdraws the reading. Deliveries and days are folders, so one day is read without the others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterqa import schema
from meterqa.sources.tables import as_number

PARTS = T.StructType(
    [*schema.OBSERVATIONS.fields, T.StructField("delivery", T.IntegerType()), T.StructField("date", T.DateType())]
)


def replace_parts(df: DataFrame, path: str, *parts: str) -> None:
    """Write a table by folders; of an existing table only the folders that ``df`` has are replaced."""
    writer = df.hint("rebalance", *parts).write.mode("overwrite").partitionBy(*parts)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def deliver(readings: DataFrame, path: str, delivery: int) -> None:
    """Add a delivery; to deliver the same number again replaces its days. Readings without a time are in no day."""
    rows = readings.select("site", "measurement", "date_time", as_number(readings, "value").alias("value"))
    rows = rows.filter("date_time is not null").withColumns(
        {"delivery": F.lit(delivery), "date": F.to_date("date_time")}
    )
    replace_parts(rows, path, "delivery", "date")


def _deliveries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PARTS).parquet(path)


def touched_days(spark: SparkSession, path: str, since: int) -> list[dt.date]:
    """The days of the deliveries from number ``since`` on; as many as the calendar has days at most."""
    found = _deliveries(spark, path).filter(F.col("delivery") >= since).select("date").distinct()
    return sorted(r["date"] for r in found.collect())


def current_readings(spark: SparkSession, path: str, days: Sequence[dt.date] | None = None) -> DataFrame:
    """Readings as the latest deliveries have them, of some days or all."""
    rows = _deliveries(spark, path)
    if days is not None:
        rows = rows.filter(F.col("date").isin(list(days)))
    one = rows.groupBy("site", "measurement", "date", "date_time", "delivery").agg(F.max("value").alias("value"))
    latest = one.groupBy("site", "measurement", "date", "date_time").agg(F.max_by("value", "delivery").alias("value"))
    return latest.select("site", "measurement", "date_time", "value")

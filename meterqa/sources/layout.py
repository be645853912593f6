"""An archive laid out for readers of stitched series: months as folders, and buckets by series and day inside them.

A month that no requested series covers is not read; Spark finds the months when the plan is there. The previous
reading needs a series' day in one place, which a bucket is, so readings are not shuffled again. A hot site is spread
over its days. What a task reads is one bucket of the months that are asked for: choose ``buckets`` so that this
fits a task for the longest reports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterqa.operators.lagged import bucket_ends, chain_buckets
from meterqa.operators.series import accepted_measurements, in_segments
from meterqa.schema import WATER_METER
from meterqa.sources.tables import as_number

BUCKET = ["site", "measurement", "date"]


def lay_out(readings: DataFrame, table: str, path: str, buckets: int) -> None:
    """Write the archive as a bucketed table of the session's catalog. Readings without a site, kind or time are in no series."""
    rows = readings.select("site", "measurement", "date_time", as_number(readings, "value").alias("value"))
    rows = rows.filter("site is not null and measurement is not null and date_time is not null")
    rows = rows.withColumn("date", F.to_date("date_time")).withColumn("month", F.trunc("date", "MM"))
    writer = rows.repartition(buckets, *BUCKET).write.mode("overwrite").partitionBy("month")
    writer.bucketBy(buckets, *BUCKET).sortBy(*BUCKET, "date_time").option("path", path).saveAsTable(table)


def months_of_plan(plan: DataFrame) -> DataFrame:
    """The months that a plan takes days from: at most as many rows as the calendar has months."""
    taken = plan.filter("start_date <= end_date")
    first, last = F.trunc("start_date", "MM"), F.trunc("end_date", "MM")
    return taken.select(F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("month")).distinct()


def planned_readings(spark: SparkSession, table: str, plan: DataFrame) -> DataFrame:
    """Readings of the months of a plan; the months are a dynamic filter on folders."""
    return spark.table(table).join(F.broadcast(months_of_plan(plan)), "month", "left_semi")


def laid_out_volumes(spark: SparkSession, table: str, plan: DataFrame) -> DataFrame:
    """Volumes of a stitched plan, as ``volumes.register_to_volume`` gives them, without a shuffle of readings.

    Only the last reading of each series and day leaves its bucket, to be carried to the site's next day.
    """
    rows = accepted_measurements(planned_readings(spark, table, plan))
    ends = in_segments(bucket_ends(rows, BUCKET[:2]), plan, F.col("date"))
    carried = chain_buckets(ends, ["site"]).select(*BUCKET, "segment_no", "carried_value")
    inside = W.partitionBy(*BUCKET).orderBy("date_time")
    stepped = rows.withColumns({"_value": F.lag("value").over(inside), "_first": F.row_number().over(inside) == 1})
    before = F.when(F.col("_first"), F.col("carried_value")).otherwise(F.col("_value"))
    register = F.col("measurement") == WATER_METER
    return stepped.join(carried, BUCKET).select(
        *BUCKET,
        "date_time",
        "value",
        "segment_no",
        F.when(register, F.col("value") - before).otherwise(F.col("value")).alias("vol"),
    )

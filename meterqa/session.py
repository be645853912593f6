"""Session settings for jobs over large archives."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

TARGET_PARTITION_BYTES = 128 * 1024 * 1024

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where the next step then needs another shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A table of requested sites filters a large scan before the shuffle; the filter holds 4 MB at most.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1GB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256MB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "33554432",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "33554432",
    # Call sites of every expression cost more than the planning of a report.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def shuffle_partitions_for(shuffled_bytes: int, cores: int = 1) -> int:
    """Partitions that keep one shuffle task near 128 MB, and at least one per core."""
    return max(cores, math.ceil(shuffled_bytes / TARGET_PARTITION_BYTES), 1)


def build_session(
    app: str = "meterqa",
    master: str | None = None,
    shuffled_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """Session with the defaults above; a cluster's own settings come through ``conf``.

    Adaptive execution merges small shuffle partitions but only splits large
    ones at joins, so over terabytes the initial count must be sized from the input.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if shuffled_bytes:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions_for(shuffled_bytes))
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

"""What became of every reading of a report: an account per series, and a check that none was lost.

The readings are counted at the source, by themselves; the report's side comes from its day rows. Both sides are aggregated to a row
per series (and day) before they meet, so the account costs one pass over the readings and no shuffle of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterqa.operators.day_states import REGISTER
from meterqa.operators.series import accepted_measurements, in_segments
from meterqa.sources.tables import as_number

SERIES = ["site", "measurement"]
COUNTS = ("readings", "planned", "no_value", "kept", "negative", "no_volume")


class ReadingsLost(ValueError):
    """The account of a report does not balance."""


def reading_accounts(observations: DataFrame, plan: DataFrame, days: DataFrame) -> DataFrame:
    """One row per series of the archive or of the report, null sites and kinds included.

    ``readings`` of the series are in the archive, ``planned`` of them on days that the plan takes from it, ``no_value`` of these
    without a number. The report has ``kept`` and ``negative`` volumes; ``no_volume`` are planned readings with a value
    that have neither. Registers have some: the first reading of a site has nothing before it, and a reading
    after one without a value has no difference. ``unexplained`` is what remains; 0 in a report that lost nothing.
    """
    rows = observations.withColumn("value", as_number(observations, "value"))
    by_day = rows.groupBy(*SERIES, F.to_date("date_time").alias("date")).agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("n_values")
    )
    every = by_day.groupBy(*SERIES).agg(F.sum("n").alias("readings"))
    inside = in_segments(accepted_measurements(by_day), plan, F.col("date")).groupBy(*SERIES).agg(
        F.sum("n").alias("planned"), F.sum(F.col("n") - F.col("n_values")).alias("no_value")
    )
    found = days.groupBy(*SERIES).agg(F.sum("reports").alias("kept"), F.sum("negatives").alias("negative"))
    # Stacked and summed, as a null site or kind meets nothing in a join.
    parts = [
        part.select(*SERIES, *[F.col(c) if c in part.columns else F.lit(0).cast("long").alias(c) for c in COUNTS[:-1]])
        for part in (every, inside, found)
    ]
    stacked = parts[0].unionByName(parts[1]).unionByName(parts[2])
    account = stacked.groupBy(*SERIES).agg(*[F.sum(c).alias(c) for c in COUNTS[:-1]])
    account = account.withColumn("no_volume", F.expr("planned - no_value - kept - negative"))
    # One row per series: the window sees a site's few kinds.
    gaps = F.sum("no_value").over(W.partitionBy("site"))
    explained = F.when(F.expr(REGISTER), F.least("no_volume", gaps + 1)).otherwise(F.lit(0))
    explained = F.greatest(explained, F.lit(0))
    return account.withColumn("unexplained", (F.col("no_volume") - explained).cast("long"))


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    """Accounts that were written as CSV."""
    numbers = ", ".join(f"{c} long" for c in (*COUNTS, "unexplained"))
    return spark.read.schema(f"site string, measurement string, {numbers}").option("header", True).csv(path)


def require_balance(accounts: DataFrame, shown: int = 20) -> None:
    """Raise :class:`ReadingsLost`, with the first series, unless every account is explained."""
    wrong = accounts.filter("unexplained != 0").orderBy("site", "measurement").limit(shown).collect()
    if wrong:
        series = ", ".join(f"{r['site']} {r['measurement']}: {r['unexplained']}" for r in wrong)
        raise ReadingsLost(f"readings that the report does not account for: {series}")

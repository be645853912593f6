"""The given tables seen as meter data.

Every view keeps every row. Where a series should hold only part of a table's
rows, the others carry a measurement that the reports do not accept.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterqa.sources.tables import measurement_catalog

MODES_AS_OF = "1998-06-30"
WEEK_END = "1998-06-29"
PLOT_AS_OF = "2024-01-12"
MONTH_START = "2024-01-08"
WINDOW = ("2024-01-05", "2024-01-22")
# The readings of a site lie within one month, so buckets are hours.
GRAIN = "hour"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ext(k: Column) -> Column:
    text = k.cast("string")
    return F.concat(F.lit("BU"), F.lpad(text, 2, "0"), F.lit("/"), F.lpad(text, 4, "0"))


def meter(k: Column) -> Column:
    return F.concat(ext(k), F.lit("-M1"))


def _one_of_ten(k: Column, suffix: str) -> Column:
    """``ext`` of ``k % 10`` by lookup; the big tables need no string building per row."""
    names = F.array(*[F.lit(f"BU{i:02d}/{i:04d}{suffix}") for i in range(10)])
    return names[(k % 10).cast("int")]


def ext_of_ten(k: Column) -> Column:
    return _one_of_ten(k, "")


def meter_of_ten(k: Column) -> Column:
    return _one_of_ten(k, "-M1")


def _at(day: str) -> Column:
    return F.lit(f"{day} 00:00:00").cast("timestamp_ntz")


# Keeps sums of the two-decimal values off rounding ties.
VALUE_SCALE = 1.0372917


def _event_value() -> Column:
    sign = F.when(F.col("event_id") % 40 == 0, -1.0).otherwise(1.0)
    return sign * F.col("value") * F.col("value") * F.lit(VALUE_SCALE)


def readings(spark: SparkSession, sf_dir: str, value: Column | None = None) -> DataFrame:
    """Overlapping series of ten sites within a month; only ``error`` events are of a kind that reports leave out.

    An event outside the days of its own kind is of the kind in use by then.
    """
    kind, ts = F.col("event_type"), F.col("ts")
    in_use = (
        F.when(ts < _at("2024-01-12"), "Compliance Volume")
        .when(ts < _at("2024-01-20"), "Volume")
        .otherwise("Water Meter")
    )
    measurement = (
        F.when(kind == "error", "Stage")
        .when(
            (kind == "purchase") & (ts >= _at("2024-01-08")) & (ts < _at("2024-01-20")), "Volume"
        )
        .when(
            (kind == "signup") & (ts >= _at("2024-01-13")) & (ts < _at("2024-01-16")),
            "Volume [Flow]",
        )
        .when((kind == "view") & (ts >= _at("2024-01-18")), "Water Meter")
        .otherwise(in_use)
    )
    return table(spark, sf_dir, "events").select(
        meter_of_ten(F.col("user_id")).alias("site"),
        measurement.alias("measurement"),
        ts.alias("date_time"),
        (_event_value() if value is None else value).alias("value"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extents of the readings; some series have no stated start."""
    found = measurement_catalog(readings(spark, sf_dir))
    open_start = (F.col("measurement") == "Compliance Volume") & (
        F.substring("site", 3, 2).cast("int") % 5 == 0
    )
    return found.withColumn("from_ts", F.when(~open_start, F.col("from_ts")))


def all_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a volume."""
    return table(spark, sf_dir, "events").select(
        meter_of_ten(F.col("user_id")).alias("site"),
        F.lit("Volume").alias("measurement"),
        F.col("ts").alias("date_time"),
        _event_value().alias("value"),
    )


def warehouse(
    spark: SparkSession,
    sf_dir: str,
    no_source: Column | None = None,
    no_attribute: Column | None = None,
) -> DataFrame:
    attribute = F.create_map(
        *[
            F.lit(x)
            for pair in (
                ("click", "Compliance Volume"),
                ("purchase", "Water Meter"),
                ("view", "Flow"),
                ("signup", "Average Flow"),
                ("error", "Volume"),
            )
            for x in pair
        ]
    )
    kind = attribute[F.col("event_type")]
    source = F.concat(F.lit("S"), (F.col("event_id") % 3).cast("string"))
    return table(spark, sf_dir, "events").select(
        meter_of_ten(F.col("user_id")).alias("site_id"),
        (kind if no_attribute is None else F.when(~no_attribute, kind)).alias("attribute_name"),
        (source if no_source is None else F.when(~no_source, source)).alias("data_source"),
        _event_value().alias("observation_value"),
        F.col("ts").alias("observation_date_time"),
    )


def warehouse_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse with no source for some readings and no attribute for others."""
    no_source, no_attribute = F.col("event_id") % 11 == 4, F.col("event_id") % 13 == 6
    return warehouse(spark, sf_dir, no_source, no_attribute)


def long_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven years of daily volumes; early August is reported on the 13th."""
    shipped = F.to_date("l_shipdate")
    day = F.when(
        (F.month(shipped) == 8) & (F.dayofmonth(shipped) <= 12),
        F.make_date(F.year(shipped), F.lit(8), F.lit(13)),
    ).otherwise(shipped)
    return table(spark, sf_dir, "lineitem").select(
        meter_of_ten(F.col("l_suppkey")).alias("site"),
        F.lit("Volume").alias("measurement"),
        day.cast("timestamp_ntz").alias("date_time"),
        F.col("l_quantity").alias("value"),
    )


def mode_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites that report all year, in one quarter only, or on three days; days fold into the site's quarter."""
    index = F.col("l_suppkey") % 10
    as_of = F.lit(MODES_AS_OF).cast("date")
    age = F.datediff(as_of, F.to_date("l_shipdate"))
    folded = (
        F.when(index <= 4, age)
        .when(index == 5, F.pmod(age, F.lit(91)))
        .when(index == 9, 3 + 100 * F.pmod(age, F.lit(3)))
        .otherwise(92 + 91 * (index - 6) + F.pmod(age, F.lit(90)))
    )
    return table(spark, sf_dir, "lineitem").select(
        meter_of_ten(F.col("l_suppkey")).alias("site"),
        F.lit("Compliance Volume").alias("measurement"),
        F.date_sub(as_of, folded.cast("int")).cast("timestamp_ntz").alias("date_time"),
        F.col("l_quantity").alias("value"),
    )


def deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """``readings`` in three deliveries: most rows, some with a wrong value; the right values; late rows, and others again."""
    rows = readings(spark, sf_dir).withColumn("_h", F.pmod(F.xxhash64("date_time", "site"), F.lit(10)))
    wrong = F.when(F.col("_h") == 3, F.lit(None).cast("double")).otherwise(F.col("value"))
    parts = [
        rows.filter("_h < 8").withColumn("value", wrong),
        rows.filter("_h = 3"),
        rows.filter("_h >= 8 or _h = 1"),
    ]
    return [p.drop("_h") for p in parts]


def work_folder(spark: SparkSession) -> str:
    """A new folder that all executors share: the checkpoint folder, or on a single machine a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='meterqa-')}"
    return f"{folder}/{uuid.uuid4().hex}"


def consents(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = F.col("o_custkey") % 10
    status = (
        F.when((F.col("o_orderstatus") == "F") & (index >= 3), "Issued - Active")
        .when(F.col("o_orderstatus") == "F", "Terminated - Replaced")
        .when(F.col("o_orderstatus") == "O", "Issued - Inactive")
        .otherwise("Terminated - Expired")
    )
    use = F.when(F.col("o_orderpriority") == "1-URGENT", "hydroelectric").when(
        F.col("o_orderpriority") != "2-HIGH", "agriculture"
    )
    starts = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("CRC"), F.col("o_orderkey").cast("string")).alias("record_number"),
        ext_of_ten(F.col("o_custkey")).alias("ext_site_id"),
        starts.alias("from_date"),
        F.date_add(starts, (F.col("o_orderkey") % 3000).cast("int")).alias("to_date"),
        (F.col("o_totalprice") / 1000.0).alias("consented_rate"),
        F.col("o_totalprice").alias("consented_multiday_volume"),
        (1 + index * 3).cast("int").alias("consented_multiday_period"),
        use.alias("water_use"),
        status.alias("consent_status"),
    )


def consents_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The permits with dates as exported text in three forms, a few of them unusable."""
    broken = F.col("record_number").endswith("77")
    last = F.substring("record_number", -1, 1)

    def text(column: str) -> Column:
        return (
            F.when(last < "4", F.date_format(column, "d/MM/yyyy H:mm"))
            .when(last < "7", F.date_format(column, "yyyy-MM-dd"))
            .otherwise(F.date_format(column, "yyyy-MM-dd HH:mm:ss"))
        )

    return consents(spark, sf_dir).withColumns(
        {
            "from_date": text("from_date"),
            "to_date": F.when(broken, "until further notice").otherwise(text("to_date")),
        }
    )


def text_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings with values as exported text, some of them NaN and some no numbers."""
    value = (
        F.when(F.col("event_id") % 17 == 3, "NaN")
        .when(F.col("event_id") % 29 == 5, "gap")
        .otherwise(_event_value().cast("string"))
    )
    return readings(spark, sf_dir, value)


def requested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 sites; the archive holds ten of them."""
    return table(spark, sf_dir, "nation").select(meter(F.col("n_nationkey")).alias("site"))


def faulty_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that stand for two meters, or are no site ids."""
    k = F.col("n_nationkey")
    name = (
        F.when(k % 5 == 4, F.concat(F.lit("X-"), k.cast("string")))
        .when(k % 7 == 6, F.concat(meter(k), F.lit(","), meter(k + 1)))
        .otherwise(meter(k))
    )
    return table(spark, sf_dir, "nation").select(
        name.alias("site"), F.concat(F.lit("Zone "), F.col("n_regionkey").cast("string")).alias(
            "swaz_name"
        ),
        (k * 1000.0).alias("nztmx"),
        (k * 2000.0).alias("nztmy"),
    )


def ext_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Take points; the faulty names are among them."""
    names = faulty_names(spark, sf_dir)
    return names.select(
        F.when(F.col("site").contains(","), F.col("site"))
        .otherwise(F.regexp_replace("site", "-M1$", ""))
        .alias("ext_site_id"),
        "nztmx",
        "nztmy",
        "swaz_name",
    )


def week_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive names for the weekly report: sites with readings, and half of the others."""
    k = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        F.when((k < 10) | (k % 2 == 0), meter(k)).alias("site_name")
    ).na.drop()

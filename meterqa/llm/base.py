"""What the text operators share: tables, written intermediate results, names, row numbers."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: The white space of all operators, as a regular expression class.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CODE = "meterqa-tasks"


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, once per context; functions of ours that run there are found by name."""
    sc = spark.sparkContext
    if f"{CODE}.zip" not in sc._python_includes:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        target = os.path.join(tempfile.mkdtemp(prefix="meterqa-"), CODE)
        sc.addPyFile(shutil.make_archive(target, "zip", root, "meterqa"))


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder for cut lineage; a temporary one only where none is set and all tasks run on this machine, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='meterqa-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame) -> DataFrame:
    """The same rows from a table in the shared folder, so that lost executors repeat nothing before it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused_name(df: DataFrame, wish: str) -> str:
    """``wish``, with underscores before it while the table has such a column in any case."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def numbered(df: DataFrame, keys: list[str], parts: int, order: list[Column], name: str) -> DataFrame:
    """Add a number from 0 without gaps within ``keys``, in the order of the hash of ``order`` columns.

    A key may hold most rows: rows are numbered inside ``parts`` hash parts of each key, and a part starts
    where the counts of the key's earlier parts end. Only those counts meet in one window.
    """
    dealt = df.withColumn("_part", F.pmod(F.xxhash64(*order, F.lit(97)), F.lit(parts)))
    counts = dealt.groupBy(*keys, "_part").agg(F.count("*").alias("_rows"))
    before = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        F.struct(*keys, "_part").alias("_key"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
    )
    inside = W.partitionBy("_key").orderBy(F.xxhash64(*order), *order)
    return (
        dealt.withColumn("_key", F.struct(*keys, "_part"))
        .withColumn("_at", F.row_number().over(inside) - 1)
        .join(starts, "_key")
        .withColumn(name, F.col("_start") + F.col("_at"))
        .drop("_key", "_part", "_at", "_start")
    )

"""Reports of several tables that change as a whole.

Each run writes its tables into a folder of its own and, when all are there, adds one line to the manifest. Readers take the run
of the manifest's last line, so a run that fails half way changes nothing they see. Earlier runs stay until removed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "run long, part string, sheets map<string, string>"


def _save(df: DataFrame, path: str) -> object:
    return df.write.parquet(path)


def _last_run(spark: SparkSession, folder: str) -> tuple[int, str, dict[str, str]] | None:
    """(number, folder, schemas by sheet) of the last whole run; the folder's name decides between two of one number."""
    try:
        lines = spark.read.schema(MANIFEST).json(f"{folder}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    last = lines.select(F.max(F.struct("run", "part")).alias("last"))
    found = lines.join(last, F.struct("run", "part") == F.col("last")).select("run", "part", "sheets").first()
    return (found["run"], found["part"], found["sheets"]) if found else None


def write_report(
    sheets: Mapping[str, DataFrame],
    folder: str,
    save: Callable[[DataFrame, str], object] = _save,
) -> str:
    """Write all ``sheets`` and make them the report of ``folder``; returns the run's folder. One writer at a time.

    ``save`` writes one table as parquet, in folders by columns if it likes.
    """
    if not sheets:
        raise ValueError("a report needs a table")
    folder = folder.rstrip("/")
    spark = next(iter(sheets.values())).sparkSession
    before = _last_run(spark, folder)
    part = f"runs/{uuid.uuid4().hex}"
    for name, df in sheets.items():
        save(df, f"{folder}/{part}/{name}")
    line = (before[0] + 1 if before else 1, part, {name: df.schema.json() for name, df in sheets.items()})
    spark.createDataFrame([line], MANIFEST).coalesce(1).write.mode("append").json(f"{folder}/manifest")
    return f"{folder}/{part}"


def read_report(spark: SparkSession, folder: str, sheet: str) -> DataFrame:
    """One table of the last whole run, in the columns it was given with."""
    folder = folder.rstrip("/")
    last = _last_run(spark, folder)
    if last is None:
        raise ValueError(f"no report in {folder}")
    _, part, sheets = last
    if sheet not in sheets:
        raise ValueError(f"no table {sheet!r} in {folder}; found {sorted(sheets)}")
    schema = T.StructType.fromJson(json.loads(sheets[sheet]))
    return spark.read.schema(schema).parquet(f"{folder}/{part}/{sheet}").select(*schema.names)

"""From raw documents to token sequences, stage by stage.

Each stage works on all that the one before kept. The first four return the columns of ``documents``; the last returns the ids
of each document's pieces beside its other columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterqa.llm import exact_dedup, mixing, near_dedup, pieces, quality
from meterqa.llm.base import table, written


#: Percent of word shingles that near duplicates have in common.
NEAR = 80


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.passing(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.one_of_each(docs, NEAR)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ids = pieces.encoded(docs, ["doc_id", "lang", "source", "n_chars"])
    return ids.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality rules", rules),
    ("exact dedup", exact),
    ("near dedup", near),
    ("source mix", mix),
    ("pieces", encode),
]

#: Outlier estimates, mixing and encoding have no form in SQL; the tests compare all stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs

"""Shards by weighted rendezvous hashing of a stable record key.

Every shard draws an exponential time from the hash of key and shard, divided by its weight; the earliest shard takes
the record. Another shard takes records only into itself, as the other draws do not change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterqa.llm.base import numbered

#: Hash parts in which the rows of a shard are numbered.
PARTS = 1024


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard of ``key``, an int from 0; shards without weight get nothing. A null key is a key like others."""
    draws = []
    for shard, weight in enumerate(weights):
        if weight > 0:
            # 52 bits and a half keep the draw inside (0, 1).
            unit = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 12) + F.lit(0.5)) * F.lit(2.0**-52)
            draws.append(F.struct((-F.log(unit) / F.lit(float(weight))).alias("time"), F.lit(shard).alias("shard")))
    if not draws:
        raise ValueError("no shard has a weight")
    return F.array_min(F.array(*draws))["shard"]


def sharded(
    docs: DataFrame,
    weights: list[float],
    grown: float = 1.0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document: ``id_col``, size, text_crc32, law, shard, slot, grown_shard.

    ``grown_shard`` is the shard once another one of weight ``grown`` has been added. Slots number the rows of a shard from 0
    without gaps. A null text is empty (size 1, checksum 0); rows that repeat an id share a shard and have
    slots of their own; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(F.col(id_col), weights).alias("shard"),
        rendezvous(F.col(id_col), [*weights, grown]).alias("grown_shard"),
    )
    order = [F.col(id_col), F.col("text_crc32"), F.col("size")]
    return numbered(rows, ["shard"], PARTS, order, "slot").select(
        id_col, "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )

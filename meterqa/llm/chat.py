"""Chat logs: collapse cumulative snapshots, then render the conversations that are left.

A chat service logs a conversation after every turn, so most logs are prefixes of later ones. Every turn is hashed with its
place in the conversation; the running XOR of these hashes names the prefix that ends there. A conversation whose whole hash is a proper
prefix of another is dropped by an anti-join, and of equal conversations the smallest id stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterqa.llm.base import written

#: Turns of one conversation that a window holds; longer ones are cut and carried on.
SPAN = 512
ROLE_OPEN, ROLE_CLOSE, TURN_CLOSE = "<|", "|>\n", "<|end|>\n"


def _turns(chats: DataFrame) -> DataFrame:
    """(conv, span, turn, role, text); conv is a struct, so that a null id is a conversation like others."""
    return chats.select(
        F.struct(F.col("conv_id")).alias("conv"),
        F.coalesce(F.floor(F.col("turn") / SPAN), F.lit(-(2**62))).alias("span"),
        "turn",
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def prefix_hashes(chats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(prefixes, wholes): the proper prefixes (n, a, b) of all conversations, and each one's own (conv, n, a, b)."""
    hashed = _turns(chats).select(
        "*", F.xxhash64("role", "text").alias("x"), F.xxhash64("text", "role", F.lit(7)).alias("y")
    )
    # The order in which turns are rendered, ties included.
    inside = W.partitionBy("conv", "span").orderBy("turn", "role", "text")
    counts = hashed.groupBy("conv", "span").agg(F.count("*").alias("n"))
    earlier = W.partitionBy("conv").orderBy("span").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        "conv",
        "span",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"),
        F.sum("n").over(W.partitionBy("conv")).alias("total"),
    )
    # The place in the whole conversation, whatever the numbering.
    placed = hashed.withColumn("row", F.row_number().over(inside)).join(starts, ["conv", "span"])
    keyed = written(
        placed.withColumn("at", F.col("n0") + F.col("row")).select(
            "conv",
            "span",
            "at",
            "total",
            F.xxhash64("x", "at", F.lit(1)).alias("a"),
            F.xxhash64("y", "at", F.lit(2)).alias("b"),
        )
    )
    spans = keyed.groupBy("conv", "span").agg(F.count("*").alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    carried = spans.select(
        "conv",
        "span",
        F.coalesce(F.bit_xor("a").over(earlier), F.lit(0)).alias("a0"),
        F.coalesce(F.bit_xor("b").over(earlier), F.lit(0)).alias("b0"),
    )
    running = W.partitionBy("conv", "span").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    prefixes = (
        keyed.select(
            "conv",
            "span",
            "at",
            "total",
            F.bit_xor("a").over(running).alias("a"),
            F.bit_xor("b").over(running).alias("b"),
        )
        .filter(F.col("at") < F.col("total"))
        .join(carried, ["conv", "span"])
        .select(
            F.col("at").alias("n"),
            F.col("a").bitwiseXOR(F.col("a0")).alias("a"),
            F.col("b").bitwiseXOR(F.col("b0")).alias("b"),
        )
        .distinct()
    )
    wholes = spans.groupBy("conv").agg(F.sum("n").alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    return prefixes, wholes


def maximal(chats: DataFrame) -> DataFrame:
    """(conv, n_turns, n_copies) of the conversations that no other one continues, equal ones once."""
    prefixes, wholes = prefix_hashes(chats)
    distinct = wholes.groupBy("n", "a", "b").agg(F.min("conv").alias("conv"), F.count("*").alias("n_copies"))
    left = distinct.join(prefixes, ["n", "a", "b"], "left_anti")
    return left.select("conv", F.col("n").alias("n_turns"), "n_copies")


def rendered(chats: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies, chat: the text of each maximal conversation, turn by turn.

    Turns are ordered by number; a null number comes first, turns of one number by role and text. A null role is ``unknown``, a
    null text empty. ``<|`` inside a text becomes ``<\\|``, so that no text can pose as a turn. A repeated turn counts as
    another turn. Rows with a null conv_id are one conversation. An empty table gives an empty result.
    """
    safe = F.replace(F.col("text"), F.lit(ROLE_OPEN), F.lit("<\\|"))
    line = F.concat(F.lit(ROLE_OPEN), "role", F.lit(ROLE_CLOSE), safe, F.lit(f"\n{TURN_CLOSE}"))
    kept = _turns(chats).join(maximal(chats), "conv")
    whole = kept.groupBy("conv", "n_turns", "n_copies").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text", line.alias("line")))).alias("lines")
    )
    return whole.select(
        F.col("conv.conv_id").alias("conv_id"),
        "n_turns",
        "n_copies",
        F.concat_ws("", F.col("lines.line")).alias("chat"),
    )

"""Exact duplicates by two passes of a Bloom filter.

The first pass enters the hash of every text into a filter whose cells count to two. In the second pass a text
whose cells have all been entered twice may be repeated; only those rows are shuffled and grouped by SHA-256,
all others pass straight through. A false hit costs a shuffled row, never a wrong result.

The filter has a fixed number of bits (``SEGMENTS * SEGMENT_BITS``, 16 MB), which bounds what is broadcast. Beyond
about a hundred million distinct texts more rows shuffle; the results stay the same. ``segments`` raises it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterqa.llm.base import SPACE, ship_code, unused_name, written

SEGMENTS = 4096
SEGMENT_BITS = 32768
#: A large group's rows meet their group in so many parts.
SALTS = 64


def normalised(text: Column) -> Column:
    """White-space runs become one space; null is the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]+", " ")


def _column(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)


def _entries(segments: int, hashes_of: Callable[[pa.RecordBatch], np.ndarray]):
    """Map tasks: the cells that a task's hashes enter, by segment, and how often, up to 65535."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = [hashes_of(b) for b in batches]
        h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        segment = (h >> np.uint64(45)) % np.uint64(segments) * np.uint64(SEGMENT_BITS)
        probes = np.stack([segment + ((h >> np.uint64(15 * i)) & np.uint64(SEGMENT_BITS - 1)) for i in range(3)])
        probes.sort(axis=0)
        fresh = np.ones(probes.shape, bool)
        fresh[1:] = probes[1:] != probes[:-1]  # one hash enters a cell once
        cells, times = np.unique(probes[fresh], return_counts=True)
        owner, offset = cells // SEGMENT_BITS, (cells % SEGMENT_BITS).astype("<u2")
        times = np.minimum(times, 65535).astype("<u2")
        edges = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1], True]) if len(cells) else np.zeros(1, int)
        for at in range(0, len(edges) - 1, 1024):
            some = list(zip(edges[at : at + 1025], edges[at + 1 : at + 1025], strict=False))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(owner[a]) for a, _ in some], pa.int64()),
                    pa.array([offset[a:b].tobytes() for a, b in some], pa.binary()),
                    pa.array([times[a:b].tobytes() if (times[a:b] > 1).any() else b"" for a, b in some], pa.binary()),
                ],
                names=["segment", "cells", "times"],
            )

    return entries


def _merged(least: int, many: int | None):
    """Reduce tasks: rows come sorted by segment, so one segment's counts are held at a time."""

    def bits(counts: np.ndarray, least: int) -> pa.Array:
        some = counts >= least
        words = [np.packbits(some, bitorder="little").view("<i8").tolist()] if some.any() else [None]
        return pa.array(words, pa.list_(pa.int64()))

    def packed(segment: int, counts: np.ndarray) -> pa.RecordBatch:
        columns = {"segment": pa.array([segment], pa.int64()), "words": bits(counts, least)}
        return pa.RecordBatch.from_pydict(columns | ({"often": bits(counts, many)} if many else {}))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts = None, None
        for batch in batches:
            for segment, cells, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if segment != held:
                    if held is not None and (counts >= least).any():
                        yield packed(held, counts)
                    held, counts = segment, np.zeros(SEGMENT_BITS, np.int64)
                counts[np.frombuffer(cells, "<u2")] += np.frombuffer(times, "<u2") if times else 1
        if held is not None and (counts >= least).any():
            yield packed(held, counts)

    return merged


def repeated_cells(
    hashes: DataFrame,
    segments: int = SEGMENTS,
    least: int = 2,
    many: int | None = None,
    hashes_of: Callable[[pa.RecordBatch], np.ndarray] = _column,
) -> DataFrame:
    """First pass over a column of 64-bit hashes: (segment, words) with the bits of cells entered ``least`` times or more.

    ``hashes_of`` gives the hashes of a batch where they are not a column yet.
    With ``many``, also ``often``: the bits of cells entered so many times or more, null where a segment has none.
    """
    ship_code(hashes.sparkSession)
    entered = hashes.mapInArrow(_entries(segments, hashes_of), "segment long, cells binary, times binary")
    dealt = entered.repartition("segment").sortWithinPartitions("segment")
    fields = "segment long, words array<long>" + (", often array<long>" if many else "")
    return dealt.mapInArrow(_merged(least, many), fields)


def possibly_repeated(df: DataFrame, hash_col: str, cells: DataFrame, segments: int, flag: str) -> DataFrame:
    """Second pass: add ``flag``, true where all cells of the hash have been entered twice."""
    h = F.col(hash_col)
    segment = F.pmod(F.shiftrightunsigned(h, 45), F.lit(segments))
    probes = [F.shiftrightunsigned(h, 15 * i).bitwiseAND(F.lit(SEGMENT_BITS - 1)) for i in range(3)]
    hit = F.lit(True)
    for at in probes:
        word = F.get("_words", F.shiftright(at, 6).cast("int"))
        hit = hit & (F.getbit(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1)
    # The filter's size is fixed, so it may be broadcast whatever the input.
    filter_ = F.broadcast(cells.select(F.col("segment").alias("_segment"), F.col("words").alias("_words")))
    joined = df.join(filter_, segment == F.col("_segment"), "left")
    return joined.select(*[df[c] for c in df.columns], F.coalesce(hit, F.lit(False)).alias(flag))


def possibly_entered(
    df: DataFrame, hash_col: str, entered: DataFrame, segments: int = SEGMENTS // 4, flag: str | None = None
) -> DataFrame:
    """Rows of ``df`` whose hash may be among ``entered`` (one column of hashes); with ``flag``, all rows and that column."""
    cells = written(repeated_cells(entered, segments, least=1))
    flagged = possibly_repeated(df, hash_col, cells, segments, flag or "_entered")
    return flagged if flag else flagged.filter("_entered").drop("_entered")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segments: int = SEGMENTS) -> DataFrame:
    """One row per document: ``id_col``, keep_id, group_size, kept, text_sha256.

    Texts are equal when equal after ``normalised``; null equals the empty text. The smallest id of a group stays, a null
    id after all others. Rows that repeat an id and a text are separate rows of the group, of which one stays. An
    empty table gives an empty result; other columns are not read.
    """
    text = normalised(F.col(text_col))
    rows = written(
        docs.select(
            F.col(id_col).alias("_id"),
            F.sha2(text, 256).alias("_sha"),
            F.xxhash64(text).alias("_hash"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    flagged = possibly_repeated(rows, "_hash", repeated_cells(rows.select("_hash"), segments), segments, "_maybe")
    order = F.struct(F.isnull("_id").alias("no_id"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    several = flagged.filter("_maybe").withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(SALTS)))
    groups = several.groupBy("_sha").agg(F.min(order).alias("_keep"), F.count("*").alias("_size"))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    spread = groups.withColumn("_salt", salts)
    met = several.join(spread, ["_sha", "_salt"]).select(
        F.col("_id").alias(id_col),
        F.col("_keep.id").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_keep.row") == F.col("_row")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )
    alone = flagged.filter(~F.col("_maybe")).select(
        F.col("_id").alias(id_col),
        F.col("_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )
    return alone.unionByName(met)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segments: int = SEGMENTS) -> DataFrame:
    """The documents without exact copies, in their own columns; of a group one row with the smallest id stays.

    Whole rows are shuffled only where the filter holds their text for possibly repeated; those are reduced to one
    row per group before the shuffle.
    """
    columns = docs.columns
    hashed, maybe, sha, row = (unused_name(docs, n) for n in ("_hash", "_maybe", "_sha", "_whole"))
    text = normalised(F.col(text_col))
    rows = docs.withColumn(hashed, F.xxhash64(text))
    flagged = possibly_repeated(rows, hashed, repeated_cells(rows.select(hashed), segments), segments, maybe)
    alone = flagged.filter(~F.col(maybe)).select(*columns)
    best = F.min_by(F.struct(*columns), F.struct(F.isnull(id_col), F.col(id_col)))
    groups = flagged.filter(maybe).groupBy(F.sha2(text, 256).alias(sha)).agg(best.alias(row))
    return alone.unionByName(groups.select(*[F.col(row)[c].alias(c) for c in columns]))

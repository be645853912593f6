"""Removal of repeated substrings, by difference-cover suffix sorting of blocks.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts elsewhere in the corpus. All places would be too many to
sort or ship, so the work is cut by content, without loss:

1. Exact copies of a text count as one text with a number of copies; if it is long enough, it goes whole.
2. Every string has an anchor: of the ``GRAM``-byte strings in it, the first with the least hash. Equal strings have equal anchors at the
   same place, so a string whose anchor occurs once is alone. A first pass enters all anchors into a Bloom filter of fixed size
   with counts, a second keeps those entered twice; false hits cost only work.
3. For runs of strings with one anchor the text around it (a context) is shuffled by the anchor, equal contexts of a task once. Tasks
   sort the suffixes of a block of whole anchors at a time (``suffixes``), which bounds memory, and report strings found twice.
4. An anchor with very many places is crowded. Equal contexts of it are made one, whatever task they are in; if more than ``MANY`` are left,
   each is split in two: the strings that reach far to the left of the anchor, and those that reach far to the right. Equal strings fall
   on the same side and share more bytes beside the anchor, which part the context anew. Parts that are equal become one again,
   and so on until a block holds what is left of an anchor; at the last the strings themselves are parted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterqa.llm.arrow_text import text_runs
from meterqa.llm.base import written
from meterqa.llm.exact_dedup import SEGMENT_BITS, SEGMENTS, possibly_entered, possibly_repeated, repeated_cells
from meterqa.llm.lookup import mixed
from meterqa.llm.suffixes import repeated

LENGTH = 200
GRAM = 64
MANY = 4096
#: Bytes of contexts whose suffixes are sorted together.
BLOCK_BYTES = 1 << 20
#: A longer text is handled in pieces, which share strings' bytes but not strings.
PIECE_BYTES = 1 << 20
#: Bytes of short texts that are handled together.
RUN_BYTES = 1 << 18
_random = np.random.default_rng(7)
_BYTES = _random.integers(0, 2**64, (2, 256), np.uint64)
_BASES = [int(b) * 2 + 1 for b in _random.integers(0, 2**63, 2)]


class _Hashes:
    """Hashes of any substrings of one array of bytes, from prefix sums of a polynomial."""

    powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, which: int):
        n = len(data) + 1
        base = _BASES[which]
        power, inverse = self.powers.get(which, (np.ones(1, np.uint64), np.ones(1, np.uint64)))
        while len(power) < n:
            up, down = pow(base, len(power), 2**64), pow(base, -len(power), 2**64)
            power = np.concatenate([power, power * np.uint64(up)])
            inverse = np.concatenate([inverse, inverse * np.uint64(down)])
        self.powers[which] = power, inverse
        self.inverse = inverse
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(_BYTES[which][data] * power[: n - 1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start])

    def grams(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:n]) * self.inverse[:n])


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` successive values: least of a block's end and of the next block's start."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    before = np.minimum.accumulate(grid, axis=1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - width + 1
    return np.minimum(after[:count], before[width - 1 : width - 1 + count])


def anchored(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first start, start after the last, anchor, hash of the anchor) of the runs of strings with one anchor."""
    none = np.empty(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none, none.view(np.uint64)
    grams = _Hashes(data, 0).grams(GRAM)
    bits = len(data).bit_length()
    # The place in the low bits makes the first of equal hashes the least.
    keyed = grams >> np.uint64(bits) << np.uint64(bits) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_least_of(keyed, LENGTH - GRAM + 1) & np.uint64((1 << bits) - 1)).astype(np.int64)
    text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = text_of[: len(anchor)] == text_of[LENGTH - 1 :]
    edge = np.ones(len(anchor), bool)
    edge[1:] = (anchor[1:] != anchor[:-1]) | ~inside[:-1] | (text_of[1 : len(anchor)] != text_of[: len(anchor) - 1])
    first = np.flatnonzero(edge & inside)
    ends = np.r_[np.flatnonzero(edge | ~inside), len(anchor)]
    after = ends[np.searchsorted(ends, first, "right")]
    return text_of[first], first, after, anchor[first], grams[anchor[first]]


def _pieces(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(first row, offsets, bytes, bytes of the first row before these); long texts come in overlapping pieces."""
    for first, _, offsets, data in text_runs(column, RUN_BYTES):
        if len(offsets) == 2 and len(data) > PIECE_BYTES:
            for at in range(0, len(data) - LENGTH + 1, PIECE_BYTES):
                part = data[at : at + PIECE_BYTES + LENGTH - 1]
                yield first, np.array([0, len(part)]), part, at
        else:
            yield first, offsets, data, 0


def _anchor_hashes(batch: pa.RecordBatch) -> np.ndarray:
    found = [anchored(offsets, data)[4] for _, offsets, data, _ in _pieces(batch.column(0))]
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def _probes(h: np.ndarray, segments: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, bit) of each of a hash's cells, as in ``possibly_repeated``."""
    segment = ((h >> np.uint64(45)) % np.uint64(segments)).astype(np.int64) * (SEGMENT_BITS // 64)
    for i in range(3):
        cell = (h >> np.uint64(15 * i)) & np.uint64(SEGMENT_BITS - 1)
        yield segment + (cell >> np.uint64(6)).astype(np.int64), cell & np.uint64(63)


class CellBits:
    """Bits of a filter of fixed size, held by the driver and every task."""

    def __init__(self, cells: DataFrame, column: str, segments: int):
        self.segments = segments
        self.words = np.zeros(segments * SEGMENT_BITS // 64, np.uint64)
        found = cells.select("segment", column).toArrow()
        for segment, words in zip(found.column(0).to_pylist(), found.column(1).to_pylist(), strict=True):
            at = segment * SEGMENT_BITS // 64
            self.words[at : at + SEGMENT_BITS // 64] = np.array(words, np.int64).view(np.uint64)

    def has(self, h: np.ndarray) -> np.ndarray:
        hit = np.ones(len(h), bool)
        for word, bit in _probes(h, self.segments):
            hit &= (self.words[word] >> bit) & np.uint64(1) == 1
        return hit


CONTEXT = "key long, c long, d long, s long, t long, at long, n long, p long, times long, many boolean, context binary"


def _contexts(filters):
    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice, often = filters.value
        for batch in batches:
            s, t, times = (batch.column(i).to_numpy() for i in (1, 2, 3))
            for row, offsets, data, before in _pieces(batch.column(0)):
                text, first, after, anchor, h = anchored(offsets, data)
                some = np.flatnonzero(twice.has(h))
                if not len(some):
                    continue
                text, first, after, anchor, h = text[some], first[some], after[some], anchor[some], h[some]
                end = after - 1 + LENGTH
                shape = mixed(((anchor - first) * 1024 + (after - first)).astype(np.uint64))
                c = _Hashes(data, 0).of(first, end) + shape
                d = _Hashes(data, 1).of(first, end) ^ shape
                # One of a task's equal contexts carries the bytes, and how often it occurred.
                _, lead, which = np.unique(c, return_index=True, return_inverse=True)
                occurred = np.bincount(which, weights=times[row + text].astype(float)).astype(np.int64)
                carries = np.zeros(len(c), bool)
                carries[lead] = True
                carries |= d != d[lead][which]
                size = np.where(carries, end - first, 0)
                ends = np.r_[0, np.cumsum(size)]
                source = np.arange(ends[-1]) + np.repeat(first - ends[:-1], size)
                buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data[source])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h.view(np.int64)),
                        pa.array(c.view(np.int64)),
                        pa.array(d.view(np.int64)),
                        pa.array(s[row + text]),
                        pa.array(t[row + text]),
                        pa.array(first - offsets[text] + before),
                        pa.array(after - first),
                        pa.array(anchor - first),
                        pa.array(np.where(carries, occurred[which], 0)),
                        pa.array(often.has(h)),
                        pa.Array.from_buffers(pa.binary(), len(h), buffers),
                    ],
                    names=[x.split()[0] for x in CONTEXT.split(", ")],
                )

    return contexts


def _runs(flags: np.ndarray, owner: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, first, after) of the maximal runs of set flags within each owner."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at, at
    new = np.r_[True, (np.diff(at) > 1) | (owner[at][1:] != owner[at][:-1])]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(at) - 1]
    return owner[at[new]], inside[at[new]], inside[at[last]] + 1


FOUND = "c long, d long, first long, after long"


def _sorted_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by anchor; whole anchors are gathered to a block, and its suffixes sorted."""
    rows: list[tuple] = []
    held, size = None, 0

    def found() -> Iterator[pa.RecordBatch]:
        c, d, n, times = (np.array([r[i] for r in rows], np.int64) for i in range(4))
        lengths = np.array([len(r[4]) for r in rows], np.int64)
        text = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
        owner = np.repeat(np.arange(len(rows)), n)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        starts = (np.cumsum(lengths) - lengths)[owner] + inside
        flags = repeated(text, starts, LENGTH) | (times > 1)[owner]
        who, first, after = _runs(flags, owner, inside)
        if len(who):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[who]), pa.array(d[who]), pa.array(first), pa.array(after)], names=["c", "d", "first", "after"]
            )

    alone = 0  # rows of the anchor at hand
    for batch in batches:
        for key, *row in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if key != held:
                if alone == 1 and rows[-1][3] == 1:
                    size -= len(rows.pop()[4])  # an anchor with one context that occurred once
                if size >= BLOCK_BYTES:
                    yield from found()
                    rows, size = [], 0
                held, alone = key, 0
            rows.append(row)
            size += len(row[4])
            alone += 1
    if alone == 1 and rows[-1][3] == 1:
        rows.pop()
    if rows:
        yield from found()


#: Places that a string of one anchor may begin at, counted back from the anchor.
REACH = LENGTH - GRAM
PART = "key long, c long, d long, n long, p long, low long, high long, times long, context binary, of_c long, of_d long, base long"


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts in two parts each, named by their bytes; a part's key is the hash of the bytes that all its strings have.

    The strings of a context begin ``low`` to ``high`` bytes before the anchor, or fewer of these; ``p`` is the anchor's place in it.
    """
    for batch in batches:
        out: list[tuple] = []
        for c, d, n, p, low, high, times, context in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            middle = low + (high - low + 1) // 2
            data = np.frombuffer(context, np.uint8)
            hashes = [_Hashes(data, i) for i in (0, 1)]
            for least, most in ((middle, high), (low, middle - 1)):
                first, last = max(p - most, 0), min(p - least, n - 1)
                if first > last:
                    continue
                end = last + LENGTH
                core = p - least, p + LENGTH - most
                shape = (p - first) * 1024 + last - first + 1
                at = np.array([first, core[0]]), np.array([end, core[1]])
                own = [mixed(h.of(*at) + np.uint64(shape * 1048576 + least * 1024 + most)) for h in hashes]
                key = mixed(hashes[0].of(*at) + np.uint64(least * 1024 + most))
                out.append(
                    (
                        *(x.view(np.int64) for x in (key[1:], own[0][:1], own[1][:1])),
                        (last - first + 1, p - first, least, most, times),
                        context[first:end],
                        (c, d, first),
                    )
                )
        if not out:
            continue
        numbers = np.array([[k[0], a[0], b[0], *shape, *of] for k, a, b, shape, _, of in out], np.int64).T
        names = [x.split()[0] for x in PART.split(", ")]
        columns = [pa.array(x) for x in numbers]
        columns.insert(8, pa.array([r[4] for r in out], pa.binary()))
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _marked_crowds(crowded: DataFrame, many: int) -> DataFrame:
    """(c, d, first, after) of the strings found twice in the contexts (key, c, d, n, p, times, context) of crowded anchors."""
    named = ["key", "c", "d", "n", "p", "low", "high"]
    whole = crowded.withColumns({"low": F.lit(0).cast("long"), "high": F.lit(REACH).cast("long")})
    parts = written(whole.groupBy(*named).agg(F.sum("times").alias("times"), F.first("context").alias("context")))
    levels: list[tuple[DataFrame, DataFrame]] = []
    while True:
        sizes = parts.groupBy("key").agg(F.count("*").alias("size"))
        sized = written(parts.join(sizes, "key").withColumn("crowd", F.col("size") > many))
        few = sized.filter("not crowd").select("key", "c", "d", "n", "times", "context")
        found = written(few.repartition("key").sortWithinPartitions("key").mapInArrow(_sorted_blocks, FOUND))
        crowd = sized.filter("crowd")
        if crowd.isEmpty():
            break
        # A part of one string per context has a key of its own, so this ends.
        split = written(crowd.select(*named[1:], "times", "context").mapInArrow(_split, PART))
        levels.append((found, split.select("c", "d", "of_c", "of_d", "base")))
        parts = written(split.groupBy(*named).agg(F.sum("times").alias("times"), F.first("context").alias("context")))
    for before, links in reversed(levels):
        up = links.join(found, ["c", "d"]).select(
            F.col("of_c").alias("c"), F.col("of_d").alias("d"), (F.col("base") + F.col("first")).alias("first"), (F.col("base") + F.col("after")).alias("after")
        )
        found = before.unionByName(up)
    return found


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the union of their spans."""
    for whole in batches:
        for batch in (whole.slice(at, 256) for at in range(0, len(whole), 256)):
            kept, removed, spans = [], [], []
            for text, firsts, afters in zip(*(x.to_pylist() for x in batch.columns[:3]), strict=True):
                data = text.encode()
                order = np.argsort(np.array(firsts, np.int64), kind="stable")
                first = np.array(firsts, np.int64)[order]
                reach = np.maximum.accumulate(np.array(afters, np.int64)[order])
                new = np.r_[True, first[1:] > reach[:-1]]
                starts, ends = first[new], reach[np.r_[np.flatnonzero(new)[1:] - 1, len(first) - 1]]
                kept.append(b"".join(data[a:b] for a, b in zip([0, *ends], [*starts, len(data)], strict=True)))
                removed.append(int((ends - starts).sum()))
                spans.append(len(starts))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[3:],
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.int64()),
                    pa.array(kept, pa.binary()),
                ],
                names=[*batch.schema.names[3:], "n_removed", "n_spans", "kept"],
            )


def _named(docs: DataFrame) -> DataFrame:
    """(text, s, t): the texts, null as empty, and two hashes of each."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(text.alias("text"), F.xxhash64(text).alias("s"), F.xxhash64(text, F.lit(3)).alias("t"))


def repeated_spans(docs: DataFrame, segments: int = SEGMENTS, many: int = MANY) -> DataFrame:
    """(s, t, first, after): byte spans to remove, for each distinct text by its hashes; spans may overlap."""
    spark = docs.sparkSession
    named = _named(docs).filter(F.octet_length("text") >= LENGTH)
    cells = written(repeated_cells(named.select("s"), segments))
    flagged = possibly_repeated(named, "s", cells, segments, "_maybe")
    several = flagged.filter("_maybe").groupBy("s", "t").agg(F.first("text").alias("text"), F.count("*").alias("times"))
    several = written(several.select("text", "s", "t", "times"))
    alone = flagged.filter("not _maybe").select("text", "s", "t", F.lit(1).cast("long").alias("times"))
    distinct = alone.unionByName(several)
    counted = written(repeated_cells(distinct.select("text"), segments, many=many, hashes_of=_anchor_hashes))
    filters = spark.sparkContext.broadcast(
        (CellBits(counted, "words", segments), CellBits(counted.filter("often is not null"), "often", segments))
    )
    contexts = written(distinct.mapInArrow(_contexts(filters), CONTEXT))
    carried = contexts.filter("times > 0")
    few = carried.filter("not many").select("key", "c", "d", "n", "times", "context")
    found = few.repartition("key").sortWithinPartitions("key").mapInArrow(_sorted_blocks, FOUND)
    crowds = _marked_crowds(carried.filter("many").select("key", "c", "d", "n", "p", "times", "context"), many)
    marked = found.unionByName(crowds).distinct()
    places = contexts.select("c", "d", "s", "t", "at")
    spans = places.join(marked, ["c", "d"]).select(
        "s", "t", (F.col("at") + F.col("first")).alias("first"), (F.col("at") + F.col("after") - 1 + LENGTH).alias("after")
    )
    whole = several.filter("times > 1").select(
        "s", "t", F.lit(0).cast("long").alias("first"), F.octet_length("text").cast("long").alias("after")
    )
    return spans.unionByName(whole)


def without_repeats(docs: DataFrame, segments: int = SEGMENTS, many: int = MANY) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept (the bytes that are left).

    A null text is empty. Texts shorter than ``LENGTH`` bytes stay whole. Equal texts, also of rows that repeat an id, lose the same
    bytes. An empty table gives an empty result; only doc_id and text are read.
    """
    spans = repeated_spans(docs, segments, many)
    by_text = written(
        spans.distinct().groupBy("s", "t").agg(F.collect_list("first").alias("firsts"), F.collect_list("after").alias("afters"))
    )
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        text.alias("text"),
        F.xxhash64(text).alias("s"),
        F.xxhash64(text, F.lit(3)).alias("t"),
        F.col("doc_id").alias("id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    flagged = possibly_entered(rows, "s", by_text.select("s"), flag="_maybe")
    met = flagged.filter("_maybe").join(by_text, ["s", "t"], "left")
    zero = F.lit(0).cast("long")
    straight = flagged.filter("not _maybe").select("id", "n_bytes", "text")
    straight = straight.union(met.filter("firsts is null").select("id", "n_bytes", "text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = met.filter("firsts is not null").select("text", "firsts", "afters", "id", "n_bytes")
    cut = cut.mapInArrow(_cut, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
    same = straight.select(
        "id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), F.col("text").cast("binary").alias("kept")
    )
    return same.unionByName(cut).withColumnRenamed("id", "doc_id")

"""SentencePiece encoding with seeded merge dropout, and decoding.

Encoding starts from characters and takes, from an agenda of adjacent pairs, the pair that forms the best-scored piece,
leftmost first. A candidate merge is skipped for good when the hash of seed, document and the candidate's place (start, middle and
end) falls below the dropout rate; so a document's segmentation depends on its id and the seed alone, never on its task,
and all segmentations decode to the same text. Without dropout the result is that of the library.

Pieces never hold a space after another character, so a text falls into units that no merge crosses. Tasks process all units of
a run of documents together: each step merges the best pair of every unit. Units of more than ``LONGEST`` characters go
through an agenda of their own.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterqa.llm.arrow_text import text_runs
from meterqa.llm.base import ship_code
from meterqa.llm.lookup import HashIndex, mixed

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 20
LONGEST = 40
RUN = 1 << 19
SPACE = 0x2581
NONE, ABSENT = -1, -2
# Odd numbers that spread a candidate's start, middle and end.
SPREAD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
MASK = (1 << 64) - 1


@dataclass
class Vocabulary:
    pieces: list[str]
    scores: list[float]
    is_byte: list[bool]
    special: list[bool]

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        return cls(
            [model.id_to_piece(i) for i in ids],
            [model.get_score(i) for i in ids],
            [model.is_byte(i) for i in ids],
            [model.is_control(i) or model.is_unknown(i) for i in ids],
        )


class Codec:
    """Tables of a vocabulary, with the encoder and the decoder."""

    def __init__(self, vocabulary: Vocabulary, dropout: float = DROPOUT, seed: int = SEED):
        v = vocabulary
        self.seed, self.threshold = seed, np.uint64(int(dropout * 2**32))
        plain = {p: i for i, p in enumerate(v.pieces) if not (v.is_byte[i] or v.special[i])}
        self.byte_ids = np.array([v.pieces.index(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.char_ids = np.full(0x110000, NONE, np.int32)
        for piece, i in plain.items():
            if len(piece) == 1:
                self.char_ids[ord(piece)] = i
        scores = np.array(v.scores)
        # Pieces of equal score share a rank, so that the leftmost of them goes first.
        _, rank = np.unique(-scores, return_inverse=True)
        # Two bytes are enough for most vocabularies.
        self.kind = np.uint16 if len(scores) < 2**16 - 1 else np.uint32
        self.never = np.iinfo(self.kind).max
        self.rank_of = rank.astype(self.kind)
        self.piece_of = np.full(rank.max() + 1, NONE, np.int32)
        shared = np.bincount(rank)[rank] > 1
        self.piece_of[rank[~shared]] = np.flatnonzero(~shared)
        pairs = {}
        for piece, i in plain.items():
            for cut in range(1, len(piece)):
                left, right = plain.get(piece[:cut]), plain.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i
        keys = np.array(sorted(pairs), np.uint64)
        self.pairs, self.index = pairs, HashIndex(keys)
        self.merged = np.array([pairs[int(k)] for k in keys], np.int32)
        raw = [
            bytes([int(p[3:5], 16)]) if byte else b"" if special else p.replace("▁", " ").encode()
            for p, byte, special in zip(v.pieces, v.is_byte, v.special, strict=True)
        ]
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_size = np.array([len(r) for r in raw], np.int64)
        self.raw_at = np.concatenate([[0], np.cumsum(self.raw_size)])

    def _ranks(self, left, right, unit, start, middle, end) -> np.ndarray:
        """Ranks of candidate merges; ``never`` where there is no such piece or the candidate is skipped."""
        place = self.index.find((left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64))
        ranks = np.full(len(place), self.never, self.kind)
        some = np.flatnonzero(place >= 0)
        if self.threshold:
            key = unit[some]
            for at, spread in zip((start, middle, end), SPREAD, strict=True):
                key = key + at[some].astype(np.uint64) * np.uint64(spread)
            some = some[(mixed(key) >> np.uint64(32)) >= self.threshold]
        ranks[some] = self.rank_of[self.merged[place[some]]]
        return ranks

    def _skipped(self, unit: int, start: int, middle: int, end: int) -> bool:
        if not self.threshold:
            return False
        x = (unit + start * SPREAD[0] + middle * SPREAD[1] + end * SPREAD[2]) & MASK
        x ^= x >> 30
        x = x * 0xBF58476D1CE4E5B9 & MASK
        x ^= x >> 27
        x = x * 0x94D049BB133111EB & MASK
        x ^= x >> 31
        return x >> 32 < int(self.threshold)

    def agenda(self, chars: list[int], unit: int) -> list[tuple[int, int]]:
        """(place, piece) of one unit, one candidate after another."""
        piece = list(chars)
        after = list(range(1, len(chars))) + [-1]
        before = list(range(-1, len(chars) - 1))
        end = list(range(1, len(chars) + 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def candidate(left: int, right: int) -> None:
            merged = self.pairs.get(piece[left] << 32 | piece[right])
            if merged is not None:
                heapq.heappush(heap, (int(self.rank_of[merged]), left, right, end[right], merged))

        for i in range(len(chars) - 1):
            candidate(i, i + 1)
        while heap:
            _, left, right, until, merged = heapq.heappop(heap)
            if piece[left] < 0 or after[left] != right or end[right] != until:
                continue
            if self.pairs.get(piece[left] << 32 | piece[right]) != merged or self._skipped(unit, left, right, until):
                continue
            piece[left], piece[right], end[left] = merged, NONE, until
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
                candidate(left, after[left])
            if before[left] >= 0:
                candidate(before[left], left)
        return [(i, p) for i, p in enumerate(piece) if p >= 0]

    def encode(self, keys: np.ndarray, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of the texts' ids and the ids; ``keys`` are 64-bit hashes of the documents' ids."""
        n_docs = len(offsets) - 1
        heads = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
        edges = heads[offsets]
        code = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        sizes = np.diff(edges)
        led = sizes > 0  # a text that is not empty gets a space before it
        starts = edges[:-1] + np.r_[0, np.cumsum(led)][:-1]
        chars = np.full(len(code) + int(led.sum()), SPACE, np.uint32)
        doc_of = np.repeat(np.arange(n_docs), sizes + led)
        own = np.arange(len(code)) + np.repeat(np.cumsum(led), sizes)
        chars[own] = np.where(code == 0x20, np.uint32(SPACE), code)
        ids = self.char_ids[chars]
        ids[own[code == SPACE]] = NONE  # a literal space sign is spelled in bytes, as it would decode to a space
        blank, odd = (chars == SPACE) & (ids != NONE), ids == NONE
        first = np.ones(len(ids), bool)
        first[1:] = (blank[1:] & ~blank[:-1]) | odd[1:] | odd[:-1]
        first[starts[led]] = True
        unit_at = np.flatnonzero(first)
        size = np.diff(np.r_[unit_at, len(ids)])
        doc = doc_of[unit_at]
        with np.errstate(over="ignore"):
            salt = np.uint64(self.seed * SPREAD[0] & MASK)
            unit = mixed(mixed(keys[doc] + salt) + (unit_at - starts[doc]).astype(np.uint64))
        slots = np.full(len(ids), ABSENT, np.int32)
        single = unit_at[size == 1]
        slots[single] = ids[single]
        for u in np.flatnonzero(size > LONGEST):
            at = unit_at[u]
            for place, piece in self.agenda(ids[at : at + size[u]].tolist(), int(unit[u])):
                slots[at + place] = piece
        self._merge_units(ids, unit_at, size, unit, slots)
        return self._spelled(slots, chars, doc_of, n_docs)

    def _merge_units(self, ids, unit_at, size, unit, slots) -> None:
        """Merge all units of 2 to ``LONGEST`` characters, from the longest on.

        Every step merges one pair in each row of the matrix, so rows of one length stay of one length, and meet the units
        that had that length from the start.
        """
        order = np.argsort(size.astype(np.uint32), kind="stable")
        bounds = np.searchsorted(size[order], np.arange(LONGEST + 2))
        rows = np.empty(0, np.int64)
        # A column is a unit: its pieces, their edges, and the ranks of its candidates.
        piece = np.empty((LONGEST, 0), self.kind)
        edge = np.empty((LONGEST + 1, 0), np.uint8)
        rank = np.empty((LONGEST - 1, 0), self.kind)
        for length in range(LONGEST, 1, -1):
            fresh = order[bounds[length] : bounds[length + 1]]
            if len(fresh):
                new = ids[unit_at[fresh] + np.arange(length)[:, None]].astype(self.kind)
                cut = np.repeat(np.arange(length + 1, dtype=np.uint8), len(fresh)).reshape(length + 1, -1)
                flat = [cut[i : i + length - 1].ravel() for i in range(3)]
                ranks = self._ranks(new[:-1].ravel(), new[1:].ravel(), np.tile(unit[fresh], length - 1), *flat)
                rows, piece = np.concatenate([rows, fresh]), np.concatenate([piece, new], axis=1)
                edge = np.concatenate([edge, cut], axis=1)
                rank = np.concatenate([rank, ranks.reshape(length - 1, -1)], axis=1)
            best = rank.min(axis=0)
            over = np.flatnonzero(best == self.never)
            if len(over):
                slots[unit_at[rows[over]] + edge[:-1, over]] = piece[:, over]
                live = np.flatnonzero(best != self.never)
                rows, best = rows[live], best[live]
                piece, edge, rank = piece.take(live, 1), edge.take(live, 1), rank.take(live, 1)
            at = np.zeros(len(rows), np.uint8)
            for place in range(length - 2, 0, -1):
                np.putmask(at, rank[place] == best, np.uint8(place))
            np.putmask(at, rank[0] == best, np.uint8(0))
            every = np.arange(len(rows))
            merged = self.piece_of[best]
            shared = np.flatnonzero(merged == NONE)
            if len(shared):
                left, right = piece[at[shared], shared], piece[at[shared] + 1, shared]
                place = self.index.find((left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64))
                merged[shared] = self.merged[place]
            stays = np.arange(length, dtype=np.uint8)[:, None] <= at
            piece = np.where(stays[:-1], piece[:-1], piece[1:])
            piece[at, every] = merged
            edge = np.where(stays, edge[:-1], edge[1:])
            rank = np.where(stays[1:-1], rank[:-1], rank[1:])
            for some, p in ((np.flatnonzero(at > 0), at - 1), (np.flatnonzero(at < length - 2), at)):
                p = p[some].astype(np.intp)
                rank[p, some] = self._ranks(
                    piece[p, some],
                    piece[p + 1, some],
                    unit[rows[some]],
                    edge[p, some],
                    edge[p + 1, some],
                    edge[p + 2, some],
                )
        slots[unit_at[rows]] = piece[0]

    def _spelled(self, slots, chars, doc_of, n_docs) -> tuple[np.ndarray, np.ndarray]:
        """The ids in order; characters without a piece as the bytes of UTF-8."""
        at = np.flatnonzero(slots != ABSENT)
        ids, docs = slots[at], doc_of[at]
        odd = np.flatnonzero(ids == NONE)
        if len(odd):
            c = chars[at[odd]].astype(np.int64)
            width = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
            times = np.ones(len(ids), np.int64)
            times[odd] = width
            to = np.cumsum(times) - times
            spelled = np.repeat(ids, times)
            for w in range(1, 5):
                some, where = c[width == w], to[odd[width == w]]
                for i in range(w):
                    bits = (some >> (6 * (w - 1 - i))) & (0x3F if w > 1 and i else 0xFF)
                    lead = 0 if w == 1 else 0x80 if i else (0xF00 >> w) & 0xFF
                    spelled[where + i] = self.byte_ids[bits | lead]
            ids, docs = spelled, np.repeat(docs, times)
        return np.r_[0, np.cumsum(np.bincount(docs, minlength=n_docs))], ids

    def decode(self, offsets: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of the texts and their UTF-8 bytes, without the space that encoding puts first."""
        size = self.raw_size[ids]
        ends = np.r_[0, np.cumsum(size)]
        source = np.arange(ends[-1]) + np.repeat(self.raw_at[ids] - ends[:-1], size)
        text, edges = self.raw[source], ends[offsets]
        lead = edges[:-1][np.diff(edges) > 0]
        lead = lead[text[lead] == 0x20] if len(lead) else lead
        keep = np.ones(len(text), bool)
        keep[lead] = False
        return np.r_[0, np.cumsum(keep)][edges], text[keep]


def _rows(batch: pa.RecordBatch, at: int, first: int, after: int, column: pa.Array) -> pa.RecordBatch:
    """Rows ``first`` to ``after`` of a batch, with another column in place ``at``."""
    columns = [c.slice(first, after - first) for c in batch.columns]
    columns[at] = column
    return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def _encoding(vocabulary, dropout: float, seed: int):
    def encoding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary.value, dropout, seed)
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for first, after, offsets, data in text_runs(batch.column(1), RUN):
                edges, ids = codec.encode(keys[first:after], offsets, data)
                lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids, pa.int32()))
                yield _rows(batch, 1, first, after, lists)

    return encoding


def _decoding(vocabulary):
    def decoding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary.value, 0.0, 0)
        for batch in batches:
            for first in range(0, len(batch), 256):
                after = min(first + 256, len(batch))
                column = batch.column(0).slice(first, after - first)
                sizes = np.r_[0, np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]
                edges, text = codec.decode(sizes, column.flatten().to_numpy(zero_copy_only=False))
                buffers = [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(text)]
                yield _rows(batch, 0, first, after, pa.Array.from_buffers(pa.string(), after - first, buffers))

    return decoding


def encoded(
    docs: DataFrame,
    keep: list[str],
    model: str = MODEL,
    dropout: float = DROPOUT,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``ids`` (array<int>) of each document beside its columns ``keep``; no shuffle.

    A null or empty text has no ids. Documents of equal id and text get equal ids, whatever their task; null ids count as one
    id. Whole texts are encoded. An empty table gives an empty result.
    """
    ship_code(docs.sparkSession)
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    beside = [F.col(c).alias(f"_{i}") for i, c in enumerate(keep)]
    rows = docs.select(F.xxhash64(id_col).alias("_key"), F.col(text_col).alias("ids"), *beside)
    fields = "".join(f", _{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    done = rows.mapInArrow(_encoding(vocabulary, dropout, seed), f"_key long, ids array<int>{fields}")
    return done.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], "ids")


def decoded(rows: DataFrame, keep: list[str], model: str = MODEL, ids_col: str = "ids") -> DataFrame:
    """``text`` of each row's ids beside its columns ``keep``; null ids give an empty text."""
    ship_code(rows.sparkSession)
    vocabulary = rows.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    some = rows.select(F.col(ids_col).alias("text"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)])
    fields = "".join(f", _{i} {rows.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    done = some.mapInArrow(_decoding(vocabulary), f"text string{fields}")
    return done.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], "text")


def round_trip(docs: DataFrame, model: str = MODEL, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_hash, text_sha256, decoded_sha256, lossless."""
    rows = docs.select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    ids = encoded(rows, ["doc_id", "text_sha256"], model, dropout, seed)
    counted = ids.select(
        "doc_id", "text_sha256", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"), "ids"
    )
    back = decoded(counted, ["doc_id", "n_tokens", "ids_hash", "text_sha256"], model)
    sha = F.sha2(F.col("text"), 256)
    return back.select(
        "doc_id",
        "n_tokens",
        "ids_hash",
        "text_sha256",
        sha.alias("decoded_sha256"),
        (sha == F.col("text_sha256")).alias("lossless"),
    )

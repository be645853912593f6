"""Languages by prediction by partial matching (PPM) over bytes.

For every language a context tree of up to ``DEPTH`` bytes counts which byte follows which context. A byte seen after its longest
known context costs its share of that context; otherwise it costs the context's escape (method C) and is coded in
the next shorter one, down to all 256 bytes alike. Counts are frozen after training, so the code length of a text is a sum
over its bytes, and the language with the shortest code wins.

Training fits on a sample of the labelled documents: windows of ``WINDOW`` bytes, taken in hash order up to each language's share
of ``SAMPLE_BYTES``, but at least one, so that no label is left out; a language below its share is taken whole. This bounds the
trees that the tasks get. Scoring covers every byte of every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterqa.llm.arrow_text import text_runs
from meterqa.llm.base import ship_code
from meterqa.llm.lookup import HashIndex

DEPTH = 3
SAMPLE_BYTES = 16 << 20
#: Bytes of a text that the sample takes or leaves together.
WINDOW = 4096
#: Stands before every text, so that each byte has a whole context.
LEAD = 10
PIECE = 1 << 18
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Documents that training leaves out; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == 0


def _led(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with ``DEPTH`` leading bytes before each text, and where in them the texts' own bytes are."""
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    own = np.arange(len(data)) + DEPTH * (rows + 1)
    whole = np.full(len(data) + DEPTH * (len(offsets) - 1), LEAD, np.uint8)
    whole[own] = data
    return whole, own


def _grams(whole: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Each own byte with the ``DEPTH`` bytes before it, as one number; the last byte is the lowest."""
    w = whole.astype(np.uint64)
    gram = np.zeros(len(own), np.uint64)
    for back in range(DEPTH, -1, -1):
        gram = (gram << np.uint64(8)) | w[own - back]
    return gram


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grams of windows that begin with the ``DEPTH`` bytes before them."""
    for batch in batches:
        langs = batch.column(0).to_pylist()
        grams: dict[str, list[np.ndarray]] = {}
        for first, after, offsets, data in text_runs(batch.column(1)):
            own = np.ones(len(data), bool)
            own[(offsets[:-1, None] + np.arange(DEPTH)).ravel()] = False
            all_grams = _grams(data, np.flatnonzero(own))
            edges = offsets - DEPTH * np.arange(len(offsets))
            for row in range(first, after):
                part = all_grams[edges[row - first] : edges[row - first + 1]]
                grams.setdefault(langs[row], []).append(part)
        for lang, parts in grams.items():
            found, times = np.unique(np.concatenate(parts), return_counts=True)
            for at in range(0, len(found), 100_000):
                some = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(found[some]), pa.string()),
                        pa.array(found[some].astype(np.int64)),
                        pa.array(times[some].astype(np.int64)),
                    ],
                    names=["lang", "gram", "n"],
                )


def _rank(number: Column, window: Column) -> Column:
    """A window's place in the hash order."""
    return F.xxhash64(number, window, F.lit(11))


def _sampled(docs: DataFrame, sample_bytes: int) -> DataFrame:
    """(lang, window): the training windows, each after the ``DEPTH`` bytes before it."""
    train = docs.filter(F.col("lang").isNotNull() & (F.octet_length("text") > 0) & ~held_out(F.col("doc_id")))
    numbered = train.withColumn("_number", F.xxhash64("doc_id", "text")).withColumn(
        "_at", F.sequence(F.lit(0), F.floor((F.octet_length("text") - 1) / WINDOW).cast("int"))
    )
    size = F.least(F.lit(WINDOW), F.col("_bytes") - F.col("_window") * WINDOW).cast("long")
    windows = (
        numbered.select("lang", "_number", F.octet_length("text").alias("_bytes"), F.explode("_at").alias("_window"))
        .select("lang", size.alias("_size"), _rank(F.col("_number"), F.col("_window")).alias("_rank"))
    )
    sizes = windows.groupBy("lang").agg(F.sum("_size").alias("_total"), F.min("_rank").alias("_first"))
    langs = F.greatest(F.sum(F.lit(1)).over(W.partitionBy()), F.lit(1))
    quota = F.lit(sample_bytes) / langs
    # Far more than the quota where there is more; what a window over one language sees is bounded by it.
    share = (2 * quota + 64 * WINDOW) / F.col("_total")
    edge = F.when(share < 1, F.greatest("_first", (share * 2.0**64 - 2.0**63).cast("long"))).otherwise(F.lit(2**63 - 1))
    some = sizes.select(F.col("lang").alias("_of"), edge.alias("_edge"), quota.alias("_quota"))
    # One row per language.
    near = windows.join(F.broadcast(some), (F.col("lang") == F.col("_of")) & (F.col("_rank") <= F.col("_edge")))
    # Windows of one rank are copies: they count together, and add nothing to the trees.
    ranked = near.groupBy("lang", "_rank", "_quota").agg(F.min("_size").alias("_size"))
    order = W.partitionBy("lang").orderBy("_rank")
    taken = ranked.select(
        "lang", "_rank", "_quota", F.sum("_size").over(order).alias("_sum"), F.rank().over(order).alias("_nth")
    ).filter((F.col("_sum") <= F.col("_quota")) | (F.col("_nth") == 1))
    last = taken.groupBy(F.col("lang").alias("_of")).agg(F.max("_rank").alias("_last"))
    met = numbered.join(F.broadcast(last), F.col("lang") == F.col("_of"))
    kept = F.filter("_at", lambda i: _rank(F.col("_number"), i) <= F.col("_last"))
    lead = F.lit(bytes([LEAD] * DEPTH))
    cut = F.transform(
        F.array(F.concat(lead, F.col("text").cast("binary"))),
        lambda whole: F.transform("_kept", lambda i: F.substring(whole, i * WINDOW + 1, F.lit(WINDOW + DEPTH))),
    )[0]
    return met.withColumn("_kept", kept).filter(F.size("_kept") > 0).select("lang", F.explode(cut).alias("window"))


def training_counts(docs: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """(lang, gram, n): how often each byte follows each ``DEPTH`` bytes, in the sampled windows of the training documents."""
    ship_code(docs.sparkSession)
    counted = _sampled(docs, sample_bytes).mapInArrow(_counted, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class ContextTrees:
    """Code lengths in bits of all languages, from frozen counts of grams of ``DEPTH`` + 1 bytes."""

    def __init__(self, langs: list[str], lang_of: np.ndarray, gram: np.ndarray, n: np.ndarray):
        self.langs = langs
        width = len(langs)
        self.codes: list[np.ndarray] = []
        self.escapes: list[np.ndarray] = []
        self.grams: list[HashIndex] = []
        self.contexts: list[HashIndex] = []
        shorter: np.ndarray | None = None
        for order in range(DEPTH + 1):
            mask = np.uint64((1 << 8 * (order + 1)) - 1)
            keys, where = np.unique(gram & mask, return_inverse=True)
            counts = np.zeros((len(keys), width))
            np.add.at(counts, (where, lang_of), n)
            contexts, context = np.unique(keys >> np.uint64(8), return_inverse=True)
            total = np.zeros((len(contexts), width))
            kinds = np.zeros((len(contexts), width))
            np.add.at(total, context, counts)
            np.add.at(kinds, context, counts > 0)
            known = total > 0
            escape = np.where(known, np.log2(np.maximum(total + kinds, 1)) - np.log2(np.maximum(kinds, 1)), 0.0)
            below = np.full((len(keys), width), 8.0)
            if order:
                below = self.codes[-1][self.grams[-1].find(keys & (mask >> np.uint64(8)))]
            own = np.log2(np.maximum(total + kinds, 1))[context] - np.log2(np.maximum(counts, 1))
            self.codes.append(np.where(counts > 0, own, escape[context] + below).astype(np.float32))
            self.escapes.append(escape.astype(np.float32))
            self.grams.append(HashIndex(keys))
            self.contexts.append(HashIndex(contexts))

    def lengths(self, gram: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each gram after the bytes before it: one row per gram, one column per language."""
        out = np.empty((len(gram), len(self.langs)), np.float32)
        found = self.grams[DEPTH].find(gram)
        np.take(self.codes[DEPTH], np.maximum(found, 0), axis=0, out=out)
        open_ = np.flatnonzero(found < 0)
        if len(open_):
            out[open_] = self._open(gram[open_])
        return out

    def _open(self, gram: np.ndarray) -> np.ndarray:
        """As ``lengths``, where the longest gram is in no tree."""
        cost = np.zeros((len(gram), len(self.langs)), np.float32)
        rows = np.arange(len(gram))
        for order in range(DEPTH, -1, -1):
            some = gram[rows] & np.uint64((1 << 8 * (order + 1)) - 1)
            found = self.grams[order].find(some)
            cost[rows[found >= 0]] += self.codes[order][found[found >= 0]]
            rows, some = rows[found < 0], some[found < 0]
            context = self.contexts[order].find(some >> np.uint64(8))
            cost[rows[context >= 0]] += self.escapes[order][context[context >= 0]]
        cost[rows] += 8.0
        return cost

    def text_lengths(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Bits of each text, summed over all its bytes."""
        total = np.zeros((len(offsets) - 1, len(self.langs)))
        whole, own = _led(offsets, data)
        row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        for at in range(0, len(own), PIECE):
            bits = self.lengths(_grams(whole, own[at : at + PIECE]))
            rows = row_of[at : at + PIECE]
            edges = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
            total[rows[edges]] += np.add.reduceat(bits, edges, axis=0, dtype=np.float64)
        return total


def _scored(model):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = ContextTrees(*model.value) if model.value[0] else None
        for batch in batches:
            langs: list[str] = []
            scores: list[float] = []
            for _, _, offsets, data in text_runs(batch.column(1)):
                if trees is None:
                    langs += ["und"] * (len(offsets) - 1)
                    scores += [0.0] * (len(offsets) - 1)
                    continue
                bits = trees.text_lengths(offsets, data)
                for row, b in enumerate(bits.argmin(axis=1)):
                    langs.append(trees.langs[b])
                    scores.append(float(1 / np.exp2(np.minimum(0.0, bits[row, b] - bits[row])).sum()))
            letters = batch.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([x if ok else "und" for x, ok in zip(langs, letters, strict=True)], pa.string()),
                    pa.array([x if ok else 0.0 for x, ok in zip(scores, letters, strict=True)], pa.float64()),
                ],
                names=["doc_id", "lang_pred", "score"],
            )

    return scored


def trained(docs: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> tuple:
    """(languages, language, gram, count) of the training sample; bounded by the sample's size."""
    found = training_counts(docs, sample_bytes).toArrow()
    names = found.column("lang").to_pylist()
    langs = sorted(set(names))
    places = {lang: i for i, lang in enumerate(langs)}
    return (
        langs,
        np.array([places[x] for x in names], np.int64),
        found.column("gram").to_numpy().astype(np.uint64),
        found.column("n").to_numpy().astype(np.int64),
    )


def predicted(docs: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score (the share of the winner's probability among all languages).

    ``und`` with score 0 where the text is null, has no letter, or nothing has been learned. Ties go to the first language by
    name. Repeated rows give equal rows, an empty table an empty result; only doc_id, text and lang are read.
    """
    model = docs.sparkSession.sparkContext.broadcast(trained(docs, sample_bytes))
    kind = docs.schema["doc_id"].dataType.simpleString()
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    scored = docs.select("doc_id", "text", letter.alias("letter")).mapInArrow(
        _scored(model), f"doc_id {kind}, lang_pred string, score double"
    )
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")

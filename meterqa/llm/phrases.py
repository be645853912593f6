"""Phrase collocations from a weighted de Bruijn graph of the corpus.

Every word of a piece of text begins one edge: the three words from it on, or up to the piece's end, where an end mark fills the
rest. An edge leads from the node of its first two words to the node of its last two. Only edges are counted over the corpus.
A node's count is the flow through it, the weights of its outgoing edges, those to the end mark being the correction for pieces
that end there; a word's count is the flow through the nodes that begin with it.

Tasks count the edges of a block of words and send them packed, with the block's words once, to a bucket by their first word. A word that
holds more than a bucket's share of all words is spread by its next word too, and a node of two such words by the third; what their
buckets find is added up. So flows are whole within a bucket for all other words, and only edges, nodes and words that are frequent
enough leave it. Among those, unary paths, whose nodes have one way in and one way out, are compacted by pointer jumping.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterqa.llm.arrow_text import text_runs
from meterqa.llm.base import ship_code, written
from meterqa.llm.lookup import mixed

LEAST = 10
TOP = 2000
#: A candidate goes if a longer one holds at least this percentage of its occurrences.
INSIDE = 50
#: Words whose edges a task counts together; words of a bucket; a block names words that hold this share of it as heavy.
BLOCK_WORDS = 1 << 20
BUCKET_WORDS = 1 << 20
HEAVY_SHARE = 1 / 65536
#: Nodes of a compacted path that are kept in one row.
PATH_NODES = 1024

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ENDS_PIECE = np.zeros(256, bool)
_ENDS_PIECE[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_ENDS_WORD = _ENDS_PIECE.copy()
_ENDS_WORD[[0x20, 0x09]] = True


def _words(offsets: np.ndarray, data: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of texts laid end to end, and whether the next word is in the same piece."""
    data = _LOWER[data]
    apart = _ENDS_WORD[data]
    text_end = np.zeros(len(data) + 1, bool)
    text_end[offsets] = True
    before = np.r_[True, apart]  # what lies before each byte, and before the end
    starts = np.flatnonzero(~apart & (before[:-1] | text_end[:-1]))
    after = np.r_[apart, True]
    ends = np.flatnonzero(~np.r_[True, apart] & (after | text_end))
    breaks = np.cumsum(np.r_[0, _ENDS_PIECE[data]]) + np.cumsum(text_end)
    follows = np.zeros(len(starts), bool)
    follows[:-1] = breaks[starts[1:]] == breaks[starts[:-1]]
    lengths = np.r_[0, np.cumsum(ends - starts)].astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(lengths), pa.py_buffer(data[~apart])])
    return words, follows


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array, np.ndarray]]:
    """(lang, words, whether the next word is in the same piece) of blocks of whole texts; columns text and lang."""
    held: dict[str, list] = {}
    count = 0

    def flushed():
        for lang, parts in held.items():
            yield lang, pa.concat_arrays([w for w, _ in parts]), np.concatenate([f for _, f in parts])
        held.clear()

    for batch in batches:
        langs = batch.column(1).dictionary_encode()
        codes = langs.indices.to_numpy(zero_copy_only=False)
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            texts = batch.column(0).take(pa.array(np.flatnonzero(codes == code)))
            for _, _, offsets, data in text_runs(texts):
                words, follows = _words(offsets, data)
                if len(words):
                    held.setdefault(lang, []).append((words, follows))
                    count += len(words)
                if count >= BLOCK_WORDS:
                    yield from flushed()
                    count = 0
    yield from flushed()


def _heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, times) of a block's heavy words; a row without word has the number of all."""
    for lang, words, _ in _blocks(batches):
        coded = words.dictionary_encode()
        times = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
        some = np.flatnonzero(times >= len(words) * HEAVY_SHARE)
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array([lang] * (len(some) + 1)),
                "word": pa.concat_arrays([coded.dictionary.take(pa.array(some)), pa.nulls(1, pa.binary())]),
                "times": pa.array(np.r_[times[some], len(words)]),
            }
        )


def _counted(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by some columns of whole numbers below 2**32, and where in it another row begins."""
    bits = [int(k.max(initial=0)).bit_length() for k in keys]
    if sum(bits) <= 64:
        packed = np.zeros(len(keys[0]), np.uint64)
        for k, b in zip(keys, bits, strict=True):
            packed = packed << np.uint64(b) | k.astype(np.uint64)
        order = np.argsort(packed)
        packed = packed[order]
        return order, np.flatnonzero(np.r_[True, packed[1:] != packed[:-1]])
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    return order, np.flatnonzero(new)


PACKED = "bucket int, lang string, words binary, a binary, b binary, c binary, weight binary"


def _edges(shared):
    """Map tasks: the edges of each block with their weights, packed by bucket. The empty word is the end mark."""

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, heavy = shared.value
        for lang, words, follows in _blocks(batches):
            coded = words.dictionary_encode()
            names = [b"", *coded.dictionary.to_pylist()]
            hashes = np.array([zlib.crc32(w) for w in names], np.uint64) + np.uint64(zlib.crc32(lang.encode()) << 32)
            hot = np.array([(lang, w) in heavy for w in names])
            ids = coded.indices.to_numpy().astype(np.int64) + 1
            second = np.where(follows, np.r_[ids[1:], 0], 0)
            third = np.where(follows & np.r_[follows[1:], False], np.r_[ids[2:], 0, 0][: len(ids)], 0)
            order, first = _counted(ids, second, third)
            weight = np.diff(np.r_[first, len(order)])
            a, b, c = (x[order[first]] for x in (ids, second, third))
            spread = mixed(hashes[a])
            spread = np.where(hot[a], mixed(spread + hashes[b]), spread)
            spread = np.where(hot[a] & hot[b], mixed(spread + hashes[c]), spread)
            bucket = (spread % np.uint64(buckets)).astype(np.int64)
            by_bucket = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.r_[True, np.diff(bucket[by_bucket]) > 0, True])
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                rows = by_bucket[begin:end]
                used, local = np.unique(np.concatenate([a[rows], b[rows], c[rows]]), return_inverse=True)
                kind = np.uint16 if len(used) < 1 << 16 else np.uint32
                parts = local.reshape(3, -1).astype(kind)
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array([int(bucket[rows[0]])], pa.int32()),
                        "lang": pa.array([lang]),
                        "words": pa.array([b"\n".join([names[i] for i in used])], pa.binary()),
                        **{n: pa.array([p.tobytes()], pa.binary()) for n, p in zip("abc", parts, strict=True)},
                        "weight": pa.array([weight[rows].astype(np.uint32).tobytes()], pa.binary()),
                    }
                )

    return edges


GRAMS = "lang string, a string, b string, c string, times long"


def _flows(shared, least: int):
    """Reduce tasks: rows come sorted by bucket and language; frequent edges, nodes and words, and partial flows of heavy ones."""

    def found(lang: str, rows: list[tuple], heavy) -> pa.RecordBatch:
        lists = [r[0].split(b"\n") for r in rows]
        coded = pa.array([b"", *(w for words in lists for w in words)], pa.binary()).dictionary_encode()
        end = 0  # the empty word
        codes = np.split(coded.indices.to_numpy().astype(np.int64)[1:], np.cumsum([len(x) for x in lists])[:-1])
        names = coded.dictionary.to_pylist()
        kinds = [np.uint16 if len(x) < 1 << 16 else np.uint32 for x in lists]
        a, b, c = (
            np.concatenate([to[np.frombuffer(r[i], kind)] for r, to, kind in zip(rows, codes, kinds, strict=True)]) for i in (1, 2, 3)
        )
        weight = np.concatenate([np.frombuffer(r[4], np.uint32) for r in rows]).astype(np.int64)
        order, edge = _counted(a, b, c)
        weight = np.add.reduceat(weight[order], edge)
        a, b, c = (x[order[edge]] for x in (a, b, c))
        node = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        word = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        flow, count = np.add.reduceat(weight, node), np.add.reduceat(weight, word)
        hot = np.array([(lang, w) in heavy for w in names])
        edges = np.flatnonzero((weight >= least) & (c != end))
        nodes = (b[node] != end) & ((flow >= least) | (hot[a[node]] & hot[b[node]]))
        words = (count >= least) | hot[a[word]]
        at = (edges, node[nodes], word[words])
        none = [np.full(len(x), end) for x in at]
        columns = (
            [a[x] for x in at] + [[end]],
            [b[at[0]], b[at[1]], none[2], [end]],
            [c[at[0]], none[1], none[2], [end]],
        )
        texts = coded.dictionary.cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * (sum(map(len, at)) + 1)),
                *[texts.take(pa.array(np.concatenate(x).astype(np.int64))) for x in columns],
                pa.array(np.concatenate([weight[edges], flow[nodes], count[words], [weight.sum()]])),
            ],
            names=["lang", "a", "b", "c", "times"],
        )

    def flows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy = shared.value[1]
        held, rows = None, []
        for batch in batches:
            for bucket, lang, *row in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if (bucket, lang) != held:
                    if rows:
                        yield found(held[1], rows, heavy)
                    held, rows = (bucket, lang), []
                rows.append(row)
        if rows:
            yield found(held[1], rows, heavy)

    return flows


def grams(docs: DataFrame, least: int = LEAST, lang_col: str = "lang", text_col: str = "text", bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """(lang, a, b, c, times): edges, nodes (c empty) and words (b empty too) that occur ``least`` times; a empty: the number of words.

    A null language is ``und``, a null text is empty.
    """
    spark = docs.sparkSession
    ship_code(spark)
    texts = docs.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    sums = texts.mapInArrow(_heavy, "lang string, word binary, times long").groupBy("lang", "word").agg(F.sum("times").alias("times"))
    sums = written(sums)
    total = sums.filter("word is null").agg(F.sum("times")).first()[0] or 0
    buckets = max(1, -(-total // bucket_words))
    # At most ``buckets`` words can hold a bucket's share.
    heavy = sums.filter(F.col("word").isNotNull() & (F.col("times") * buckets >= total)).select("lang", "word").collect()
    shared = spark.sparkContext.broadcast((buckets, {(r["lang"], bytes(r["word"])) for r in heavy}))
    packed = texts.mapInArrow(_edges(shared), PACKED)
    dealt = packed.repartition("bucket").sortWithinPartitions("bucket", "lang")
    parts = dealt.mapInArrow(_flows(shared, least), GRAMS)
    whole = parts.groupBy("lang", "a", "b", "c").agg(F.sum("times").alias("times"))
    return whole.filter((F.col("times") >= least) | (F.col("a") == ""))


def _node(*names: str) -> Column:
    """A node as text: no word holds a tab, so the last two tell it from the language."""
    return F.concat_ws("\t", *names)


def _places(nodes: DataFrame, inner: DataFrame) -> DataFrame:
    """(node, head, place): each node's place, from 0, on the unary path that begins at ``head``.

    Pointers to an earlier node double their reach in every round, which is written. A path that runs in a circle has no head; each of its
    nodes is a path of its own.
    """
    before = inner.select(F.col("to").alias("node"), F.col("from").alias("head"))
    at = written(
        nodes.select("node").join(before, "node", "left").select(
            "node", F.coalesce("head", "node").alias("head"), F.when(F.col("head").isNull(), 0).otherwise(1).cast("long").alias("place")
        )
    )
    open_ = None
    while True:
        up = at.select(F.col("node").alias("head"), F.col("head").alias("far"), F.col("place").alias("more"))
        at = written(at.join(up, "head").select("node", F.col("far").alias("head"), (F.col("place") + F.col("more")).alias("place"), "more"))
        still, open_ = open_, at.filter("more > 0").count()
        if not open_ or open_ == still:
            circle = F.col("more") > 0
            return at.select(
                "node", F.when(circle, F.col("node")).otherwise(F.col("head")).alias("head"), F.when(~circle, F.col("place")).otherwise(0).alias("place")
            )
        at = at.drop("more")


def compacted(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Paths (lang, words, flows, weights) of the graph of ``grams``, and links (lang, a, b, c, times), the edges outside them.

    A path of n nodes has n + 1 words, the nodes' flows and the n - 1 weights between them. All nodes are on one path; a
    node where ways part or meet ends it, and so does each ``PATH_NODES``-th.
    """
    nodes = written(
        found.filter("b <> '' and c = ''").select("lang", "a", "b", F.col("times").alias("flow"), _node("lang", "a", "b").alias("node"))
    )
    edges = written(
        found.filter("c <> ''").select(
            "lang", "a", "b", "c", "times", _node("lang", "a", "b").alias("from"), _node("lang", "b", "c").alias("to")
        )
    )
    one_out = edges.groupBy("from").agg(F.count("*").alias("n")).filter("n = 1").select("from")
    one_in = edges.groupBy("to").agg(F.count("*").alias("n")).filter("n = 1").select("to")
    inner = edges.join(one_out, "from", "left_semi").join(one_in, "to", "left_semi")
    placed = written(_places(nodes, inner.select("from", "to")).withColumn("part", F.floor(F.col("place") / PATH_NODES)))
    into = edges.select(F.col("from").alias("source"), F.col("to").alias("node"), F.col("times").alias("weight"))
    source = placed.select(F.col("node").alias("source"), F.col("head").alias("source_head"), F.col("place").alias("source_place"))
    # The way into a node lies on its path if it comes from the place before.
    on_path = (
        into.join(placed.filter(F.col("place") % PATH_NODES > 0), "node")
        .join(source, "source")
        .filter((F.col("source_head") == F.col("head")) & (F.col("source_place") == F.col("place") - 1))
    )
    on_path = written(on_path.select("source", "node", "weight"))
    rows = nodes.join(placed, "node").join(on_path.select("node", "weight"), "node", "left")
    step = F.struct("place", "b", "flow", "weight", "a", "lang")
    steps = F.col("steps")
    paths = rows.groupBy("head", "part").agg(F.sort_array(F.collect_list(step)).alias("steps")).select(
        steps[0]["lang"].alias("lang"),
        F.concat(F.array(steps[0]["a"]), F.transform(steps, lambda s: s["b"])).alias("words"),
        F.transform(steps, lambda s: s["flow"]).alias("flows"),
        F.transform(F.slice(steps, 2, PATH_NODES), lambda s: s["weight"]).alias("weights"),
    )
    links = edges.join(
        on_path.select(F.col("source").alias("from"), F.col("node").alias("to")), ["from", "to"], "left_anti"
    ).select("lang", "a", "b", "c", "times")
    return paths, links


def candidates(paths: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Phrases of two words (lang, a, b, times, inside) and three (lang, a, b, c, times, left, right).

    ``inside`` is the count of the commonest longer phrase that holds the two words, 0 without one; ``left`` and ``right`` count
    the first two and the last two of three words. What lies on a path is read off it; joins are made for links and the ends of paths.
    """
    at = paths.select("lang", "words", "flows", "weights", F.posexplode("flows").alias("i", "times"))
    last = F.size("flows") - 1
    before = F.when(F.col("i") > 0, F.get("weights", F.col("i") - 1))
    after = F.when(F.col("i") < last, F.get("weights", F.col("i")))
    two = at.select(
        "lang",
        F.get("words", F.col("i")).alias("a"),
        F.get("words", F.col("i") + 1).alias("b"),
        "times",
        F.greatest(F.lit(0).cast("long"), before, after).alias("inside"),
        ((F.col("i") == 0) | (F.col("i") == last)).alias("end"),
    )
    ways = links.select("lang", "a", "b", "times").unionByName(links.select("lang", F.col("b").alias("a"), F.col("c").alias("b"), "times"))
    best = ways.groupBy("lang", "a", "b").agg(F.max("times").alias("best"))
    ends = two.filter("end").join(best, ["lang", "a", "b"], "left").withColumn("inside", F.greatest("inside", F.col("best")))
    pairs = two.filter("not end").drop("end").unionByName(ends.drop("end", "best"))
    on_path = paths.select("lang", "words", "flows", F.posexplode("weights").alias("i", "times")).select(
        "lang",
        *[F.get("words", F.col("i") + k).alias(n) for k, n in enumerate("abc")],
        "times",
        F.get("flows", F.col("i")).alias("left"),
        F.get("flows", F.col("i") + 1).alias("right"),
    )
    left = two.select("lang", "a", "b", F.col("times").alias("left"))
    right = two.select("lang", F.col("a").alias("b"), F.col("b").alias("c"), F.col("times").alias("right"))
    linked = links.join(left, ["lang", "a", "b"]).join(right, ["lang", "b", "c"])
    return pairs, on_path.unionByName(linked)


def _score(times: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (l r)), exact for counts below 10 ** 15."""
    return F.expr(f"(cast({times} as decimal(15,0)) * cast({times} as decimal(15,0)) * 1000000BD) div (cast({left} as decimal(15,0)) * cast({right} as decimal(15,0)))")


def collocations(
    docs: DataFrame,
    top: int = TOP,
    least: int = LEAST,
    inside: int = INSIDE,
    lang_col: str = "lang",
    text_col: str = "text",
    bucket_words: int = BUCKET_WORDS,
) -> DataFrame:
    """Each language's first ``top`` phrases of two or three words: lang, rank, phrase, a, l, r, n, score.

    A phrase occurs ``least`` times or more; its score is that of its worst cut, of equal ones the first. A phrase of two words goes if
    one of three holds ``inside`` per cent of its occurrences. Ranks go by score and count, falling, then by the phrase's bytes.
    A null language is ``und``; null and empty texts have no words; rows that repeat a text count each; an empty table gives an
    empty result; other columns are not read.
    """
    found = written(grams(docs, least, lang_col, text_col, bucket_words))
    paths, links = (written(x) for x in compacted(found))
    pairs, triples = candidates(paths, links)
    counts = found.filter("a <> '' and b = ''")
    first = counts.select("lang", "a", F.col("times").alias("of_first"))
    total = found.filter("a = ''").select("lang", F.col("times").alias("n"))

    def last(name: str) -> DataFrame:
        return counts.select("lang", F.col("a").alias(name), F.col("times").alias("of_last"))

    pairs = pairs.filter(F.col("inside") * 100 < F.col("times") * inside)
    pairs = pairs.join(first, ["lang", "a"]).join(last("b"), ["lang", "b"]).select(
        "lang",
        F.concat_ws(" ", "a", "b").alias("phrase"),
        "times",
        F.struct(_score("times", "of_first", "of_last").alias("score"), F.lit(1).alias("k"), F.col("of_first").alias("l"), F.col("of_last").alias("r")).alias("cut"),
    )
    cuts = [
        F.struct(_score("times", one, two).alias("score"), F.lit(k).alias("k"), F.col(one).alias("l"), F.col(two).alias("r"))
        for k, one, two in ((1, "of_first", "right"), (2, "left", "of_last"))
    ]
    triples = triples.join(first, ["lang", "a"]).join(last("c"), ["lang", "c"]).select(
        "lang", F.concat_ws(" ", "a", "b", "c").alias("phrase"), "times", F.least(*cuts).alias("cut")
    )
    every = pairs.unionByName(triples).select("lang", "phrase", F.col("times").alias("a"), "cut.l", "cut.r", "cut.score")
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")

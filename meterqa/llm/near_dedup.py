"""Near duplicates by SetSketch registers.

1. Every text's set of word shingles gives 127 registers, and these 25 band keys. Equal sets form a class with one member to
   compare.
2. In each band bucket the class that meets most others is the centre, and is paired with the rest: pairs grow with the rows, not with
   their square. A cluster's middle text is such a centre in nearly all its buckets.
3. Pairs whose sizes rule out the similarity are dropped, then those that the joint likelihood of their registers makes next to
   impossible; the rest are confirmed on their full sets.
4. Buckets that still hold several components have all pairs across components estimated and confirmed within tasks, in blocks of
   bounded size, so that no link is lost because it misses a centre. Only links leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterqa.llm import setsketch
from meterqa.llm.arrow_text import text_runs
from meterqa.llm.base import ship_code, unused_name, written
from meterqa.llm.exact_dedup import possibly_entered
from meterqa.llm.graph import components
from meterqa.llm.shingles import shingle_sets

#: Percent of the union that the intersection of linked sets makes up, where the caller asks for nothing else.
LEAST = 85
#: A pair goes on to confirmation unless this log-likelihood is lost by taking it for similar: odds of about a million to one.
SLACK = 14.0
#: Members of a centre are confirmed in so many parts.
SALTS = 32
#: Rows of a bucket that are compared at once across components.
BLOCK = 1024
#: Equal registers that any pair of the likelihood test has, at most; a quick test before it (``_least_equal``).
EQUAL = 64
#: Columns of an incidence matrix at once.
COLUMNS = 4096


def _sketching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, after, offsets, data in text_runs(batch.column(0)):
            edges, shingles = shingle_sets(offsets, data)
            sketches = setsketch.registers(edges, shingles)
            keys = setsketch.band_keys(sketches)
            sums = np.r_[np.uint64(0), np.cumsum(shingles, dtype=np.uint64)]
            folds = np.r_[np.uint64(0), np.cumsum(setsketch.mixed(shingles + np.uint64(1)), dtype=np.uint64)]
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, keys.size + 1, setsketch.BANDS), pa.int32()), pa.array(keys.ravel().view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *(c.slice(first, after - first) for c in batch.columns[1:]),
                    pa.array(np.diff(edges), pa.int64()),
                    pa.array((sums[edges[1:]] - sums[edges[:-1]]).view(np.int64)),
                    pa.array((folds[edges[1:]] - folds[edges[:-1]]).view(np.int64)),
                    pa.array([s.tobytes() for s in sketches.astype("<u2")], pa.binary()),
                    lists,
                ],
                names=[*batch.schema.names[1:], "n", "f", "g", "sketch", "keys"],
            )


def sketched(docs: DataFrame) -> DataFrame:
    """(id, row, s, t, n, f, g, sketch, keys) per row: two hashes of the text; size and two hashes of its set; registers; band keys."""
    ship_code(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        text.alias("text"),
        F.col("doc_id").alias("id"),
        F.monotonically_increasing_id().alias("row"),
        *_text_hashes(text),
    )
    fields = f"id {kind}, row long, s long, t long, n long, f long, g long, sketch binary, keys array<long>"
    return written(rows.mapInArrow(_sketching, fields))


def _text_hashes(text):
    return F.xxhash64(text).alias("s"), F.xxhash64(text, F.lit(3)).alias("t")


def _unpacked(column: pa.Array) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, "<u2").reshape(len(column), setsketch.M)


def _least_equal(least: int) -> int:
    """Equal registers that sets of ``least`` percent have, but for 8.5 standard deviations: registers differ with at most their rest."""
    share = least / 100
    return max(0, min(EQUAL, int(setsketch.M * share - 8.5 * (setsketch.M * share * (1 - share)) ** 0.5)))


def _likely(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not len(batch):
            continue
        n, m = (batch.column(i).to_numpy().astype(float) for i in (2, 3))
        _, lost = setsketch.joint_likelihood(_unpacked(batch.column(4)), _unpacked(batch.column(5)), n, m, least / 100)
        yield batch.select([0, 1]).filter(pa.array(lost <= SLACK))


def _set_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, after, offsets, data in text_runs(batch.column(1)):
            edges, shingles = shingle_sets(offsets, data)
            sets = [shingles[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, after - first), pa.array(sets, pa.binary())], names=["node", "set"]
            )


def _common(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sets: products of their incidence with the elements that several hold."""
    found, which = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    several = np.bincount(which, minlength=len(found)) > 1
    column = np.cumsum(several) - 1
    row, column = row[several[which]], column[which[several[which]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros(len(i), np.int64)
    for at in range(0, int(several.sum()), COLUMNS):
        some = slice(*np.searchsorted(column, [at, at + COLUMNS]))
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[row[some], column[some] - at] = 1
        total += (held @ held.T)[i, j].astype(np.int64)
    return total


def _block_links(rows: list[tuple], least: int) -> pa.RecordBatch | None:
    """Links between classes of different components in one bucket, or between two blocks of it."""
    node, root, band = (np.array([r[k] for r in rows], np.int64) for k in (0, 1, 2))
    size = np.array([r[3] for r in rows], float)
    side = np.array([r[4] for r in rows])
    could = np.triu(root[:, None] != root, 1)
    could &= least * np.maximum(size[:, None], size) <= 100 * np.minimum(size[:, None], size)
    if side.any():
        could &= side[:, None] != side
    i, j = np.nonzero(could)
    if not len(i):
        return None
    sketch = np.frombuffer(b"".join(r[5] for r in rows), "<u2").reshape(len(rows), setsketch.M)
    kept: list[np.ndarray] = []
    for at in range(0, len(i), 8192):
        a, b = i[at : at + 8192], j[at : at + 8192]
        same = sketch[a] == sketch[b]
        bands = same[:, : setsketch.BANDS * setsketch.ROWS].reshape(len(a), setsketch.BANDS, -1).all(axis=2)
        # A pair belongs to the first band that it shares.
        own = np.flatnonzero((bands.argmax(axis=1) == band[a]) & (same.sum(axis=1) >= _least_equal(least)))
        _, lost = setsketch.joint_likelihood(sketch[a[own]], sketch[b[own]], size[a[own]], size[b[own]], least / 100)
        kept.append(at + own[lost <= SLACK])
    some = np.concatenate(kept)
    if not len(some):
        return None
    i, j = i[some], j[some]
    common = _common([np.frombuffer(r[6], np.uint64) for r in rows], i, j)
    linked = 100 * common >= least * (size[i] + size[j] - common)
    i, j = node[i[linked]], node[j[linked]]
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(i, j)), pa.array(np.maximum(i, j))], names=["a", "b"])


def _across(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket; one bucket, or one pair of its blocks, is held at a time.

    A row's ``side`` tells which block of the pair it is in; with one block, its rows meet each other.
    """
    held, rows = None, []
    for batch in batches:
        for bucket, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if bucket != held:
                if len(rows) > 1 and (links := _block_links(rows, least)):
                    yield links
                held, rows = bucket, []
            rows.append(row)
    if len(rows) > 1 and (links := _block_links(rows, least)):
        yield links


def _confirmed(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by centre and part, the centre's own text first; members with enough in common are linked."""
    centre, own = None, np.empty(0, np.uint64)
    for batch in batches:
        names = batch.schema.names
        a, part, b = (batch.column(names.index(c)).to_pylist() for c in ("a", "part", "b"))
        for first, after, offsets, data in text_runs(batch.column(names.index("text"))):
            edges, shingles = shingle_sets(offsets, data)
            links: list[tuple[int, int]] = []
            for row in range(first, after):
                set_ = shingles[edges[row - first] : edges[row - first + 1]]
                if b[row] is None:
                    centre, own = (a[row], part[row]), set_
                    continue
                if centre != (a[row], part[row]):
                    raise ValueError("a member came before its centre")
                common = len(np.intersect1d(own, set_, assume_unique=True))
                if 100 * common >= least * (len(own) + len(set_) - common):
                    links.append((a[row], b[row]))
            if links:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"]
                )


def classes_of(rows: DataFrame) -> DataFrame:
    """One row for each distinct set: its first row as node, with size, registers, keys, and the hashes of that row's text."""
    least = F.min_by(F.struct("sketch", "keys", "s", "t"), "row").alias("e")
    grouped = rows.filter("n > 0").groupBy("n", "f", "g").agg(F.min("row").alias("node"), least)
    return grouped.select("node", "n", "e.sketch", "e.keys", "e.s", "e.t")


def _buckets(classes: DataFrame) -> DataFrame:
    """(key, node, n) of buckets with several classes, beside the number of others that each class meets."""
    every = classes.select("node", "n", F.posexplode("keys").alias("band", "key"))
    several = every.groupBy("key").agg(F.count("*").alias("met")).filter("met > 1")
    met = written(every.join(several, "key"))
    popular = met.groupBy("node").agg(F.sum("met").alias("popular"))
    return written(met.join(popular, "node"))


def _texts(nodes: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text) of some classes."""
    wanted = written(classes.join(nodes.distinct(), "node").select("node", "s", "t"))
    text = F.coalesce("text", F.lit(""))
    whole = docs.select(text.alias("text"), *_text_hashes(text))
    # Texts that are not wanted are left out before the shuffle; equal texts count once.
    some = possibly_entered(whole, "s", wanted.select("s")).groupBy("s", "t").agg(F.first("text").alias("text"))
    return wanted.join(some, ["s", "t"]).select("node", "text")


def _confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame, least: int) -> DataFrame:
    """Links (a, b) among ``pairs`` whose full sets are similar enough. ``pairs`` are shuffled with the texts of b, once each."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))
    texts = written(_texts(nodes, classes, docs))
    parted = pairs.withColumn("part", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    members = parted.join(texts.withColumnRenamed("node", "b"), "b").select("a", "part", "b", "text")
    centres = parted.select("a", "part").distinct().join(texts.withColumnRenamed("node", "a"), "a")
    centres = centres.select("a", "part", F.lit(None).cast("long").alias("b"), "text")
    dealt = members.unionByName(centres).repartition("a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b"))
    return written(dealt.mapInArrow(partial(_confirmed, least=least), "a long, b long"))


def links_of(classes: DataFrame, docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(node, root) of all classes with a link."""
    rows = _buckets(classes)
    centres = rows.groupBy("key").agg(
        F.max_by(F.struct("node", "n"), F.struct("popular", -F.col("node"))).alias("centre")
    )
    sized = 100 * F.least("n", "m") >= least * F.greatest("n", "m")
    pairs = (
        rows.join(centres, "key")
        .select(F.col("centre.node").alias("a"), F.col("node").alias("b"), F.col("centre.n").alias("n"), F.col("n").alias("m"))
        .filter((F.col("a") != F.col("b")) & sized)
        .distinct()
    )
    sketches = classes.select("node", "sketch")
    beside = pairs.join(sketches.toDF("a", "sketch_a"), "a").join(sketches.toDF("b", "sketch_b"), "b")
    likely = written(beside.select("a", "b", "n", "m", "sketch_a", "sketch_b").mapInArrow(partial(_likely, least=least), "a long, b long"))
    links = _confirm(likely, classes, docs, least)
    roots = components(links)
    # What is left: buckets with several components.
    rooted = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = rooted.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("met"))
    open_ = mixed.filter("x != y and met > 2").select("key", F.ceil(F.col("met") / BLOCK).alias("blocks"))
    block = F.pmod(F.xxhash64("node", F.lit(13)), F.col("blocks"))
    left = written(
        rooted.select("key", "node", "root", "band", "n").join(open_, "key").withColumn("block", block)
    )
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    spread = left.withColumn("other", other).select(
        F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("bucket"),
        "node",
        "root",
        "band",
        "n",
        (F.col("block") > F.col("other")).alias("side"),
    )
    sets = _texts(left.select("node"), classes, docs).mapInArrow(_set_bytes, "node long, set binary")
    met = spread.join(classes.select("node", "sketch").join(sets, "node"), "node")
    dealt = met.select("bucket", "node", "root", "band", "n", "side", "sketch", "set").repartition("bucket")
    more = written(dealt.sortWithinPartitions("bucket").mapInArrow(partial(_across, least=least), "a long, b long").distinct())
    if not more.limit(1).count():
        return roots
    return components(links.union(more))


def _grouped(docs: DataFrame, least: int) -> DataFrame:
    """(id, row, s, t, n, component, first): rows with their component's smallest id and the row that stays for it."""
    rows = sketched(docs)
    classes = written(classes_of(rows))
    roots = links_of(classes, docs, least)
    sets = rows.filter("n > 0").groupBy("n", "f", "g")
    best = F.min(F.struct(F.isnull("id").alias("no_id"), "id", "row")).alias("best")
    joined = sets.agg(F.min("row").alias("node"), best).join(roots, "node", "left")
    joined = written(joined.withColumn("root", F.coalesce("root", "node")).drop("node"))
    firsts = joined.groupBy("root").agg(F.min("best").alias("first"))
    found = joined.join(firsts, "root").select("n", "f", "g", "first")
    own = F.struct(F.isnull("id").alias("no_id"), "id", "row")
    return rows.join(found, ["n", "f", "g"], "left").select("id", "row", "s", "t", "n", F.coalesce("first", own).alias("first"))


def near_groups(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept; sets with ``least`` percent in common are linked.

    A null or blank text has an empty set and is linked with nothing. A null id comes after all others; a component
    without any id has a null one. Rows that repeat an id are documents of their own and all kept or all dropped with it.
    An empty table gives an empty result; other columns are not read.
    """
    return _grouped(docs.select("doc_id", "text"), least).select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("first.id").alias("component_id"),
        F.col("id").eqNullSafe(F.col("first.id")).alias("kept"),
    )


def one_of_each(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """One document of each component, in its own columns: the one with the smallest id, and of repeated rows any one.

    Only rows that the filter holds for dropped or repeated are shuffled.
    """
    rows = _grouped(docs.select("doc_id", "text"), least)
    id_ = F.struct("id")
    seen = rows.groupBy(id_.alias("id"), "s", "t").agg(
        F.max(F.col("first.row") == F.col("row")).alias("stays"), F.count("*").alias("times")
    )
    marked = written(seen.filter("not stays or times > 1"))
    s, t, key, maybe, row = (unused_name(docs, n) for n in ("_s", "_t", "_key", "_maybe", "_whole"))
    text = F.coalesce("text", F.lit(""))
    hashed = docs.withColumn(s, F.xxhash64(text)).withColumn(t, F.xxhash64(text, F.lit(3)))
    flagged = possibly_entered(hashed, s, marked.select("s"), flag=maybe)
    straight = flagged.filter(~F.col(maybe)).select(*docs.columns)
    packed = flagged.filter(maybe).select(
        F.struct(*docs.columns).alias(row), F.struct(F.col("doc_id").alias("id")).alias("id"), F.col(s).alias("s"), F.col(t).alias("t")
    )
    met = packed.join(marked, ["id", "s", "t"], "left")
    unmarked = met.filter(F.col("times").isNull()).select(row)
    repeated = met.filter("stays").groupBy("id", "s", "t").agg(F.first(row).alias(row)).select(row)
    left = unmarked.union(repeated).select(*[F.col(row)[c].alias(c) for c in docs.columns])
    return straight.unionByName(left)

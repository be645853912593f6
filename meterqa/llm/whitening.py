"""Whitening of embeddings by their leading principal components.

Vectors become whole numbers first, so that sums are exact. Tasks add up sums, then products of centred vectors, and send one
partial result each; rows of the partial matrices meet by their place. The driver holds one matrix, whose size is that of a
vector squared, and finds its leading eigenvectors (``eigen``). They are broadcast, as large as the matrix at most, and project
all rows. Memory in a task is a batch of rows and one matrix.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterqa.llm.base import ship_code
from meterqa.llm.eigen import leading

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
#: Whole numbers beyond this, either way, count as this.
FAR = 1 << 60
RESULT = "vec_id {}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def _grids(column: pa.Array, size: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their whole numbers) of the usable vectors of a batch, for each length or for one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(column).cast(pa.float64())
    good = pc.fill_null(pc.is_finite(flat), False).to_numpy(zero_copy_only=False)
    values = pc.fill_null(flat, 0.0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    bad = np.r_[0, np.cumsum(~good)]
    usable = (lengths > 0) & (bad[ends] == bad[ends - lengths])
    for one in np.unique(lengths[usable]) if size is None else [size]:
        rows = np.flatnonzero(usable & (lengths == one))
        if len(rows):
            c = values[(ends[rows] - one)[:, None] + np.arange(one)]
            yield rows, np.clip(np.floor(c * SCALE), -FAR, FAR).astype(np.int64) + OFFSET


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's vectors by length: how many, and the sum of each entry."""
    counts: dict[int, int] = {}
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for rows, x in _grids(batch.column(0)):
            size = x.shape[1]
            small = int(np.abs(x).max()) * len(rows) < 1 << 62
            total = (x if small else x.astype(object)).sum(axis=0).astype(object)
            counts[size] = counts.get(size, 0) + len(rows)
            totals[size] = totals.get(size, 0) + total
    for size, total in totals.items():
        yield pa.RecordBatch.from_pydict(
            {
                "size": pa.array([size] * size, pa.int32()),
                "place": pa.array(range(size), pa.int32()),
                "n": pa.array([counts[size]] * size, pa.int64()),
                "total": pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0)),
            }
        )


class Fit:
    """What all rows share: their number, the mean as a whole number and the rest of the sum, eigenvalues and vectors."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.size = len(sums)
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)
        self.values = np.empty(0)
        self.project = np.empty((self.size, 0))

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.rest / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.project

    def deviations(self, x: np.ndarray) -> list[Decimal]:
        """Exact sums of (n x - S) ** 2."""
        y = x - self.whole
        wide = (int(np.abs(y).max()) + 1) * self.n
        if wide >= 1 << 62:
            y = y.astype(object)
        d = self.n * y - self.rest
        if wide * wide * self.size >= 1 << 63:
            d = d.astype(object)
        return [Decimal(int(s)) for s in (d * d).sum(axis=1)]


def _products(of: Callable[[Fit, np.ndarray], np.ndarray], shared):
    """Map tasks: the sum of products of what ``of`` makes of a row, as rows of a matrix; the last one holds the plain sums."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = shared.value
        total = None
        for batch in batches:
            for _, x in _grids(batch.column(0), fit.size):
                z = of(fit, x)
                part = np.vstack([z.T @ z, z.sum(axis=0)])
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict(
                {"place": pa.array(range(len(total)), pa.int32()), "entries": pa.array(total.tolist(), pa.list_(pa.float64()))}
            )

    return products


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reduce tasks: rows of partial matrices become rows of their sum."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for place, entries in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            totals[place] = totals.get(place, 0.0) + np.array(entries)
    if totals:
        yield pa.RecordBatch.from_pydict(
            {
                "place": pa.array(list(totals), pa.int32()),
                "entries": pa.array([t.tolist() for t in totals.values()], pa.list_(pa.float64())),
            }
        )


def _covariance(vectors: DataFrame, n: int, of, shared) -> np.ndarray:
    parts = vectors.mapInArrow(_products(of, shared), "place int, entries array<double>")
    rows = parts.repartition("place").mapInArrow(_added, "place int, entries array<double>").collect()
    total = np.array([r["entries"] for r in sorted(rows, key=lambda r: r["place"])])
    means = total[-1] / n
    return total[:-1] / n - np.outer(means, means)


def _rows(shared, id_type: pa.DataType):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, identity_error, trace = shared.value
        k = len(fit.values)
        for whole in batches:
            for batch in (whole.slice(at, 1024) for at in range(0, len(whole), 1024)):
                for some, x in _grids(batch.column(0), fit.size):
                    each = pa.array(np.repeat(np.arange(len(some)), k))
                    ids = batch.column(1).take(pa.array(some))
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(each).cast(id_type),
                            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(some))),
                            pa.array(np.full(len(some) * k, fit.n)),
                            pa.array(fit.deviations(x), pa.decimal128(38, 0)).take(each),
                            pa.array(fit.whitened(x).ravel()),
                            pa.array(np.tile(fit.values / trace, len(some))),
                            pa.array(np.full(len(some) * k, identity_error)),
                        ],
                        names=[f.split()[0] for f in RESULT.split(", ")],
                    )

    return rows


def fitted(vectors: DataFrame, components: int = COMPONENTS) -> tuple[Fit | None, np.ndarray]:
    """The fit over a table of one column of vectors, and the covariance matrix."""
    spark = vectors.sparkSession
    sums = vectors.mapInArrow(_sums, "size int, place int, n long, total decimal(38,0)")
    sums = sums.groupBy("size", "place").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"))
    best = sums.agg(F.max(F.struct("n", "size")).alias("best")).select("best.*").first()
    if best is None or best["size"] is None:
        return None, np.empty((0, 0))
    found = sums.filter(F.col("size") == best["size"]).collect()
    fit = Fit(best["n"], [int(r["total"]) for r in sorted(found, key=lambda r: r["place"])])
    covariance = _covariance(vectors, fit.n, Fit.centred, spark.sparkContext.broadcast(fit))
    fit.values, axes = leading(covariance, components)
    fit.project = axes / np.sqrt(fit.values)
    return fit, covariance


def whitened(
    embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    A vector that is null or empty, or has an entry that is null or not finite, is left out; so is one whose length is not the
    commonest (of equally common ones the largest). Entries c count as floor(64 c) + 1000000, at most 2**60 from it.
    There are ``components`` components at most, fewer for shorter vectors; those without variance to double precision
    are left out, so a table of one vector, or of equal ones, gives an empty result as an empty table does. Rows that repeat an
    id, and null ids, are rows like others; extra columns are not read.
    """
    spark = embeddings.sparkSession
    ship_code(spark)
    kind = embeddings.schema[id_col].dataType.simpleString()
    schema = RESULT.format(kind)
    vectors = embeddings.select(F.col(vector_col).alias("v"))
    fit, covariance = fitted(vectors, components)
    if fit is None or not len(fit.values):
        return spark.createDataFrame([], schema)
    spread = _covariance(vectors, fit.n, Fit.whitened, spark.sparkContext.broadcast(fit))
    error = float(np.abs(spread - np.eye(len(spread))).max())
    shared = spark.sparkContext.broadcast((fit, error, float(np.trace(covariance))))
    rows = embeddings.select(F.col(vector_col).alias("v"), F.col(id_col).alias("vec_id"))
    id_type = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    return rows.mapInArrow(_rows(shared, id_type), schema).withColumnRenamed("vec_id", id_col)

"""Whitening of embeddings from an exact, bit-sliced scatter matrix.

Components are floored to integers. A task takes its vectors in blocks, shifts each dimension by its least value there, and
packs every bit plane of every dimension across the rows of the block into 64-bit words. The cross-product of two dimensions is
then the sum over their pairs of planes of popcount(a AND b), weighted by the planes' places: whole numbers, without
rounding. Blocks, tasks and the centring (n * sum of products - product of sums) stay whole numbers; only the centred matrix
is turned into doubles, for the eigenvectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import partition_sums, saved

SCALE = 256
COMPONENTS = 4
# Entries of a block: about 64,000 rows of 64 dimensions are packed together.
BLOCK = 1 << 22
_LONG = 1 << 63


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, x (BIGINT array of floor(scale * c)) of the rows that take part.

    Rows with a NULL vector or with a NULL or non-finite entry take no part; those with a NULL id do.
    """
    c = F.col("c")
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    given = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("c"))
    return given.filter(c.isNotNull() & finite).select("vec_id", F.transform("c", lambda v: F.floor(v * scale).cast("bigint")).alias("x"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def scatter(x: np.ndarray) -> np.ndarray:
    """Exact sums of products of all pairs of columns of (x, 1) as Python integers; the last row holds the sums and n."""
    rows = len(x)
    x = np.concatenate([x, np.ones((rows, 1), np.int64)], axis=1)
    low = x.min(0)
    shifted = x.astype(np.uint64) - low.astype(np.uint64)
    bits = [int(v).bit_length() for v in shifted.max(0)]
    dims = np.repeat(np.arange(len(bits)), bits)
    places = [p for b in bits for p in range(b)]
    planes = np.zeros((len(dims), -(-rows // 64)), np.uint64)
    for k, (d, p) in enumerate(zip(dims.tolist(), places)):
        packed = np.packbits(((shifted[:, d] >> np.uint64(p)) & np.uint64(1)).astype(np.uint8))
        planes[k].view(np.uint8)[:len(packed)] = packed
    kind = np.int64 if 2 * max(bits) + rows.bit_length() < 62 else object
    weight = np.array([1 << p for p in places], kind)
    sums = np.zeros(len(bits), kind)
    np.add.at(sums, dims, np.bitwise_count(planes).sum(1, dtype=np.int64).astype(kind) * weight)
    cross = np.zeros((len(bits), len(bits)), kind)
    first = np.searchsorted(dims, dims)
    for k, (d, p) in enumerate(zip(dims.tolist(), places)):
        both = np.bitwise_count(planes[first[k]:] & planes[k]).sum(1, dtype=np.int64)
        np.add.at(cross[d], dims[first[k]:], both.astype(kind) * weight[first[k]:] * (1 << p))
    cross = np.triu(cross) + np.triu(cross, 1).T
    low, sums = low.astype(object), sums.astype(object)
    return cross.astype(object) + np.outer(low, sums) + np.outer(sums, low) + rows * np.outer(low, low)


def total_scatter(fit: DataFrame, width: int) -> np.ndarray:
    """scatter() of column x of all rows. Tasks send one row per dimension; these are added per dimension, in tasks."""
    block = max(64, BLOCK // (width + 1) // 64 * 64)
    kind = "i int, cross array<string>"

    def rows_of(total: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for i, row in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([[str(v) for v in row]], pa.list_(pa.string()))], ["i", "cross"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = None, [], 0
        for batch in batches:
            x = _matrix(batch.column(0), width)
            while len(x):
                part, x = x[:block - size], x[block - size:]
                held.append(part)
                size += len(part)
                if size == block:
                    one = scatter(np.concatenate(held))
                    total, held, size = one if total is None else total + one, [], 0
        if size:
            one = scatter(np.concatenate(held))
            total = one if total is None else total + one
        if total is not None:
            yield from rows_of(dict(enumerate(total)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                one = np.array([int(v) for v in row["cross"]], object)
                total[row["i"]] = total[row["i"]] + one if row["i"] in total else one
        yield from rows_of(total)

    out = np.zeros((width + 1, width + 1), object)
    for row in fit.select("x").mapInArrow(each, kind).repartition("i").mapInArrow(add, kind).collect():
        out[row.i] = [int(v) for v in row.cross]
    return out


@dataclass
class Whitener:
    """What the fit found: n, sums per dimension, eigenvectors over the roots of their eigenvalues, shares of variance."""

    n: int
    sums: list[int]
    weights: np.ndarray
    explained: list[float]
    spread: int

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly; as Python integers where 64 bits might not do."""
        if self.n * self.spread < 1 << 62 and max(map(abs, self.sums), default=0) < 1 << 62 and self.n * int(np.abs(x).max(initial=0)) < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def whiten(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations / self.n).astype(np.float64) @ self.weights

    def squared(self, deviations: np.ndarray) -> pa.Array:
        if deviations.dtype != object and deviations.shape[1] * (self.n * self.spread) ** 2 < _LONG:
            return pa.array((deviations * deviations).sum(1))
        wide = deviations.astype(object)
        return pa.array([v if v < _LONG else None for v in (int(sum(row * row)) for row in wide)], pa.int64())


def fit_whitener(total: np.ndarray, spread: int, components: int = COMPONENTS) -> Whitener:
    """The components with the largest eigenvalues of the covariance (divisor n). One without variance beyond rounding
    has weights of zero."""
    width = len(total) - 1
    n, sums = int(total[-1, -1]), [int(v) for v in total[-1, :-1]]
    centred = n * total[:-1, :-1] - np.outer(np.array(sums, object), np.array(sums, object))
    covariance = np.array([[int(v) / n**2 for v in row] for row in centred], np.float64).reshape(width, width)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    trace = sum(int(centred[i, i]) for i in range(width)) / n**2
    solid = values > 16 * width * np.finfo(float).eps * (values.max(initial=0.0))
    weights = np.where(solid, vectors / np.sqrt(np.where(solid, values, 1.0)), 0.0)
    return Whitener(n, sums, weights, [float(v) / trace if s else 0.0 for v, s in zip(values, solid)], spread)


def identity_error(fit: DataFrame, model: Whitener) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity, from the vectors themselves.

    Means and centred products are formed per batch and merged pairwise. Components without variance are left out.
    """
    k, width = model.weights.shape[1], model.weights.shape[0]

    def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n, apart = a[0] + b[0], b[1:1 + k] - a[1:1 + k]
        return np.concatenate([[n], a[1:1 + k] + apart * (b[0] / n), a[1 + k:] + b[1 + k:] + np.outer(apart, apart).ravel() * (a[0] * b[0] / n)])

    def fold(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        total = None
        for batch in batches:
            if batch.num_rows:
                z = model.whiten(model.deviations(_matrix(batch.column(0), width)))
                mean = z.mean(0)
                one = np.concatenate([[len(z)], mean, ((z - mean).T @ (z - mean)).ravel()])
                total = one if total is None else merge(total, one)
        return total

    sums = partition_sums(fit.select("x"), fold, merge)
    solid = np.abs(model.weights).sum(0) > 0
    off = sums[1 + k:].reshape(k, k) / sums[0] - np.eye(k)
    return float(np.abs(off[np.ix_(solid, solid)]).max(initial=0.0))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE,
           components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per taking-part row and component.

    The fit is over the different integer vectors, each once, so a vector of very many rows weighs as much as any other.
    Shorter vectors count as padded with zeros. There are as many components as dimensions, at most `components`; one without variance
    has whitened and explained 0 and takes no part in identity_error. A deviation beyond 64 bits is NULL. Without a row that takes
    part, or with empty vectors alone, the result is empty.
    """
    given = quantised(vectors, id_col, vector_col, scale)
    size = F.size("x")
    seen = given.agg(F.max(size).alias("width"), F.min(size).alias("least"), F.min(F.array_min("x")).alias("low"),
                     F.max(F.array_max("x")).alias("high")).first()
    width = seen.width or 0
    kind = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if not width:
        return vectors.sparkSession.createDataFrame([], kind)
    low, high = (seen.low, seen.high) if seen.least == width else (min(seen.low, 0), max(seen.high, 0))
    if seen.least < width:
        given = given.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - size)))
    most = max(-low, high + 1)
    small = "smallint" if most <= 1 << 15 else "int" if most <= 1 << 31 else "bigint"
    given = given.withColumn("x", F.col("x").cast(f"array<{small}>"))
    fit = saved(given.select("x").distinct())
    model = fit_whitener(total_scatter(fit, width), high - low, components)
    error = identity_error(fit, model)
    shared = vectors.sparkSession.sparkContext.broadcast(model)
    names = [f.split()[0] for f in kind.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        k = len(model.explained)
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            apart = model.deviations(_matrix(batch.column(1), width))
            each = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, model.n, np.int64)), model.squared(apart).take(each), pa.array(model.whiten(apart).ravel()),
                pa.array(np.tile(model.explained, rows)), pa.array(np.full(rows * k, error))], names)

    return given.mapInArrow(run, kind)

"""Whitening of embeddings along the leading components of their covariance.

Vectors become whole numbers x = floor(64 c) + 1,000,000; the covariance is that of the distinct
x, each once.  Spark sums it in two passes (sums, then products of the centred vectors, one matrix
per task); its leading eigenpairs come from spectrum slicing (``spectrum``) on the d x d matrix, the
only thing that reaches the driver, and every row is projected in its task.

Defined cases: rows whose vector is null, empty or holds null, NaN, an infinity or an entry of
2^46 and more in size (no exact x) take no part, nor do rows whose length isn't the most frequent
one (of several the longest); rows with equal or null ids are each reported; components without
variance (below 1e-10 of the first) have no row, so one distinct vector, or none, gives no rows; a
deviation beyond a long is null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled
from .spectrum import leading

SCALE, SHIFT = 64, 1_000_000
LEAST_VARIANCE = 1e-10
_LIMIT = float(1 << 46)
_LOW_BITS = 26
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Whitening:
    """What a row needs: n, the integer centre and what is left of the sums, components (columns), their values."""

    n: int
    centre: np.ndarray
    left: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n*x - S per entry, exact: whole 64-bit numbers, or Python's beyond them."""
        away = x - self.centre
        if self.n * (int(np.abs(away).max(initial=0)) + 1) >= 1 << 62:
            away = away.astype(object)
        return away * self.n - self.left

    def project(self, dev: np.ndarray) -> np.ndarray:
        return (dev.astype(float) / self.n) @ (self.vectors / np.sqrt(self.values))


def _usable(v: Column) -> Column:
    return v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < _LIMIT))


def whole_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id, x of the rows that take part."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
    v = v.where(_usable(F.col("v")))
    most = v.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("d")).limit(1).collect()
    x = F.transform("v", lambda c: F.floor(c * F.lit(float(SCALE))) + F.lit(SHIFT))
    return v.where(F.size("v") == (most[0]["d"] if most else 0)).select("vec_id", x.cast("array<bigint>").alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _blocks(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Runs of rows of about a million entries."""
    for b in batches:
        if b.num_rows:
            step = max(1, (1 << 20) // max(1, len(b.column(at)[0])))
            for low in range(0, b.num_rows, step):
                part = b.slice(low, step)
                yield part, _matrix(part.column(at))


def _summed(rows: DataFrame, work, schema: str, by: list[str]) -> list:
    """``work`` gives one small table per task; their sums by ``by``."""
    parts = rows.mapInArrow(work, schema)
    return parts.groupBy(*by).agg(*[F.sum(c).alias(c) for c in parts.columns if c not in by]).collect()


def fit(vectors: DataFrame, components: int = 16) -> tuple[Whitening | None, float]:
    """The whitening of ``whole_vectors`` rows, and the largest error of the whitened covariance."""
    fits = settled(vectors.select("x").distinct(), "whitening-fit")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, 0, 0
        for _, x in _blocks(batches, 0):
            n += len(x)
            high = high + (x >> _LOW_BITS).sum(axis=0)
            low = low + (x & ((1 << _LOW_BITS) - 1)).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_pydict({"i": np.arange(len(low), dtype=np.int32), "n": np.full(len(low), n, np.int64), "high": high, "low": low})

    found = sorted(_summed(fits, sums, "i int, n long, high long, low long", ["i"]))
    if not found:
        return None, 0.0
    n, total = found[0]["n"], [(r["high"] << _LOW_BITS) + r["low"] for r in found]
    centre = np.array([s // n for s in total], np.int64)
    base = Whitening(n, centre, np.array([s % n for s in total], np.int64), np.zeros((len(total), 0)), np.zeros(0), 0.0)
    d = len(total)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((d, d))
        for _, x in _blocks(batches, 0):
            z = base.deviations(x).astype(float) / n
            out += z.T @ z
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "j": j.astype(np.int32), "v": out[i, j]})

    v = np.zeros((d, d))
    for r in _summed(fits, products, "i int, j int, v double", ["i", "j"]):
        v[r["i"], r["j"]] = v[r["j"], r["i"]] = r["v"] / n
    values, axes = leading(v, components)
    real = (values > 0) & (values > LEAST_VARIANCE * values[:1].max(initial=0))
    model = Whitening(n, base.centre, base.left, axes[:, real], values[real], float(np.trace(v)))
    k = int(real.sum())
    if not k:
        return None, 0.0

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((k + 1, k))  # the last row has the sums
        for _, x in _blocks(batches, 0):
            w = model.project(model.deviations(x))
            out[:k] += w.T @ w
            out[k] += w.sum(axis=0)
        i, j = np.indices(out.shape)
        yield pa.RecordBatch.from_pydict({"i": i.ravel().astype(np.int32), "j": j.ravel().astype(np.int32), "v": out.ravel()})

    got = np.zeros((k + 1, k))
    for r in _summed(fits, moments, "i int, j int, v double", ["i", "j"]):
        got[r["i"], r["j"]] = r["v"] / n
    mean = got[k]
    return model, float(np.abs(got[:k] - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = 16, column: str = "embedding") -> DataFrame:
    """Per remaining row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = whole_vectors(vectors, column)
    model, error = fit(rows, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], RESULT)
    k = len(model.values)
    number, explained = np.arange(1, k + 1, dtype=np.int32), model.values / model.trace
    top = (1 << 63) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x in _blocks(batches, 1):
            dev = model.deviations(x)
            small = dev.dtype != object and int(np.abs(dev).max(initial=0)) ** 2 * dev.shape[1] <= top
            square = (dev * dev).sum(axis=1) if small else [s if (s := sum(int(e) ** 2 for e in row)) <= top else None for row in dev]
            m = b.num_rows
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(number, m)), pa.array(np.full(m * k, model.n)),
                pa.array(square, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))), pa.array(model.project(dev).ravel()),
                pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, RESULT)

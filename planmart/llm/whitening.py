"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become whole numbers, ``floor(scale * entry)``. Each distinct vector
counts once: vectors are packed as bytes, made distinct by a hash aggregate
(copies fold map-side) and stored in blocks of rows. The principal
subspace is found by passes over these blocks: a pass sends a thin matrix Q to
the tasks, each adds up X'(XQ) of its centred rows, and an aggregate adds the
tasks' sums by dimension. A three-term recurrence over ``degree`` passes
applies a Chebyshev polynomial that is small on the unwanted spectrum (from 0
to the smallest Ritz value of the block) and grows fast above it; QR and a
Rayleigh-Ritz step follow, whose product is also the next recurrence's first
pass. The wanted pairs are certified by their residuals. The driver
holds matrices of dimension x block only; the covariance is never formed.

Defined cases: rows whose vector is null, empty, or holds a null, non-finite or
over-large (2**53 after scaling) entry are dropped, as are rows of another
length than the commonest one (the longer, if two are equally common);
null ids and repeated rows are kept each; components without variance
(at most 1e-12 of the largest) have null ``whitened`` and 0 ``explained``; no
rows, if none remain; further columns are kept in the struct ``row``. The sign
of a component makes its largest entry positive. ``deviation`` beyond 64 bits
is an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

SCALE = 256.0
COMPONENTS, OVERSAMPLE, DEGREE = 4, 20, 8
TOLERANCE, MAX_ROUNDS = 1e-13, 200  # of the residual, as a share of the largest eigenvalue
BLOCK_BYTES = 1 << 20
NO_VARIANCE = 1e-12
LIMIT = float(1 << 53)


class Whitening(NamedTuple):
    """What the passes found: sums and count of the fit list, eigenpairs, total variance, error of the identity."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def quantised(vectors: pa.Array, dimension: int, scale: float = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the good rows, their whole-number vectors as a matrix)."""
    vectors = vectors.cast(pa.large_list(pa.float64()))
    length = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(length == dimension)
    flat = vectors.take(pa.array(rows)).flatten()
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(scale * flat.to_numpy(zero_copy_only=False)).reshape(len(rows), dimension)
        good = (np.abs(x) < LIMIT).all(axis=1)  # a null entry is NaN here
    return rows[good], x[good].astype(np.int64)


def _dimension(df: DataFrame, vector_col: str) -> int:
    sizes = df.where(F.size(vector_col) > 0).groupBy(F.size(vector_col).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    return first.size if first else 0


def fit_blocks(df: DataFrame, dimension: int, vector_col: str, scale: float) -> DataFrame:
    """Every distinct vector once, in stored blocks: n rows of ``width`` bytes a number, row after row."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x = quantised(batch.column(0), dimension, scale)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary())], names=["x"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = max(1, BLOCK_BYTES // (8 * dimension))
        for batch in batches:
            packed = batch.column(0).to_pylist()
            for k in range(0, len(packed), rows):
                x = np.frombuffer(b"".join(packed[k:k + rows]), np.int64)
                size = int(np.abs(x).max())
                width = 2 if size < 1 << 15 else 4 if size < 1 << 31 else 8
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(x) // dimension], pa.int64()), pa.array([width], pa.int32()),
                     pa.array([x.astype(f"<i{width}").tobytes()], pa.binary())], names=["n", "width", "rows"])

    distinct = df.select(F.col(vector_col).alias("v")).mapInArrow(pack, "x binary").distinct()
    return materialize(distinct.mapInArrow(gather, "n long, width int, rows binary"), "fit")


def _matrices(batch: pa.RecordBatch, dimension: int) -> Iterator[np.ndarray]:
    for width, rows in zip(batch.column("width").to_pylist(), batch.column("rows"), strict=True):
        yield np.frombuffer(rows.as_buffer(), f"<i{width}").reshape(-1, dimension)


def _pass(blocks: DataFrame, dimension: int, part: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """Sum over all blocks of ``part(rows)``, a small matrix: added up in each task, then place by place by an aggregate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in _matrices(batch, dimension):
                p = part(x)
                total = p if total is None else total + p
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())],
                                             names=["place", "value"])

    sums = blocks.mapInArrow(run, f"place int, value {kind}").groupBy("place").agg(F.sum("value").alias("value"))
    return np.array([r.value for r in sorted(sums.collect())])  # as many rows as part() has places


def _rayleigh_ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(Ritz values falling, Ritz vectors, V times them) of an orthonormal block and its product."""
    h = q.T @ vq
    values, u = np.linalg.eigh((h + h.T) / 2)
    u = u[:, ::-1]
    return values[::-1], q @ u, vq @ u


def principal(product: Callable[[np.ndarray], np.ndarray], dimension: int, components: int = COMPONENTS,
              oversample: int = OVERSAMPLE, degree: int = DEGREE, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """The first eigenpairs of a covariance that is given by its product with thin matrices only."""
    wanted, block = min(components, dimension), min(dimension, components + oversample)
    q, _ = np.linalg.qr(np.random.default_rng(12).standard_normal((dimension, block)))
    vq = product(q)
    for _ in range(MAX_ROUNDS):
        values, q, vq = _rayleigh_ritz(q, vq)
        residual = np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max()
        if block == dimension or values[0] <= 0 or residual <= tolerance * values[0]:
            return values[:wanted], q[:, :wanted]
        half = max(values[-1], 1e-3 * values[0]) / 2  # the unwanted spectrum lies in [0, 2 * half]
        grown = (values[0] - half) / half
        scale = 1 / grown  # keeps the recurrence from overflowing: columns are those of T_k(A) / T_k(largest)
        before, now = q, (vq - half * q) * (scale / half)
        for _ in range(degree - 1):
            following = 1 / (2 * grown - scale)
            before, now = now, 2 * following / half * (product(now) - half * now) - scale * following * before
            scale = following
        q, _ = np.linalg.qr(now)
        vq = product(q)
    raise ArithmeticError(f"not certified after {MAX_ROUNDS} rounds: residual {residual}")


def fit(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, scale: float = SCALE,
        **options) -> Whitening | None:
    """The whitening of the distinct vectors of ``df``; None without rows."""
    dimension = _dimension(df, vector_col)
    if not dimension:
        return None
    blocks = fit_blocks(df, dimension, vector_col, scale)
    n = blocks.agg(F.sum("n")).first()[0]
    if not n:
        return None
    sums = _pass(blocks, dimension, lambda x: x.sum(axis=0, dtype=np.int64), "long")
    mean = sums / n

    def product(q: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            c = x - mean
            return c.T @ (c @ q)
        return _pass(blocks, dimension, part).reshape(q.shape) / n

    trace = _pass(blocks, dimension, lambda x: np.square(x - mean).sum(axis=0)).sum() / n
    values, vectors = principal(product, dimension, components, **options)
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    some = values > NO_VARIANCE * max(values[0], 0)
    values = np.where(some & (values > 0), values, 0)
    axes = vectors[:, values > 0] / np.sqrt(values[values > 0])
    error = 0.0
    if axes.shape[1]:
        def part(x: np.ndarray) -> np.ndarray:
            w = (x - mean) @ axes
            return np.vstack([w.T @ w, w.sum(axis=0)])
        got = _pass(blocks, dimension, part).reshape(-1, axes.shape[1]) / n
        error = float(np.abs(got[:-1] - np.outer(got[-1], got[-1]) - np.eye(axes.shape[1])).max())
    return Whitening(int(n), sums, values, vectors, float(trace), error)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Exact sums over the dimensions of (n * x - sums) ** 2, in 64 bits."""
    most = n * int(np.abs(x).max(initial=0)) + int(np.abs(sums).max(initial=0))
    if x.shape[1] * most * most < 1 << 63:
        return np.square(n * x - sums).sum(axis=1)
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]
    if max(exact) >= 1 << 63:
        raise OverflowError("deviation needs more than 64 bits")
    return np.array(exact, np.int64)


_OUT = ("component int, n long, deviation long, whitened double, explained double, identity_error double")


def whiten(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, scale: float = SCALE,
           **options) -> DataFrame:
    """A row for each remaining row (struct ``row``) and component: n, deviation, whitened, explained, identity_error."""
    rows = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), F.col(vector_col).alias("v"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, {_OUT}"
    found = fit(df, vector_col, components, scale, **options)
    if found is None:
        return rows.where(F.lit(False)).select("row", *[F.lit(None).cast(t).alias(c) for c, t in (
            x.split() for x in _OUT.split(", "))])
    n, sums, values, vectors, trace, error = found  # plain arrays and numbers go to the tasks
    mean, k = sums / n, len(values)
    axes = vectors / np.sqrt(np.where(values > 0, values, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = quantised(batch.column("v"), len(sums), scale)
            white = (x - mean) @ axes
            m = len(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(pa.array(np.repeat(at, k))),
                 pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, n), pa.int64()),
                 pa.array(np.repeat(_deviations(x, n, sums), k), pa.int64()),
                 pa.array(white.ravel(), pa.float64(), mask=np.tile(values <= 0, m)),
                 pa.array(np.tile(values / trace if trace else values, m), pa.float64()),
                 pa.array(np.full(m * k, error), pa.float64())],
                names=["row", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)

"""Whitening of embeddings by their leading principal components, found with Chebyshev-filtered subspace iteration.

Entries become the whole numbers x = floor(256 c). The fit list is every distinct x vector once; it is kept in blocks of
bounded size, and the covariance V of the list is never formed. What Spark computes is the pass Y -> XcᵀXcY / n over
the centred blocks: a small matrix goes out, one of the same size comes back.

One round of the iteration, on a basis of `BASIS` columns:

1. Rayleigh-Ritz: one pass gives VQ, the small eigenproblem of QᵀVQ gives Ritz values and vectors, VQ - QΘ their residuals.
2. If the residuals of the wanted vectors are down to rounding, the round ends the search: eigenvalues are certified to within the
   residual, vectors to within the residual over the gap.
3. Chebyshev filter: the three-term recurrence of T_m, one pass per degree, with the unwanted spectrum [0, least Ritz value] on
   [-1, 1]. There the filter stays below one, beyond it grows the faster the larger the eigenvalue. The degree is the
   largest that keeps the growth within `GROWTH`, so that columns stay independent in double precision.
4. QR of the filtered columns gives the next basis.

Defined results: vectors that are null, hold null or non-finite entries, or entries whose x does not fit a long, are dropped, and so are
vectors of another length than most have (of lengths equally frequent the largest stays). Rows with equal or null ids are rows each. Components of
eigenvalue zero (to rounding) are left out, so fewer rows come back where the fit list spans fewer than four dimensions, none
where it is a single vector. A deviation that does not fit a long is null. Other columns are ignored. Of two eigenvectors the one is
taken whose largest entry is positive.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from erpspark.llm.scratch import stored

COMPONENTS = 4
BASIS = 16
DEGREE, GROWTH = 16, 1e8
ROUNDS = 60
#: Relative size of residuals that are rounding only, and of eigenvalues that are zero.
ROUNDING, ZERO = 5e-15, 1e-12
BLOCK_BYTES = 1 << 22
LONGEST = 2**63 - 1


def whole(vector: Column) -> Column:
    """x of a vector, null where it is not one to keep."""
    inside = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float(2**54)), F.lit(False)) & ~F.isnan(c))
    return F.when(vector.isNotNull() & inside, F.transform(vector, lambda c: F.floor(F.lit(256.0) * c.cast("double"))))


def vectors(table: DataFrame, key: str, vector: str) -> DataFrame:
    """key and x of the rows to keep."""
    rows = table.select(F.col(key).alias("key"), whole(F.col(vector)).alias("x")).where("x is not null and size(x) > 0")
    usual = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("k"), F.desc("d")).first()
    return rows.where(F.size("x") == (usual["d"] if usual else 0))


def _matrix(column: pa.ListArray, d: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(-1, d)


def _smallest(x: np.ndarray) -> np.ndarray:
    """The rows in the narrowest integers that hold them."""
    for kind in (np.int16, np.int32):
        if np.abs(x).max(initial=0) <= np.iinfo(kind).max:
            return x.astype(kind)
    return x


def _to_blocks(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, held, rows = max(1, BLOCK_BYTES // (8 * d)), [], 0

        def block() -> pa.RecordBatch:
            x = _smallest(np.concatenate(held))
            return pa.record_batch([pa.array([x.itemsize], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["width", "block"])

        for batch in batches:
            x = _matrix(batch.column(0), d)
            for i in range(0, len(x), step):
                held.append(x[i : i + step])
                rows += len(held[-1])
                if rows >= step:
                    yield block()
                    held, rows = [], 0
        if held:
            yield block()

    return run


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for width, block in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            yield np.frombuffer(block.as_buffer(), f"i{width}").reshape(-1, d)


def summed(blocks: DataFrame, d: int, shape: tuple[int, int], part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all blocks of a small matrix computed from each block: partitions add up theirs, Spark adds those by row."""
    rows, columns = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for x in _blocks(batches, d):
            total += part(x.astype(np.float64))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(rows, dtype=np.int32)), *[pa.array(c) for c in np.ascontiguousarray(total.T)]], names=["i", *names])

    names = [f"c{j}" for j in range(columns)]
    parts = blocks.mapInArrow(run, ", ".join(["i int", *[f"{c} double" for c in names]]))
    out = np.zeros(shape)
    for r in parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).collect():  # `rows` of them
        out[r["i"]] = r[1:]
    return out


def ritz(basis: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values (falling), vectors and their images, from a basis Q and VQ."""
    small = basis.T @ image
    values, turn = np.linalg.eigh((small + small.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], basis @ turn, image @ turn


def degree(largest: float, edge: float) -> int:
    """Degree of the filter: as high as `GROWTH` lets the largest eigenvalue grow."""
    t = 2 * largest / edge - 1
    return DEGREE if t <= 1 else max(1, min(DEGREE, int(math.acosh(GROWTH) / math.acosh(t))))


def chebyshev(apply: Callable[[np.ndarray], np.ndarray], basis: np.ndarray, image: np.ndarray, edge: float, m: int) -> np.ndarray:
    """T_m of V, with [0, edge] on [-1, 1], applied to the basis; `image` is V times the basis."""
    before, now = basis, image * (2 / edge) - basis
    for _ in range(m - 1):
        before, now = now, 2 * (apply(now) * (2 / edge) - now) - before
    return now


@dataclass
class Model:
    """Fitted whitening: `vectors` has the unit eigenvectors in columns."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    residual: float
    rounds: int
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def leading(apply: Callable[[np.ndarray], np.ndarray], d: int, wanted: int) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Largest eigenvalues, vectors, largest residual relative to the first eigenvalue, and rounds."""
    basis = np.linalg.qr(np.random.default_rng(12).standard_normal((d, min(d, max(BASIS, 2 * wanted)))))[0]
    best, since, kept = math.inf, 0, None
    for turn in range(1, ROUNDS + 1):
        values, basis, image = ritz(basis, apply(basis))
        top = max(values[0], 0.0)
        if top == 0:
            return values[:0], basis[:, :0], 0.0, turn
        residual = float(np.linalg.norm(image - basis * values, axis=0)[:wanted].max() / top)
        if residual < best:
            since = 0 if residual < best / 2 else since + 1
            best, kept = residual, (values[:wanted].copy(), basis[:, :wanted].copy())
        else:
            since += 1
        if best <= ROUNDING or since >= 3 and best < 1e3 * ROUNDING:  # rounding can leave a little more
            break
        edge = max(values[-1], 1e-10 * top)
        filtered = chebyshev(apply, basis, image, edge, degree(top, edge))
        basis = np.linalg.qr(filtered / np.maximum(np.linalg.norm(filtered, axis=0), np.finfo(float).tiny))[0]
    values, found = kept
    live = values > ZERO * values[0]
    found = found[:, live]
    return values[live], found * np.sign(found[np.abs(found).argmax(axis=0), np.arange(found.shape[1])]), best, turn


def _exact_sums(d: int):
    """Per dimension i the sums of the low 32 bits and of the rest of its entries, and the rows: no sum overflows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, n = np.zeros(d, np.int64), np.zeros(d, np.int64), 0
        for x in _blocks(batches, d):
            wide = x.astype(np.int64)
            low += (wide & 0xFFFFFFFF).sum(axis=0)
            high += (wide >> 32).sum(axis=0)
            n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array(low), pa.array(high), pa.array(np.full(d, n, np.int64))], names=["i", "low", "high", "n"])

    return run


def fit(x: DataFrame, components: int = COMPONENTS) -> Model | None:
    """Whitening of the distinct vectors (column x); None without any."""
    first = x.first()
    if first is None:
        return None
    d = len(first["x"])
    blocks = stored(x.select("x").distinct().mapInArrow(_to_blocks(d), "width int, block binary"), "blocks")
    sums = blocks.mapInArrow(_exact_sums(d), "i int, low long, high long, n long").groupBy("i").agg(F.sum("low").alias("low"), F.sum("high").alias("high"), F.sum("n").alias("n"))
    rows = sorted(sums.collect(), key=lambda r: r["i"])  # one per dimension
    n, exact = rows[0]["n"], [r["low"] + (r["high"] << 32) for r in rows]
    mean = np.array([s / n for s in exact])
    spread = summed(blocks, d, (d, 1), lambda b: ((b - mean) ** 2).sum(axis=0)[:, None])

    def apply(y: np.ndarray) -> np.ndarray:
        def part(b: np.ndarray) -> np.ndarray:
            b -= mean
            return b.T @ (b @ y)

        return summed(blocks, d, y.shape, part) / n

    values, found, residual, turns = leading(apply, d, min(components, d))
    model = Model(n, exact, float(spread.sum() / n), values, found, residual, turns, 0.0)
    k = len(values)
    if k:
        scale = found / np.sqrt(values)

        def moments(b: np.ndarray) -> np.ndarray:
            w = (b - mean) @ scale
            return np.hstack((w.T @ w, w.sum(axis=0)[:, None]))

        both = summed(blocks, d, (k, k + 1), moments) / n
        model.identity_error = float(np.abs(both[:, :k] - np.outer(both[:, k], both[:, k]) - np.eye(k)).max())
    return model


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum of (n x - S)² per row; null beyond a long."""
    most = int(max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))))
    if (n * most + max(map(abs, sums))) ** 2 * x.shape[1] <= LONGEST:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    wide = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1)
    return [v if v <= LONGEST else None for v in wide.tolist()]


def _project(model: Model):
    d, k = model.vectors.shape
    mean, scale = model.mean, model.vectors / np.sqrt(model.values)
    explained = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), d)
            rows = len(x)
            far = pa.array(deviations(x, model.n, model.sums), pa.int64())
            at = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, model.n, np.int64)),
                    far.take(at),
                    pa.array(((x - mean) @ scale).ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, model.identity_error)),
                ],
                names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


def whiten(table: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Every kept row by component: n, deviation, whitened, explained and identity_error."""
    rows = vectors(table, key, vector)
    model = fit(rows, components)
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return table.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key)
    return rows.select("key", "x").mapInArrow(_project(model), schema).withColumnRenamed("key", key)

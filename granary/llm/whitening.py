"""Embedding whitening: leading principal components by Chebyshev-filtered subspace iteration."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import small_batches
from granary.session import stage

Product = Callable[[np.ndarray], np.ndarray]
#: Random probes of the certificate, which is wrong with a probability of at most 10 ** -PROBES.
PROBES = 10
#: Eigenvalues below this share of the largest count as no variance.
NOTHING = 1e-10


@dataclass(frozen=True)
class Whitening:
    """What is learnt: ``vectors`` has a component in each column, numbered by falling ``values``."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    passes: int = 0


def grid(vector: Column, scale: int) -> Column:
    """floor(scale * entry) of each entry as a long; null for a null vector or one with null or non-finite entries."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda c: F.floor(c.cast("double") * scale)))


def points(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """Rows to be whitened as (id, x), staged; vectors of another length than the most frequent one are left out."""
    small_batches(vectors.sparkSession, 10_000)
    rows = stage(vectors.select(F.col(id_col).alias("id"), grid(F.col(vec_col), scale).alias("x")).where("size(x) > 0"), "points")
    most = rows.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    return rows.where(F.size("x") == (most.length if most else 0))


def entries(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    """The vectors of a batch as the rows of a matrix of longs."""
    return batch.column(batch.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def summed(fit: DataFrame, shape: tuple[int, int], dims: int, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of the matrices that ``work`` gives for parts of the vectors of ``fit``.

    Every task adds up its own and Spark adds those entry by entry. The driver
    gets one matrix, whose shape the number of rows has no part in.
    """

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_row = np.zeros(shape), False
        for batch in batches:
            if batch.num_rows:
                total, any_row = total + work(entries(batch, dims)), True
        if any_row:
            at = np.arange(total.size)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total.ravel())], ["at", "v"])

    found = fit.select("x").mapInArrow(part, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros(shape[0] * shape[1])
    out[found["at"]] = found["v"]
    return out.reshape(shape)


def _orthonormal(block: np.ndarray) -> np.ndarray:
    return np.linalg.qr(block / np.maximum(np.linalg.norm(block, axis=0), 1e-300))[0]


def _low_end(alphas: list[float], betas: list[float]) -> float:
    """A cautious guess of the smallest eigenvalue from Lanczos coefficients; a wrong one only costs passes."""
    between = betas[:len(alphas) - 1]
    values, vectors = np.linalg.eigh(np.diag(alphas) + np.diag(between, 1) + np.diag(between, -1))
    return max(0.0, values[0] - betas[len(alphas) - 1] * abs(vectors[-1, 0]))


def certified(product: Product, q: np.ndarray, theta: np.ndarray, error: np.ndarray, k: int, trace: float, low: float,
              rng: np.random.Generator) -> bool:
    """Whether no eigenvalue outside the block is larger than its k-th.

    The converged part of the block is taken out of the matrix. What is left has
    an eigenvalue above the k-th only if a Chebyshev polynomial, small below the
    next Ritz value, is large somewhere; random probes would then come back
    longer, each with a chance of nine in ten.
    """
    converged = int(np.argmax(np.r_[error > 1e-6 * theta[0], True]))
    gone, coupling = q[:, :converged], float(np.linalg.norm(error[:converged]))
    bound = theta[k - 1] - coupling
    if trace - theta.sum() + coupling <= theta[k - 1]:  # all that is left together is less
        return True
    high = float(theta[min(converged, len(theta) - 1)])
    middle, half = (high + low) / 2, (high - low) / 2
    if converged < k or half <= 0 or bound <= high * (1 + 1e-6):
        return False
    rate, wanted = np.arccosh((bound - middle) / half), 64 * np.sqrt(len(q))
    degree = int(np.ceil(np.arccosh(wanted) / rate))
    if degree > 150:
        return False
    clean = lambda y: y - gone @ (gone.T @ y)
    start = clean(rng.normal(size=(len(q), PROBES)))
    last, now = start, clean(product(start) - middle * start) / half
    for _ in range(degree - 1):
        last, now = now, 2 * clean(product(now) - middle * now) / half - last
    return 8 * np.linalg.norm(now, axis=0).max() < np.cosh(degree * rate)


def leading(product: Product, dims: int, k: int, trace: float, guard: int = 28, degree: int = 8, tolerance: float = 1e-13,
            cycles: int = 40, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a covariance matrix and their vectors; fewer where the rest has no variance.

    ``product`` gives the matrix times a block. A block of k + ``guard`` random
    directions goes through a Chebyshev polynomial that is small from the lowest
    eigenvalue, which Lanczos steps in the same passes tell, to the lowest Ritz
    value; then QR and Rayleigh-Ritz, whose residuals need no pass of their own.
    That ends when the residuals of the k are at rounding and :func:`certified`
    holds. A block that isn't certified grows, at last to all dimensions, where
    Rayleigh-Ritz is exact. Equal eigenvalues give any basis of their space.
    """
    rng, size = np.random.default_rng(seed), min(dims, k + guard)
    q = _orthonormal(rng.normal(size=(dims, size)))
    probe, alphas, betas, before = _orthonormal(rng.normal(size=(dims, 1))), [], [], np.zeros((dims, 1))
    low, worst, cycle = 0.0, np.inf, 0

    def times(block: np.ndarray) -> np.ndarray:
        """The product; in the first passes with a Lanczos step beside it."""
        nonlocal probe, before, low
        if len(alphas) > degree or size == dims:
            return product(block)
        found = product(np.hstack([block, probe]))
        step = found[:, -1:]
        alphas.append((probe * step).sum())
        step = step - alphas[-1] * probe - (betas[-1] if betas else 0.0) * before
        betas.append(np.linalg.norm(step))
        low = _low_end(alphas, betas) if len(alphas) > degree // 2 else 0.0
        before, probe = probe, step / max(betas[-1], 1e-300)
        return found[:, :-1]

    aq = times(q)
    while True:
        theta, turn = np.linalg.eigh((q.T @ aq + aq.T @ q) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        q, aq = q @ turn, aq @ turn
        error = np.linalg.norm(aq - q * theta, axis=0)
        wanted = int((theta[:k] > NOTHING * max(theta[0], 1e-300)).sum())
        now = error[:wanted].max() / theta[0] if wanted else 0.0
        settled = now <= tolerance or (now <= 1e-10 and now > worst / 3)
        left = trace - theta.sum()
        if size == dims or (wanted < k and now <= 1e-10 and left <= NOTHING * trace):
            break
        if wanted == k and settled:
            if certified(product, q, theta, error, k, trace, low, rng):
                break
            cycle = cycles
        cycle, worst = cycle + 1, now
        if cycle > cycles:
            size, cycle, worst = min(dims, 2 * size), 0, np.inf
            q = _orthonormal(np.hstack([q, rng.normal(size=(dims, size - q.shape[1]))]))
            aq = times(q)
            continue
        high = max(theta[-1], 1e-3 * theta[0])
        floor = min(low, high / 2) if low >= high else low
        middle, half = (high + floor) / 2, (high - floor) / 2
        # A higher degree would make the first column drown the others.
        steps = int(np.clip(np.arccosh(1e6) / np.arccosh(max(1 + 1e-9, (theta[0] - middle) / half)), 1, degree))
        last, block = q, (aq - middle * q) / half
        for _ in range(steps - 1):
            last, block = block, 2 * (times(block) - middle * block) / half - last
        q = _orthonormal(block)
        aq = times(q)
    return theta[:wanted], q[:, :wanted]


def distinct_points(rows: DataFrame) -> DataFrame:
    """Each vector once, staged; repeated ones are put together before they travel."""
    return stage(rows.select("x").distinct(), "distinct-points")


def fit(distinct: DataFrame, components: int = 4) -> Whitening:
    """Learn from the vectors of :func:`distinct_points`.

    Sums are exact. Every pass takes the mean from each vector before it
    multiplies, and is a Spark job over the staged vectors. No rows, or none
    that differ, give a whitening without components.
    """
    found = distinct.select(F.posexplode("x").alias("dim", "v")).groupBy("dim").agg(F.sum("v").alias("s"), F.count("*").alias("n")).orderBy("dim").collect()
    if not found:
        return Whitening(0, (), np.empty(0), np.empty((0, 0)), 0.0)
    n, sums, dims, passes = found[0].n, tuple(r.s for r in found), len(found), [0]
    mean = np.array([s / n for s in sums])

    def product(block: np.ndarray) -> np.ndarray:
        def work(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ block)

        passes[0] += 1
        return summed(distinct, block.shape, dims, work) / n

    trace = summed(distinct, (1, 1), dims, lambda x: np.array([[((x - mean) ** 2).sum()]]))[0, 0] / n
    values, vectors = leading(product, dims, min(components, dims), trace) if trace > 0 else (np.empty(0), np.empty((dims, 0)))
    return Whitening(n, sums, values, vectors, trace, passes[0])


def _exact(model: Whitening) -> Callable[[np.ndarray], np.ndarray]:
    """n * x - S, in longs where their squares' sum fits into one, else in Python's integers."""
    sums, n, dims = model.sums, model.n, len(model.sums)

    def off(x: np.ndarray) -> np.ndarray:
        largest = int(max(x.max(), -x.min(), 0)) * n + max(map(abs, sums))
        kind = np.int64 if dims * largest * largest < 1 << 62 else object
        return x.astype(kind) * n - np.array(sums, kind)

    return off


def identity_error(model: Whitening, distinct: DataFrame) -> float:
    """How far the covariance of the whitened distinct vectors is from the identity, at its worst entry."""
    dims, k = model.vectors.shape
    if not k:
        return 0.0
    white = _whiten(model)
    mean = summed(distinct, (1, k), dims, lambda x: white(x).sum(axis=0, keepdims=True)) / model.n
    covariance = summed(distinct, (k, k), dims, lambda x: (white(x) - mean).T @ (white(x) - mean)) / model.n
    return float(np.abs(covariance - np.eye(k)).max())


def _whiten(model: Whitening) -> Callable[[np.ndarray], np.ndarray]:
    off, turn, n = _exact(model), model.vectors / np.sqrt(model.values), model.n
    return lambda x: (off(x) / n).astype(float) @ turn


def apply(model: Whitening, rows: DataFrame) -> DataFrame:
    """For each row (id, x) and component: deviation, the sum of (n * x - S)^2, exactly, and the whitened value.

    A deviation of more than 38 digits raises.
    """
    dims, k = model.vectors.shape
    kind = rows.schema["id"].dataType.simpleString()
    off, white = _exact(model), _whiten(model)

    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and k:
                x = entries(batch, dims)
                again = np.repeat(np.arange(batch.num_rows), k)
                deviation = pa.array((off(x) ** 2).sum(axis=1).tolist(), pa.decimal128(38, 0))
                ids = batch.column(batch.schema.get_field_index("id"))
                component = pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows))
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(again)), component, deviation.take(pa.array(again)), pa.array(white(x).ravel())],
                                                 ["id", "component", "deviation", "whitened"])

    return rows.mapInArrow(whitened, f"id {kind}, component int, deviation decimal(38,0), whitened double")


def whiten(vectors: DataFrame, components: int = 4, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Whitened coordinates of every vector on the leading components, one row for each vector and component.

    Vectors that are null, empty, hold null or non-finite entries or have
    another length than most are left out; a null id stays. Repeated vectors
    count once in the fit and come back as often as they are there. Components
    without variance are left out, so fewer distinct vectors or dimensions give
    fewer components, and one distinct vector or an empty table no rows. Other
    columns are not looked at.
    """
    rows = points(vectors, id_col, vec_col, scale)
    distinct = distinct_points(rows)
    model = fit(distinct, components)
    share = F.array(*[F.lit(float(v / model.trace)) for v in model.values], F.lit(0.0))
    return (apply(model, rows).withColumns({"n": F.lit(model.n).cast("long"), "explained": F.get(share, F.col("component") - 1),
                                            "identity_error": F.lit(identity_error(model, distinct))})
            .select(F.col("id").alias(id_col), "component", "n", "deviation", "whitened", "explained", "identity_error"))

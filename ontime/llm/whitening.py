"""Whitening of embeddings: leading principal components by Chebyshev-filtered subspace iteration over distributed products."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import prepare_workers
from ontime.llm.vectors import ROWS_PER_BATCH, matrix, on_grid, shape, sums_over

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8  # fixed by the result contract
GUARDS = 2  # further columns of the block, per wanted component
BOUND_STEPS = 8
LARGEST_DEGREE = 20
GROWTH = 1e10  # largest amplification of one filter: beyond it the columns of a block become dependent
TOLERANCE = 1e-13
STALLED = 1e-11
ROUNDS = 200

Product = Callable[[np.ndarray], np.ndarray]
_FIELDS = "component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass
class Spectrum:
    """Leading eigenvalues, unit eigenvectors (columns), largest residual relative to the first value, products taken."""

    values: np.ndarray
    vectors: np.ndarray
    residual: float
    passes: int


def _spectral_bounds(product: Product, size: int, rng: np.random.Generator) -> tuple[float, float]:
    """An interval around the spectrum from a few Lanczos steps: extreme Ritz values, widened by the last residual."""
    q, before = rng.standard_normal(size), np.zeros(size)
    q /= np.linalg.norm(q)
    basis, diagonal, beside = [q], [], []
    for _ in range(min(BOUND_STEPS, size)):
        w = product(basis[-1][:, None])[:, 0]
        diagonal.append(float(basis[-1] @ w))
        w = w - diagonal[-1] * basis[-1] - (beside[-1] * before if beside else 0)
        for b in basis:  # full orthogonalisation: the basis is tiny
            w = w - (b @ w) * b
        beside.append(float(np.linalg.norm(w)))
        if beside[-1] <= 1e-12 * max(map(abs, diagonal)):
            break
        before = basis[-1]
        basis.append(w / beside[-1])
    k = len(diagonal)
    ritz = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(beside[: k - 1], 1) + np.diag(beside[: k - 1], -1))
    return max(0.0, float(ritz[0]) - beside[-1]), float(ritz[-1]) + beside[-1]


def _orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    for _ in range(2):  # once more for what the first projection leaves by rounding
        block = block - against @ (against.T @ block)
        block = np.linalg.qr(block)[0]
    return block


def leading_spectrum(product: Product, size: int, wanted: int = COMPONENTS, seed: int = 7) -> Spectrum:
    """The ``wanted`` largest eigenpairs of a symmetric positive semidefinite matrix known by its products only.

    Each round filters a block with a Chebyshev polynomial that is small on the unwanted interval and grows fast above it
    (one product per degree), makes it orthonormal (QR) and solves the small projected problem (Rayleigh-Ritz). Leading
    pairs whose residual is within ``TOLERANCE`` of the largest value are locked and moved into the unwanted interval,
    so that they neither grow nor limit the degree. A random column enters every round. The result is certified when
    ``wanted`` pairs are locked and a whole further round, fresh columns included, finds no value above the last of them.
    """
    rng = np.random.default_rng(seed)
    passes = 0

    def counted(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return product(q)

    wanted = min(wanted, size)
    width = min(size, wanted * (1 + GUARDS))
    low, high = _spectral_bounds(counted, size, rng)
    locked, locked_values = np.zeros((size, 0)), np.zeros(0)
    worst = 0.0
    block = _orthonormal(rng.standard_normal((size, width)), locked)
    image = counted(block)
    proven, best, stalled = False, math.inf, 0
    for _ in range(ROUNDS):
        values, turn = np.linalg.eigh((block.T @ image + image.T @ block) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        low = max(0.0, min(low, float(values[-1])))  # the filter may have found the interval too narrow
        top = max([*locked_values, values[0] if len(values) else 0.0, 0.0])
        errors = np.linalg.norm(image - block * values, axis=0) / (top or 1.0)
        enough = len(locked_values) >= wanted
        if enough and proven and (not len(values) or values[0] <= np.sort(locked_values)[-wanted] * (1 + 1e-12)):
            break
        proven = enough
        if len(errors):  # rounding keeps a residual from falling further: take it as it is
            stalled = stalled + 1 if errors[0] > best / 2 else 0
            best = errors[0] if stalled == 0 else min(best, errors[0])
        limit = STALLED if stalled >= 3 else TOLERANCE
        whole = len(values) + len(locked_values) >= size  # the block spans the space: the small problem is the whole one
        n_done = len(values) if whole else 0
        while n_done < len(values) and errors[n_done] <= limit and (not enough or values[n_done] > locked_values.min()):
            n_done += 1
        if n_done:
            locked = np.hstack([locked, block[:, :n_done]])
            locked_values = np.concatenate([locked_values, values[:n_done]])
            worst = max(worst, float(errors[:n_done].max()))
            block, image, values = block[:, n_done:], image[:, n_done:], values[n_done:]
            best, stalled = math.inf, 0
            if whole:
                break
        if top == 0.0:  # the zero matrix
            break
        room = min(width, size - locked.shape[1])
        fresh = max(1, room - block.shape[1])  # at least one column is drawn anew
        cut, first = (float(values[min(len(values), room) - 1]), float(values[0])) if len(values) else (high, high)
        block = _orthonormal(np.hstack([block[:, : room - fresh], rng.standard_normal((size, fresh))]), locked)
        block = _filtered(counted, block, low, max(cut, low + 1e-9 * top), first, locked, locked_values)
        block = _orthonormal(block, locked)
        image = counted(block)
    else:
        raise ArithmeticError(f"no certified spectrum after {ROUNDS} rounds")
    order = np.argsort(locked_values)[::-1][:wanted]
    order = order[locked_values[order] > 1e-12 * locked_values.max()] if len(order) else order
    return Spectrum(locked_values[order], locked[:, order], worst, passes)


def _filtered(
    product: Product, block: np.ndarray, low: float, cut: float, top: float, locked: np.ndarray, locked_values: np.ndarray
) -> np.ndarray:
    """T_m((A - centre) / half) of the block by the scaled three-term recurrence, with locked pairs moved to the centre."""
    centre, half = (cut + low) / 2, (cut - low) / 2

    def shifted(q: np.ndarray) -> np.ndarray:
        return product(q) - locked @ ((locked_values - centre)[:, None] * (locked.T @ q)) - centre * q

    reach = max((top - centre) / half, 1.0 + 1e-6)
    degree = max(2, min(LARGEST_DEGREE, int(math.log(GROWTH) / math.acosh(reach))))
    sigma = first = 1.0 / reach
    before, now = block, shifted(block) * (sigma / half)
    for _ in range(degree - 1):
        following = 1.0 / (2.0 / first - sigma)
        before, now = now, shifted(now) * (2.0 * following / half) - (sigma * following) * before
        sigma = following
    return now


def _exact_squares(differences: np.ndarray) -> list[int | None]:
    """Sum of squares of each row as a whole number; None where it does not fit a long."""
    if float(np.square(differences.astype(np.float64)).sum(axis=1).max(initial=0)) < 9e18:
        return np.square(differences).sum(axis=1).tolist()
    totals = (sum(v * v for v in row) for row in differences.tolist())
    return [t if t < 1 << 63 else None for t in totals]


def whitened(embeddings: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Every usable row's projections on the leading principal components, divided by their standard deviations.

    Rows whose vector is null or holds null or non-finite entries are dropped; an entry c becomes
    x = floor(1024 c) + 100000. Returns one row per vector and component: vec_id, component (from 1, by falling
    eigenvalue), n (vectors), deviation (sum over the dimensions of (n x - S)^2, S the sums; null where it exceeds a
    long), whitened, explained (eigenvalue over trace) and identity_error (largest absolute entry of the covariance of
    ``whitened`` minus the identity, one value for all rows).

    The covariance is never formed: each product with a block is one pass over the staged rows, centred before they are
    multiplied, of which only sums of fixed size leave the tasks. Components without variance are left out, so vectors of
    rank r give min(r, ``components``) rows each, and equal vectors none. Repeated vec_ids keep a row each; null vec_ids
    stay. Vectors of different lengths are an error. Empty table or no usable row: empty result; other columns are ignored.
    """
    spark = embeddings.sparkSession
    rows = on_grid(embeddings, vector, SCALE, SHIFT, "vec_id")
    n, size, _ = shape(rows)
    fields = f"vec_id {dict(embeddings.dtypes)['vec_id']}, {_FIELDS}"
    if not n or not size:
        return spark.createDataFrame([], fields)
    totals = sums_over(rows, size, lambda x: x.sum(axis=0), np.int64)

    def centred(x: np.ndarray) -> np.ndarray:
        return (n * x - totals) / n

    def product(q: np.ndarray) -> np.ndarray:
        def of_batch(x: np.ndarray) -> np.ndarray:
            y = centred(x)
            return y.T @ (y @ q)

        return sums_over(rows, size, of_batch).reshape(q.shape) / n

    trace = float(sums_over(rows, size, lambda x: np.array([np.square(centred(x)).sum()]))[0]) / n
    if trace == 0.0:
        return spark.createDataFrame([], fields)
    found = leading_spectrum(product, size, components)
    k = len(found.values)
    weights = found.vectors / np.sqrt(found.values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = centred(x) @ weights
        return np.vstack([w.sum(axis=0), w.T @ w])

    sums = sums_over(rows, size, moments).reshape(k + 1, k) / n
    identity_error = float(np.abs(sums[1:] - np.outer(sums[0], sums[0]) - np.eye(k)).max())
    explained = found.values / trace
    prepare_workers(spark, ROWS_PER_BATCH)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            differences = n * matrix(batch, size) - totals
            values = (differences / n) @ weights
            ids = batch.column(batch.schema.get_field_index("vec_id"))
            every = pa.array(np.repeat(np.arange(m), k))
            squares = pa.array(_exact_squares(differences), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(every), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, dtype=np.int64)), squares.take(every), pa.array(values.ravel()),
                    pa.array(np.tile(explained, m)), pa.array(np.full(m * k, identity_error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.select("vec_id", F.col("x")).mapInArrow(project, fields)

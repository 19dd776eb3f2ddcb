"""Whitening of embeddings along the leading eigenvectors of their covariance: Chebyshev-filtered subspace iteration."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch_rows, cut

SCALE, SHIFT = 1024, 100_000
#: Residual at which an eigenpair counts as exact, as a share of the largest eigenvalue.
TOLERANCE = 1e-13
#: Eigenvalues below this share of the largest are zero: there is nothing to whiten along them.
ZERO = 1e-12


def scaled_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x), cut: vectors without null or non-finite entries as whole numbers floor(1024 c) + 100000.

    An entry too large for a 64-bit number counts as non-finite.
    """
    fits = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 2.0**52)
    vectors = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    fit = vectors.filter(F.col("v").isNotNull() & F.forall("v", fits))
    entries = F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + SHIFT)
    return cut(fit.select("vec_id", entries.alias("x")), rows=10_000)


def matrix_of(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of whole numbers; a shorter vector has zeros (x = 100000) at its end."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = np.diff(column.offsets.to_numpy())
    if len(values) == len(lengths) * width and (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.full((len(lengths), width), SHIFT, np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def summed(vectors: DataFrame, shape: int, kind: str, of_batch: Callable[[pa.ListArray], np.ndarray]) -> np.ndarray:
    """Sum over all batches of ``of_batch``, an array of ``shape`` numbers: one array per task, added place by place by Spark."""
    element = pa.int64() if kind == "<i8" else pa.float64()

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(shape, kind)
        for batch in batches:
            held += of_batch(batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, shape], pa.int32()), pa.array(held, element))], ["sums"])

    with batch_rows(vectors.sparkSession, 10_000):
        parts = vectors.select("x").mapInArrow(partial, f"sums array<{'long' if kind == '<i8' else 'double'}>")
        added = parts.select(F.posexplode("sums").alias("at", "part")).groupBy("at").agg(F.sum("part").alias("total")).collect()
    out = np.zeros(shape, kind)
    for r in added:
        out[r["at"]] = r["total"]
    return out


@dataclass(frozen=True)
class Spectrum:
    """Leading eigenpairs of the covariance of ``n`` vectors with ``sums``; ``residual`` is the largest, as a share of the first value."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    passes: int
    residual: float

    @property
    def mean(self) -> np.ndarray:
        return self.sums / max(1, self.n)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ (self.vectors / np.sqrt(self.values))


def filtered(
    apply: Callable[[np.ndarray], np.ndarray], block: np.ndarray, applied: np.ndarray, degree: int, top: float, cutoff: float
) -> np.ndarray:
    """The Chebyshev polynomial of ``degree`` that is small on [0, cutoff], 1 at ``top``, of the operator, applied to the block.

    ``applied`` is the operator on the block, known already: a degree of m takes m - 1 passes.
    """
    half = cutoff / 2
    sigma = first = half / (top - half)
    before, now = block, (applied - half * block) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (apply(now) - half * now) * (2 * after / half) - (sigma * after) * before
        sigma = after
    return now


def leading_eigenpairs(
    apply: Callable[[np.ndarray], np.ndarray], width: int, count: int, guard: int = 32, degree: int = 8, most_rounds: int = 100, seed: int = 7
) -> tuple[np.ndarray, np.ndarray, float]:
    """(values, vectors, residual) of the ``count`` largest eigenpairs of a positive semidefinite operator, certified.

    ``apply(Q)`` is one pass over the data. Each round orthonormalizes a block of ``count + guard`` vectors (QR), takes
    its Ritz pairs and their residuals, and unless those are below TOLERANCE filters the block: eigenvalues up to
    the block's smallest are damped, those above grow by the polynomial's steepness beyond its interval.
    """
    if guard < 1:
        raise ValueError("without a guard vector the filter damps the last of the wanted eigenvalues")
    count, size = min(count, width), min(width, count + guard)
    block = np.random.default_rng(seed).standard_normal((width, size))
    best = None
    for _ in range(most_rounds):
        block, _ = np.linalg.qr(block)
        applied = apply(block)
        ritz = block.T @ applied
        values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, applied = block @ turn, applied @ turn
        if values[0] <= 0:
            return values[:count], block[:, :count], 0.0
        errors = np.linalg.norm(applied - block * values, axis=0) / values[0]
        residual = float(errors[:count].max())
        if best is None or residual < best[2]:
            best = values[:count], block[:, :count], residual
        if residual <= TOLERANCE:
            return best
        block = filtered(apply, block, applied, degree, values[0], max(values[-1], values[0] * 1e-9))
    raise RuntimeError(f"eigenpairs are not certified after {most_rounds} rounds: residual {best[2]:.1e}")


def fit(vectors: DataFrame, count: int = 8, **options) -> Spectrum | None:
    """The spectrum of ``vectors`` (vec_id, x; cut), from passes in which each task sums what it reads; None without vectors."""
    shape = vectors.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width")).first()
    n, width = shape["n"], shape["width"] or 0
    if not n:
        return None
    sums = summed(vectors, width, "<i8", lambda x: matrix_of(x, width).sum(axis=0))
    mean = sums / n
    passes = 0

    def apply(block: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def part(x: pa.ListArray) -> np.ndarray:
            z = matrix_of(x, width) - mean
            return (z.T @ (z @ block)).ravel()

        return summed(vectors, block.size, "<f8", part).reshape(block.shape) / n

    trace = float(summed(vectors, 1, "<f8", lambda x: ((matrix_of(x, width) - mean) ** 2).sum().reshape(1))[0] / n)
    if not trace:
        return Spectrum(n, sums, np.empty(0), np.empty((width, 0)), 0.0, passes, 0.0)
    values, found, residual = leading_eigenpairs(apply, width, count, **options)
    keep = values > ZERO * values[0]
    return Spectrum(n, sums, values[keep], found[:, keep], trace, passes, residual)


def identity_error(vectors: DataFrame, spectrum: Spectrum) -> float:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity."""
    width, k = len(spectrum.sums), len(spectrum.values)

    def sums(x: pa.ListArray) -> np.ndarray:
        return spectrum.whitened(matrix_of(x, width)).sum(axis=0)

    center = summed(vectors, k, "<f8", sums) / spectrum.n

    def products(x: pa.ListArray) -> np.ndarray:
        w = spectrum.whitened(matrix_of(x, width)) - center
        return (w.T @ w).ravel()

    covariance = summed(vectors, k * k, "<f8", products).reshape(k, k) / spectrum.n
    return float(np.abs(covariance - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exactly; None where it does not fit 64 bits."""
    spread = max(int(np.abs(x).max(initial=0)) * n, int(np.abs(sums).max(initial=0))) * 2
    if spread < 1 << 62:
        apart = x * n - sums
        largest = int(np.abs(apart).max(initial=0))
        if largest * largest * max(1, x.shape[1]) < 1 << 63:
            return (apart * apart).sum(axis=1).tolist()
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [e if e < 1 << 63 else None for e in exact]


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, count: int = 8, id_col: str = "vec_id", vector_col: str = "embedding", **options) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per vector and component.

    Entries become whole numbers first (see scaled_vectors). Vectors that are null or hold null or non-finite
    entries are left out; all others are fitted and whitened: the centred vector projected on the unit eigenvector
    ``component`` (from 1, by falling eigenvalue) of the covariance with divisor n, over the root of its eigenvalue. Eigenvectors come from
    certified Chebyshev-filtered subspace iteration over passes of the table; only sums of a fixed size reach the driver.

    There are ``count`` components, or fewer if the vectors span fewer dimensions: one vector, or equal vectors, give no rows. Equal
    eigenvalues (ties) have any orthonormal basis of their space. Shorter vectors, empty ones too, are filled up with zeros. Rows that repeat count each; null
    identifiers stay null. No rows give no rows; other columns are ignored. ``deviation`` is null where it does not fit 64 bits.
    """
    vectors = scaled_vectors(embeddings, id_col, vector_col)
    spectrum = fit(vectors, count, **options)
    if spectrum is None or not len(spectrum.values):
        return embeddings.sparkSession.createDataFrame([], RESULT)
    error = identity_error(vectors, spectrum)
    width, k = len(spectrum.sums), len(spectrum.values)
    explained = spectrum.values / spectrum.trace

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix_of(batch.column("x"), width)
            m = len(x)
            ids = batch.column("vec_id").take(pa.array(np.repeat(np.arange(m), k)))
            apart = pa.array(deviations(x, spectrum.n, spectrum.sums), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, spectrum.n, np.int64)),
                    apart,
                    pa.array(spectrum.whitened(x).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return cut(vectors.mapInArrow(rows, RESULT), rows=10_000)

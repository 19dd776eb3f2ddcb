"""Embedding whitening against a full eigendecomposition in numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import embedding_whitening as ew


def expected(vectors, k=8):
    x = np.floor(1024 * np.asarray(vectors, np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    z = x - sums / n
    cov = z.T @ z / n
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1][:k], basis[:, ::-1][:, :k]
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return z @ basis / np.sqrt(values), values / np.trace(cov), exact


def made(n, d, seed=3):
    rng = np.random.default_rng(seed)
    return rng.standard_normal((n, d)) @ np.diag(1.05 ** -np.arange(d)) @ np.linalg.qr(rng.standard_normal((d, d)))[0] * 0.2


def compare(found, ids, vectors, k=8):
    white, explained, exact = expected(vectors, k)
    rows = {(r["vec_id"], r["component"]): r for r in found.collect()}
    assert len(rows) == found.count() == len(vectors) * white.shape[1]
    got = np.array([[rows[i, c + 1]["whitened"] for c in range(white.shape[1])] for i in ids])
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got - white * signs).max() < 1e-8
    for i, e in zip(ids, exact):
        assert rows[i, 1]["deviation"] == e and rows[i, 1]["n"] == len(vectors)
    assert np.allclose([rows[ids[0], c + 1]["explained"] for c in range(white.shape[1])], explained, rtol=1e-9)
    assert len({r["identity_error"] for r in rows.values()}) == 1 and rows[ids[0], 1]["identity_error"] < 1e-9


@pytest.mark.parametrize("d", [3, 20, 64])
def test_against_eigh(spark, d):
    vectors = made(300, d)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    compare(ew.whiten(df.repartition(5), 8), list(range(300)), vectors, min(8, d))


def test_odd_rows(spark):
    """Nulls, non-finite entries and other columns; repeated rows count each; floats are read as doubles."""
    vectors = made(60, 12).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    bad = [(100, None), (101, [None] * 12), (102, [math.nan] * 12), (103, [math.inf] + [0.0] * 11), (104, [0.0] * 11 + [None]), (105, [1e300] * 12)]
    df = spark.createDataFrame([*rows, *bad, (200, vectors[0].tolist())], "vec_id long, embedding array<float>")
    found = ew.whiten(df.withColumns({c: F.lit("!") for c in ("x", "v", "n", "bucket", "component")}))
    compare(found, [*range(60), 200], [*vectors, vectors[0]])


def test_short_vectors_have_zeros_at_their_end(spark):
    vectors = made(40, 6)
    vectors[3, 4:] = 0
    vectors[7] = 0
    rows = [(i, v.tolist()[: 4 if i == 3 else 0 if i == 7 else 6]) for i, v in enumerate(vectors)]
    compare(ew.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 4), list(range(40)), vectors, 4)


@pytest.mark.parametrize("rows", [[], [(1, [0.5, 0.25])], [(1, [0.5, 0.25])] * 5, [(1, None)], [(1, [])]])
def test_nothing_to_whiten(spark, rows):
    found = ew.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert found.columns == "vec_id component n deviation whitened explained identity_error".split()
    assert found.count() == 0


def test_fewer_dimensions_than_components(spark):
    """Vectors on a line have one component; null identifiers are rows like any other."""
    rows = [(None if i % 2 else i, [0.25 * i, 0.5 * i, 1.0]) for i in range(10)]
    found = ew.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["component"] for r in found} == {1} and len(found) == 10
    assert abs(sum(r["whitened"] ** 2 for r in found) / 10 - 1) < 1e-12 and found[0]["explained"] == pytest.approx(1)


@pytest.mark.parametrize("guard", [2, 8, 24])
def test_filtered_iteration(guard):
    """Close eigenvalues, a small guard: more passes, the same certified pairs."""
    rng = np.random.default_rng(5)
    basis = np.linalg.qr(rng.standard_normal((80, 80)))[0]
    spectrum = np.concatenate((np.linspace(2, 1.5, 9), np.linspace(1.4, 0, 71)))
    operator = basis @ np.diag(spectrum) @ basis.T
    passes = []
    values, vectors, residual = ew.leading_eigenpairs(lambda q: passes.append(1) or operator @ q, 80, 8, guard=guard)
    assert residual <= ew.TOLERANCE and np.allclose(values, spectrum[:8], rtol=1e-12)
    assert np.abs(np.abs(vectors.T @ basis[:, :8]) - np.eye(8)).max() < 1e-9


def test_deviations_beyond_64_bits():
    x = np.array([[100_000, 200_000], [100_000, 100_000]], np.int64)
    n = 10**9
    sums = np.array([10**14, 10**14], np.int64)
    assert ew.deviations(x, n, sums) == [None, 0]
    small = np.array([[100_000 + 3, 100_000]], np.int64)
    assert ew.deviations(small, 10**9, sums) == [9 * 10**18]

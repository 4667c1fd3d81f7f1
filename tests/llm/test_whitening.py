"""Whitening against a library's eigenvectors and exact integers."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphline.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>"


def _expected(rows):
    """For each vector size the plain fit, and the integer vectors of the rows that take part."""
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v):
            kept.append((vec_id, tuple(math.floor(64 * float(np.float32(c))) + 10**6 for c in v)))
    fits = {}
    for size in {len(x) for _, x in kept}:
        fit = sorted({x for _, x in kept if len(x) == size})
        n, sums = len(fit), [sum(c) for c in zip(*fit)]
        centred = np.array([[c - s / n for c, s in zip(x, sums)] for x in fit])
        values, vectors = np.linalg.eigh(centred.T @ centred / n)
        fits[size] = n, sums, values[::-1], vectors[:, ::-1]
    return kept, fits


def _check(found, rows):
    kept, fits = _expected(rows)
    seen = {}
    for r in found:
        seen.setdefault((r["vec_id"], r["deviation"]), []).append(r)
    count = 0
    for vec_id, x in kept:
        n, sums, values, vectors = fits[len(x)]
        rank = min(16, int((values > values[0] * 1e-12).sum())) if values[0] > 0 else 0
        count += rank
        if not rank:
            continue
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        own = [next(r for r in seen[vec_id, deviation] if r["component"] == k + 1) for k in range(rank)]
        for k, r in enumerate(own):
            assert r["n"] == n
            assert r["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-9)
            assert r["identity_error"] < 1e-9
            score = (np.array(x) - np.array(sums) / n) @ vectors[:, k] / math.sqrt(values[k])
            assert abs(r["whitened"]) == pytest.approx(abs(score), rel=1e-6, abs=1e-8)
    assert len(found) == count


def test_query_on_given_vectors(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    found = whitening.op12_embedding_whitening(spark, sf_dir)
    assert dict(found.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
        "explained": "double", "identity_error": "double",
    }
    _check(found.collect(), rows)


def test_odd_rows_copies_sizes_and_low_rank(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(0, 0.3, 6).tolist()) for k in range(80)]
    rows += [(100 + k, rows[0][1]) for k in range(40)] + [(1, rows[5][1]), (None, rows[6][1])]
    rows += [(200 + k, (k * np.array([2, 0, 4, 6, 0]) / 64 + 1).tolist()) for k in range(9)]  # rank 1 of size 5
    rows += [(300, [1.0, 2.0, 3.0]), (301, [1.0, 2.0, 3.0])]  # one distinct vector: no variance
    rows += [(400, None), (401, []), (402, [None] * 6), (403, [float("nan")] + [0.0] * 5), (404, [float("inf")] + [0.0] * 5)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("x", "n", "size", "whitened")})
    docs.write.parquet(f"{tmp_path}/embeddings.parquet")
    _check(whitening.op12_embedding_whitening(spark, str(tmp_path)).collect(), rows)


def test_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert whitening.op12_embedding_whitening(spark, str(tmp_path)).collect() == []


def test_covariance_of_copies_is_that_of_the_fit_list(spark):
    rows = [(k, [k % 7, (k * k) % 11, 3 * (k % 7) + 1]) for k in range(200)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, x array<bigint>")
    model = whitening.fit_whitening(vectors, "x")[3]
    distinct = np.array(sorted({tuple(x) for _, x in rows}))
    assert model.n == len(distinct)
    w = model.whitened(distinct)
    assert np.abs(np.cov(w.T, bias=True) - np.eye(2)).max() < 1e-12


@pytest.mark.parametrize(("d", "n", "rank"), [(64, 3000, 64), (5, 40, 5), (7, 60, 3), (1, 9, 1), (20, 12, 11), (6, 1, 0)])
def test_decomposition(d, n, rank):
    rng = np.random.default_rng(d)
    x = rng.integers(-500, 500, (n, d)) if rank == min(d, n - 1) else rng.integers(-9, 9, (n, max(1, rank))) @ rng.integers(-20, 20, (max(1, rank), d))
    y = x - x.mean(axis=0)
    spread = y.T @ y
    factor = whitening.pivoted_cholesky(spread)
    assert factor.shape == (d, rank)
    assert np.abs(factor @ factor.T - spread).max() <= 1e-11 * max(1, spread.max())
    g = whitening.one_sided_jacobi(factor)
    norms = (g**2).sum(axis=0)
    assert np.abs(g.T @ g - np.diag(norms)).max(initial=0) <= 1e-12 * max(1, norms.max(initial=0))
    expected = np.linalg.eigvalsh(spread)[::-1][:rank]
    assert norms == pytest.approx(expected, rel=1e-9)


def test_small_eigenvalues_keep_their_digits():
    """Columns of very different length: squaring them once more would lose the short ones."""
    rng = np.random.default_rng(8)
    factor = np.linalg.qr(rng.normal(size=(6, 6)))[0] * np.array([1e8, 1e4, 1, 1e-4, 1e-6, 1e-7])
    g = whitening.one_sided_jacobi(factor)
    assert np.sqrt((g**2).sum(axis=0)) == pytest.approx([1e8, 1e4, 1, 1e-4, 1e-6, 1e-7], rel=1e-12)


def test_numbers_too_large_for_exact_arithmetic_stay_defined(spark):
    rows = [(1, [1e300, 0.0]), (2, [1e10, 1.0]), (3, [-1e10, 2.0]), (4, [0.0, 3.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, v array<double>").select("vec_id", whitening.quantised("v").alias("x"))
    found = {r["vec_id"]: r for r in whitening.whiten(vectors).collect()}
    assert set(found) == {2, 3, 4} and all(r["n"] == 3 for r in found.values())
    assert found[4]["deviation"] is not None

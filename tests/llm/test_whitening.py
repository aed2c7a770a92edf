"""Whitening by rank-one updates against a dense eigendecomposition."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import whitening
from shelfcast.llm.queries import QUERIES
from shelfcast.llm.whitening import Grid, Spectrum, fit, rank_one, secular_roots, whiten

SCHEMA = "vec_id long, embedding array<float>"


def dense(x):
    """Exact centring, then numpy: (eigenvalues falling, vectors, trace)."""
    n = len(x)
    off = np.array([[n * int(v) - int(s) for v, s in zip(r, x.sum(axis=0), strict=True)] for r in x], float) / n
    values, vectors = np.linalg.eigh(off.T @ off / n)
    return off, values[::-1], vectors[:, ::-1], np.trace(off.T @ off / n)


def test_secular_roots_and_deflation():
    rng = np.random.default_rng(3)
    d, z = np.sort(rng.normal(size=40)) * 100, rng.normal(size=40)
    d[5] = d[4] + 1e-9
    roots, differences = secular_roots(d, z)
    assert np.allclose(roots, np.linalg.eigvalsh(np.diag(d) + np.outer(z, z)), rtol=1e-12, atol=1e-10)
    assert np.allclose(differences, roots[:, None] - d, atol=1e-9)
    values, vectors = np.zeros(12), np.eye(12)
    total = np.zeros((12, 12))
    for k in range(40):  # equal eigenvalues at first, then repeated and zero updates
        u = rng.normal(size=12) * 10.0 ** (k % 5) if k % 7 else np.zeros(12)
        u = np.eye(12)[3] * 5 if k % 11 == 4 else u
        values, vectors = rank_one(values, vectors, u)
        total += np.outer(u, u)
        assert np.allclose(vectors.T @ vectors, np.eye(12), atol=1e-9)
        assert np.allclose(vectors * values @ vectors.T, total, atol=1e-9 * max(1, np.trace(total)))


def test_spectra_combine(monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(90, 10)) * np.arange(1, 11) * 50).astype(np.int64) + 100_000
    parts = [Spectrum(10) for _ in range(3)]
    for p, rows in zip(parts, (x[:40], x[40:41], x[41:]), strict=True):
        p.add(rows)
    for p in parts[1:]:
        parts[0].join(p.n, p.sums, p.mean, p.values, p.vectors)
    _, values, _, _ = dense(x)
    assert np.allclose(parts[0].values[::-1] / 90, values, rtol=1e-9)
    assert parts[0].n == 90 and parts[0].sums == x.sum(axis=0).tolist()


def checked(rows, x, ids):
    """Rows of ``whiten`` against the dense result for grid rows ``x`` with distinct ids."""
    off, values, vectors, trace = dense(x)
    k = min(8, x.shape[1])
    assert len(rows) == len(ids) * k
    got = {(r["vec_id"], r["component"]): r for r in rows}
    n, sums = len(x), [int(s) for s in x.sum(axis=0)]
    white = np.array([[got[i, c + 1]["whitened"] for c in range(k)] for i in ids])
    for c in range(k):
        want = off @ vectors[:, c] / math.sqrt(values[c])
        assert np.abs(white[:, c] * np.sign(white[:, c] @ want) - want).max() < 1e-8
        assert all(abs(got[i, c + 1]["explained"] - values[c] / trace) < 1e-10 for i in ids)
    for i, r in zip(ids, x, strict=True):
        assert got[i, 1]["n"] == n and got[i, 1]["deviation"] == sum((n * int(v) - s) ** 2 for v, s in zip(r, sums, strict=True))
    assert {r["identity_error"] for r in rows} == {rows[0]["identity_error"]} and rows[0]["identity_error"] < 1e-9


def test_query_matches_dense_algebra(spark, tiny):
    raw = spark.read.parquet(f"{tiny}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = [r["vec_id"] for r in raw]
    x = np.floor(1024 * np.array([r["embedding"] for r in raw])).astype(np.int64) + 100_000
    checked(QUERIES["op12_whitening"](spark, tiny).collect(), x, ids)


def test_many_partitions_and_a_hot_vector(spark):
    rng = np.random.default_rng(5)
    m = np.vstack([rng.normal(size=(150, 6)) * [1, 2, 3, 4, 5, 6], np.tile(rng.normal(size=6), (100, 1))]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], SCHEMA).repartition(70)
    checked(whiten(df).collect(), np.floor(1024 * m.astype(float)).astype(np.int64) + 100_000, list(range(250)))


def test_awkward_vectors(spark):
    rng = np.random.default_rng(6)
    good = [(i if i != 3 else None, rng.normal(size=4).tolist()) for i in range(20)] * 2
    bad = [(50, None), (51, []), (52, [1.0, None, 2.0, 3.0]), (53, [1.0, float("nan"), 0.0, 0.0]), (54, [float("inf"), 0.0, 0.0, 0.0]), (55, [1.0, 2.0])]
    df = spark.createDataFrame(good + bad, SCHEMA).withColumn("component", F.lit("clash")).repartition(5)
    rows = whiten(df).collect()
    assert len(rows) == 40 * 4 and {r["n"] for r in rows} == {40} and rows[0]["identity_error"] < 1e-9
    assert whiten(df.limit(0)).count() == 0 and whiten(df.filter("vec_id >= 50 AND vec_id < 55")).count() == 0
    equal = whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).collect()
    assert len(equal) == 4 and all(r["whitened"] is None and r["deviation"] == 0 and r["explained"] == 0.0 and r["identity_error"] == 0.0 for r in equal)
    flat = whiten(spark.createDataFrame([(i, [float(i), float(i), 0.0]) for i in range(5)], SCHEMA)).collect()
    assert [r["whitened"] is None for r in flat if r["vec_id"] == 4] == [False, True, True]
    huge = whiten(spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0])], SCHEMA)).collect()
    assert len(huge) == 6 and all(r["deviation"] is None for r in huge if r["vec_id"] != 3)


def test_fit_is_for_any_grid(spark):
    df = spark.createDataFrame([(i, [float(i % 7), float(i % 5), 1.0]) for i in range(35)], SCHEMA)
    model = fit(df, 2, "embedding", Grid(scale=10, shift=0))
    assert model.n == 35 and model.values[0] == pytest.approx(400.0) and model.trace == pytest.approx(600.0)

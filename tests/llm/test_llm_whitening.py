"""Whitening against a dense eigendecomposition, and its edge cases."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.llm import whitening
from tessera.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>"


def dense(rows, components=32):
    """(ids, x integers, deviations, eigenvalues, whitened, trace) of clean rows, by one dense eigendecomposition."""
    good = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in good], object)
    n, sums = len(x), x.sum(axis=0)
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    centred = np.array((n * x - sums) / n, float)
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return [i for i, _ in good], deviation.tolist(), e, centred @ u / np.sqrt(e), float((centred ** 2).sum() / n)


def test_query_matches_a_dense_decomposition(spark, small_sf):
    table = pd.read_parquet(f"{small_sf}/embeddings.parquet")
    ids, deviation, e, white, trace = dense(list(zip(table.vec_id, table.embedding)))
    got = QUERIES["op12_whitening"](spark, small_sf).toPandas()
    assert len(got) == len(ids) * 32 and (got.n == len(ids)).all() and got.identity_error.nunique() == 1 and got.identity_error.max() < 1e-9
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    sign = np.sign((wide * white).sum(axis=0))
    assert np.abs(wide * sign - white).max() < 1e-8
    assert got.groupby("vec_id").deviation.first().loc[ids].tolist() == deviation
    assert np.allclose(got.groupby("component").explained.first().to_numpy(), e / trace, rtol=1e-10)


@pytest.mark.parametrize("dim,want", [(1, 1), (3, 3), (40, 12), (300, 20)])
def test_pairs_of_a_dense_matrix(dim, want):
    x = np.random.default_rng(dim).normal(size=(2000, dim))
    a = x.T @ x / len(x)
    values, axes, _ = whitening.jacobi_davidson(lambda v: a @ v, dim, want)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:want]).max() < 1e-12
    assert np.abs(a @ axes - axes * values).max() < 1e-12 and np.abs(axes.T @ axes - np.eye(want)).max() < 1e-12


def test_repeated_eigenvalues_are_all_found():
    spectrum = np.array([5.0, 5, 5, 5, 2, 2, *[1.0] * 94])
    q = np.linalg.qr(np.random.default_rng(0).normal(size=(100, 100)))[0]
    a = (q * spectrum) @ q.T
    values, axes, _ = whitening.jacobi_davidson(lambda v: a @ v, 100, 8)
    assert np.abs(values - spectrum[:8]).max() < 1e-12 and np.abs(a @ axes - axes * values).max() < 1e-11


def test_minres_solves_an_indefinite_system():
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.normal(size=(30, 30)))[0]
    a = (q * np.linspace(-3, 4, 30)) @ q.T
    right = rng.normal(size=(30, 2))
    got = whitening.minres(lambda v: a @ v, lambda v: v, np.array([0.05, 0.0]), right, 40, 1e-12)
    assert np.abs(a @ got - got * [0.05, 0.0] - right).max() < 1e-9


def test_edge_cases(spark):
    rng = np.random.default_rng(5)
    plain = [(i, [float(c) for c in rng.normal(size=4)]) for i in range(40)]
    odd = [(100, None), (101, []), (102, [1.0, None, 0.0, 0.0]), (103, [float("nan"), 0.0, 0.0, 0.0]), (104, [float("inf"), 0.0, 0.0, 0.0]), (105, [1.0, 2.0])]
    rows = [*plain, plain[0], (None, [0.5, 0.25, -1.0, 3.0])]
    ids, deviation, e, white, trace = dense(rows)
    df = spark.createDataFrame([*rows, *odd], VECTORS).withColumns({c: F.lit("mine") for c in ("x", "id", "ids", "n", "component", "dim")})
    got = whitening.whiten(df).toPandas()
    assert len(got) == 42 * 4 and got.vec_id.isna().sum() == 4 and (got.vec_id == 0).sum() == 8
    assert sorted(got[got.component == 1].deviation) == sorted(deviation)
    for c in range(4):
        own, want = np.sort(got[got.component == c + 1].whitened), np.sort(white[:, c])
        assert min(np.abs(own - want).max(), np.abs(np.sort(-own) - want).max()) < 1e-9


def test_degenerate_tables(spark):
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, VECTORS)).count() == 0
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 7.0]) for i in range(10)], VECTORS)
    got = whitening.whiten(flat).toPandas()
    assert got.component.unique().tolist() == [1] and np.isclose(got.whitened.std(ddof=0), 1) and np.allclose(got.explained, 1)
    huge = spark.createDataFrame([(1, [3e38]), (2, [-3e38]), (3, [0.0])], VECTORS)
    assert whitening.whiten(huge).count() == 3 and whitening.whiten(huge).where("deviation is null").count() == 2

"""Whitening against numpy's eigenvectors and exact integers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terroir.llm import queries, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def usable(rows, width):
    out = []
    for i, v in rows:
        if v is not None and len(v) == width and all(c is not None and np.isfinite(c) for c in v):
            out.append((i, [int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v]))
    return out


def check(df, rows, width, components):
    want = usable(rows, width)
    n = len(want)
    x = np.array([v for _, v in want], dtype=object)
    s = x.sum(axis=0)
    z = ((x * n - s).astype(float)) / n
    v = z.T @ z / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    got = df.toPandas()
    assert sorted(got["vec_id"].dropna()) == sorted(i for i, _ in want if i is not None for _ in range(components))
    assert len(got) == n * components and set(got["n"]) == {n}
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] <= 1e-9
    explained = got.groupby("component")["explained"].first().to_numpy()
    assert list(got.groupby("component")["explained"].first().index) == list(range(1, components + 1))
    np.testing.assert_allclose(explained, values / np.trace(v), rtol=1e-10)
    exact = {i: sum((n * c - t) ** 2 for c, t in zip(row, s)) for i, row in want}
    assert all(exact[i] == d for i, d in zip(got["vec_id"], got["deviation"]))
    whitened = got.pivot(index="vec_id", columns="component", values="whitened").loc[[i for i, _ in want]].to_numpy()
    plain = z @ vectors / np.sqrt(values)
    sign = np.sign((whitened * plain).sum(axis=0))
    np.testing.assert_allclose(whitened * sign, plain, atol=1e-8)


def test_query_against_eigh(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(queries.op12_jacobi_davidson(spark, SF), rows, 64, 32)


def test_unusable_vectors_and_extra_columns(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(6).astype(np.float32).tolist()) for i in range(40)]
    bad = [(100, None), (101, []), (102, [1.0] * 5), (103, [1.0] * 7), (104, [float("nan")] + [0.0] * 5),
           (105, [float("inf")] + [0.0] * 5), (106, [None] + [0.0] * 5), (107, [3e38] * 6)]
    df = spark.createDataFrame(rows + bad, SCHEMA).withColumns({c: F.lit(1) for c in ("id", "x", "n", "component", "part", "vector")})
    check(whitening.whiten(df, 6), rows, 6, 6)


def test_repeated_and_null_ids(spark):
    rows = [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (None, [5.0, 2.0]), (2, [3.0, -1.0])]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA), 2).collect()
    assert len(got) == 8 and sum(r["vec_id"] is None for r in got) == 2 and got[0]["identity_error"] < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None), (2, [])]])
def test_no_variance_no_rows(spark, rows):
    assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_dimensions_without_variance_are_left_out(spark):
    rows = [(i, [float(i), 7.0, float(-2 * i), float(i * i % 5)]) for i in range(20)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA), 4)
    assert sorted({r["component"] for r in got.collect()}) == [1, 2] and got.first()["identity_error"] < 1e-6


@pytest.mark.parametrize("width,wanted,rank", [(50, 5, 50), (200, 32, 200), (120, 20, 120), (40, 40, 40), (30, 10, 12)])
def test_pairs_to_double_precision(width, wanted, rank):
    """Spectra with clusters; the operator is seen through its products only."""
    rng = np.random.default_rng(width)
    q = np.linalg.qr(rng.standard_normal((width, width)))[0]
    e = np.where(np.arange(width) < rank, np.repeat(np.geomspace(1e3, 1e-3, (width + 1) // 2), 2)[:width], 0)
    v = (q * e) @ q.T
    seen = []

    def product(b):
        seen.append(b.shape)
        return v @ b

    vectors, values = whitening.jacobi_davidson(product, width, wanted)
    np.testing.assert_allclose(values, np.sort(e)[::-1][:wanted], atol=1e-11 * e.max())
    assert np.abs(v @ vectors - vectors * values).max() < 1e-11 * e.max()
    assert np.abs(vectors.T @ vectors - np.eye(wanted)).max() < 1e-12
    assert all(b <= width for _, b in seen)


def test_minres_solves_the_projected_equations():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((30, 30))
    v = a @ a.T
    u = np.linalg.qr(rng.standard_normal((30, 3)))[0]
    theta = (u * (v @ u)).sum(axis=0)
    project = lambda m: m - u * (u * m).sum(axis=0)
    r = project(v @ u - u * theta)
    t = whitening.minres(lambda b: v @ b, theta, project, r, 60)
    assert np.abs(project(v @ t - t * theta) + r).max() < 1e-6 * np.abs(r).max()
    assert np.abs((u * t).sum(axis=0)).max() < 1e-10


def test_large_counts_stay_exact():
    x = np.array([[2 ** 31 - 1, -(2 ** 31)]])
    n, s = 2 ** 40, np.array([5, -7])
    assert whitening._deviations(x, n, s).tolist() == [[(2 ** 31 - 1) * n - 5, -(2 ** 31) * n + 7]]

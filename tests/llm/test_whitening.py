"""Whitening against numpy's symmetric eigensolver; the bidiagonal solver on hard matrices."""

from __future__ import annotations

import numpy as np
import pytest

from slotcast.llm import bidiagonal, whitening
from slotcast.llm.queries import QUERIES

RNG = np.random.default_rng(11)


def orthogonal(n):
    return np.linalg.qr(RNG.normal(size=(n, n)))[0]


MATRICES = {
    "random": np.linalg.qr(RNG.normal(size=(500, 40)))[1],
    "graded": np.linalg.qr(RNG.normal(size=(300, 30)) * np.logspace(0, -9, 30))[1],
    "identity": np.eye(7), "zero": np.zeros((4, 4)), "rank one": np.ones((6, 6)), "single": np.array([[-3.0]]),
    "rank ten": np.linalg.qr(np.concatenate([RNG.normal(size=(10, 30)), np.zeros((30, 30))]))[1],
    "repeated": orthogonal(40) * np.repeat([5.0, 4, 3, 2, 1], 8) @ orthogonal(40),
    "close": orthogonal(40) * (1 + 1e-13 * RNG.normal(size=40)) @ orthogonal(40),
    "coupled": np.diag([1.0, 1, 1, 2, 2]) + np.diag([1e-9] * 4, 1),
    "tiny": 1e-150 * RNG.normal(size=(12, 12)), "huge": 1e150 * RNG.normal(size=(12, 12)),
}


@pytest.mark.parametrize("name", MATRICES)
def test_singular_values_and_vectors(name):
    r = MATRICES[name]
    values, v = bidiagonal.right_singular(r)
    want = np.linalg.svd(r, compute_uv=False)
    assert np.allclose(np.sqrt(values), want, rtol=1e-12, atol=1e-14 * want[0] if want[0] else 0)
    size = np.abs(r).max() or 1.0
    gram = (r / size).T @ (r / size)
    assert np.allclose(v.T @ v, np.eye(v.shape[1]), atol=1e-8)
    assert np.allclose(gram @ v, v * (values[:v.shape[1]] / size / size), atol=1e-8 * (want[0] / size) ** 2)
    assert v.shape[1] == (want > len(r) * 1e-15 * want[0]).sum() if want[0] else v.shape[1] == 0


def test_bidiagonal_values_are_relatively_exact():
    """dqds keeps tiny values of a bidiagonal matrix that forming B'B would lose."""
    diagonal, upper = 10.0 ** -np.arange(12), 0.5 * 10.0 ** -np.arange(11)
    got = np.sort(bidiagonal.squared_singular_values(diagonal, upper))
    assert np.isclose(np.prod(np.sqrt(got)), np.prod(diagonal), rtol=1e-13)
    assert np.isclose(np.log10(got[0]), -22, atol=0.5)


def expected(vectors, k):
    x = np.floor(64 * np.asarray(vectors, float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    c = x - s / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    rank = int((e > e[0] * 1e-20 * n).sum()) if e[0] > 1e-9 else 0
    k = min(k, rank, n - 1)
    return c @ v[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum(), ((n * x - s) ** 2).sum(1)


def test_query_equals_dense_solution(spark, sf_dir):
    rows = sorted(map(tuple, spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()))
    w, explained, far = expected([v for _, v in rows], 32)
    got = {}
    for r in QUERIES["op11_whitening"](spark, sf_dir).collect():
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert sorted(got) == [i for i, _ in rows]
    g = np.array([[got[i][c]["whitened"] for c in range(1, 33)] for i, _ in rows])
    assert np.allclose(g * np.sign((g * w).sum(0)), w, atol=1e-8)
    assert all(got[i][c]["deviation"] == far[k] and got[i][c]["n"] == len(rows) for k, (i, _) in enumerate(rows) for c in (1, 32))
    assert np.allclose([got[rows[0][0]][c]["explained"] for c in range(1, 33)], explained, rtol=1e-10)
    assert all(r["identity_error"] < 1e-9 for r in got[rows[0][0]].values())


SCHEMA = "vec_id bigint, embedding array<float>, n int, v string, whitened string"


def test_awkward_rows(spark):
    good = [(i, RNG.normal(size=3).astype(np.float32).tolist()) for i in range(40)] + [(None, [1.0, 2.0, 3.0])] * 2
    bad = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [float("nan"), 1.0, 1.0]), (94, [float("inf"), 1.0, 1.0]), (95, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in good + bad], SCHEMA).repartition(40)
    rows = whitening.usable(df)
    model = whitening.fit(rows, scale=64, shift=1_000_000)
    w, explained, far = expected([v for _, v in good], 32)
    found = whitening.long_form(rows, model).collect()
    assert len(found) == 3 * len(good) and np.allclose(model.explained, explained)
    assert sorted(r["deviation"] for r in found if r["component"] == 1) == sorted(far)
    assert whitening.identity_error(rows, model) < 1e-10
    kept = model.apply(df).collect()
    assert len(kept) == len(df.collect()) and sorted(r["vec_id"] for r in kept if r["whitened"] is None) == [90, 91, 92, 93, 94, 95]
    assert kept[0].asDict().keys() == {"vec_id", "embedding", "n", "v", "whitened"}


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [[0.0], [0.0]], [[1.0, 1.0], [2.0, 2.0], [4.0, 4.0]]])
def test_few_or_equal_rows(spark, vectors):
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<float>")
    rows = whitening.usable(df)
    model = whitening.fit(rows, scale=64, shift=1_000_000)
    found = whitening.long_form(rows, model).collect()
    assert found == [] or {r["component"] for r in found} == {1}
    if not found:
        assert model is None or whitening.identity_error(rows, model) is None


def test_without_scale_and_many_factors(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    x = RNG.normal(size=(300, 5)) * [1, 2, 3, 4, 5] + 1e6
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id bigint, embedding array<double>").repartition(9)
    model = whitening.fit(whitening.usable(df), components=5)
    w = np.array([r["whitened"] for r in model.apply(df).collect()])
    assert np.allclose(w.T @ w / len(w), np.eye(5), atol=1e-8)
    assert np.allclose(model.eigenvalues, np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1], rtol=1e-8)


def test_exact_deviation_beyond_longs():
    from fractions import Fraction

    n = 1 << 24
    model = whitening.Whitening(n, np.array([10]), np.array([0.5]), [Fraction(21, 2)], np.zeros(0), np.zeros((1, 0)), 64, 0)
    x = np.array([[10], [11], [1 << 30]])
    assert whitening.deviation(x, model) == [(n // 2) ** 2, (n // 2) ** 2, None]

"""Ridge weights against numpy's solution of the normal equations."""

from __future__ import annotations

import numpy as np
import pytest

from slotcast.operators import stacking

NAMES = ["a", "b", "c", "d"]


def frame(spark, x, y, fold=None):
    data = [(*map(float, r), float(t), int(f)) for r, t, f in zip(x, y, fold if fold is not None else np.zeros(len(y)))]
    return spark.createDataFrame(data, ", ".join(f"{n} double" for n in NAMES) + ", y_log double, fold int")


def solved(x, y, alpha):
    c, t = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(c.T @ c + alpha * np.eye(x.shape[1]), c.T @ t)
    return w, y.mean() - w @ x.mean(0)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 4)) * [1, 2, 0.1, 50] + [0, -3, 1, 700]
    return x, x @ [0.5, -0.2, 1, 0.001] - 2 + 0.1 * rng.normal(size=400), rng.integers(0, 4, 400)


@pytest.mark.parametrize("alpha", [0.0, 1.0, 100.0])
def test_weights(spark, data, alpha):
    x, y, _ = data
    row = stacking.fit(frame(spark, x, y), NAMES, alpha=alpha).first()
    w, b = solved(x, y, alpha)
    assert [row[f"w_{n}"] for n in NAMES] == pytest.approx(w, rel=1e-7, abs=1e-10) and row["intercept"] == pytest.approx(b, rel=1e-7)


def test_cross_validation(spark, data):
    x, y, fold = data
    rows = frame(spark, x, y, fold)
    got = {r["alpha"]: r["r2"] for r in stacking.cross_validate(rows, NAMES, "fold", [0.1, 50.0]).collect()}
    t = np.clip(np.exp(y), 1e-6, 1)
    for alpha, r2 in got.items():
        p = np.empty(len(y))
        for f in range(4):
            w, b = solved(x[fold != f], y[fold != f], alpha)
            p[fold == f] = x[fold == f] @ w + b
        p = np.clip(np.exp(p), 1e-6, 1)
        assert r2 == pytest.approx(1 - ((t - p) ** 2).sum() / ((t - t.mean()) ** 2).sum(), rel=1e-8)
    best = stacking.best_alpha(stacking.cross_validate(rows, NAMES, "fold", [0.1, 50.0])).first()
    assert best["r2"] == max(got.values())


def test_determined_and_missing_features(spark, data):
    x, y, _ = data
    x = x.copy()
    x[:, 2] = 2 * x[:, 0] - x[:, 1]
    row = stacking.fit(frame(spark, x, y), NAMES, alpha=0.0).first()
    w, b = solved(x[:, [0, 1, 3]], y, 0.0)
    assert [row[f"w_{n}"] for n in "abd"] == pytest.approx(w, rel=1e-5) and row["w_c"] == 0
    gaps = frame(spark, x, y).selectExpr("if(a > 1, null, a) as a", "if(b > 0, double('NaN'), b) as b", "c", "d", "y_log", "fold")
    kept = (x[:, 0] <= 1) & (x[:, 1] <= 0)
    assert stacking.fit(gaps, NAMES).first()["n"] == kept.sum()


def test_predictions_and_no_rows(spark, data):
    x, y, _ = data
    rows = frame(spark, x, y)
    weights = stacking.fit(rows, NAMES)
    w, b = solved(x, y, 1.0)
    got = stacking.predict(rows, weights, NAMES).collect()
    assert [r["p_log"] for r in got] == pytest.approx([np.array([r[n] for n in NAMES]) @ w + b for r in got])
    none = rows.where("false")
    assert stacking.fit(none, NAMES).collect() == [] and stacking.cross_validate(none, NAMES, "fold", [1.0]).collect() == []
    assert stacking.predict(rows, stacking.fit(none, NAMES), NAMES).where("p_log is not null").count() == 0
    constant = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0, 5.0, 0)] * 3, rows.schema)
    assert stacking.fit(constant, NAMES, alpha=0.0).first()["intercept"] == 5

"""Metrics on hand-made predictions, blend search and calibration."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotcast.operators import blend as B
from slotcast.operators import evaluate as E
from slotcast.operators import quality as Q


def predictions(spark, pairs):
    rows = [(f"k{i % 3}", i % 24, float(np.log(y)), float(np.log(p))) for i, (y, p) in enumerate(pairs)]
    return spark.createDataFrame(rows, "geohash string, hour int, y_log double, p_log double")


def test_bucket_without_variance_and_with_one_row(spark):
    df = predictions(spark, [(0.01, 0.01), (0.01, 0.02), (0.05, 0.05), (0.2, 0.2), (0.2, 0.2)])
    rows = {r["bucket"]: r for r in E.bucket_metrics(df).collect()}
    assert (rows[0]["n"], rows[0]["r2"], rows[0]["acc"]) == (2, 0.0, 1.0)
    assert rows[1]["n"] == 1 and rows[1]["r2"] is None and rows[1]["mae"] is None
    assert rows[2]["n"] == 0 and rows[2]["acc"] is None
    assert rows[3]["r2"] == 1.0


def test_confusion_matrix_is_zero_filled(spark):
    df = predictions(spark, [(0.01, 0.2), (0.01, 0.01), (0.2, 0.2)])
    cells = [tuple(r)[1:] for r in E.confusion_matrix(df).orderBy("bucket").collect()]
    assert cells == [(1, 0, 0, 1), (0, 0, 0, 0), (0, 0, 0, 0), (0, 0, 0, 1)]
    assert E.macro_accuracy(E.confusion_matrix(df)).first()["macro_acc"] == pytest.approx(0.75)


def test_residuals_against_numpy(spark):
    rng = np.random.default_rng(4)
    y, p = np.exp(rng.normal(-3, 1, 200)), np.exp(rng.normal(-3, 1, 200))
    got = E.residual_stats(predictions(spark, list(zip(y, p)))).first()
    res = np.log(y) - np.log(p)
    centred = res - res.mean()
    want = {"mean": res.mean(), "median": np.median(res), "std": res.std(), "p5": np.quantile(res, 0.05),
            "p95": np.quantile(res, 0.95), "skew": (centred**3).mean() / res.std() ** 3}
    for c, x in want.items():
        assert got[c] == pytest.approx(x, rel=1e-9), c


def test_hours_are_complete_and_first_worst_wins(spark):
    df = predictions(spark, [(0.1 + 0.01 * (i // 24), 0.3) for i in range(48)])
    by_hour = E.temporal_breakdown(df)
    assert by_hour.count() == 24
    assert E.temporal_summary(by_hour).first()["worst_hour"] == 0
    assert E.temporal_breakdown(df.where("hour < 2")).where("r2 is null").count() == 22


MODELS = ["m1", "m2", "m3"]


@pytest.fixture(scope="module")
def models(spark):
    rng = np.random.default_rng(9)
    y = rng.normal(-3, 1, 400)
    m1, m2, m3 = y + rng.normal(0, 0.6, 400), y + rng.normal(0.1, 0.7, 400), rng.normal(-3, 1, 400)
    rows = [tuple(map(float, r)) for r in zip(y, m1, m2, m3)]
    return spark.createDataFrame(rows, "y_log double, m1 double, m2 double, m3 double")


def score(models, w):
    pdf = models.toPandas()
    clip = lambda x: np.clip(np.exp(x), 1e-6, 1.0)
    y, p = clip(pdf.y_log), clip(sum(wi * pdf[m] for wi, m in zip(w, MODELS)))
    return 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum() - 0.01 * sum(x * x for x in w)


def test_blend_is_best_on_the_grid_and_refines(models):
    scores = B.simplex_scores(models, MODELS, steps=10)
    assert scores.count() == 66
    best = B.best_weights(scores, MODELS).first()
    found = [best[f"w_{m}"] for m in MODELS]
    assert best["score"] == pytest.approx(score(models, found), rel=1e-9)
    for corner in np.eye(3).tolist() + [[1 / 3] * 3]:
        assert best["score"] >= score(models, corner) - (0.002 if max(corner) < 1 else 0)
    refined = B.refine_weights(models, MODELS, dict(zip(MODELS, found)), step=0.05)
    w = [refined[m] for m in MODELS]
    assert sum(w) == pytest.approx(1) and min(w) >= 0
    assert score(models, w) >= best["score"] - 1e-12


def test_starts_are_the_grid_points_no_neighbour_beats(models):
    scores = B.simplex_scores(models, MODELS, steps=10)
    grid = {tuple(round(10 * r[f"w_{m}"]) for m in MODELS): r["score"] for r in scores.collect()}

    def around(cell):
        return [tuple(c + (j == a) - (j == b) for j, c in enumerate(cell)) for a in range(3) for b in range(3) if a != b]

    tops = sorted((-s, cell) for cell, s in grid.items() if all(s >= grid.get(n, s) for n in around(cell)))[:5]
    starts = B.grid_optima(scores, MODELS, steps=10).collect()
    assert [tuple(round(10 * r[f"w_{m}"]) for m in MODELS) for r in starts] == [cell for _, cell in tops]
    assert starts[0]["score"] == max(grid.values())


def test_restarts_end_where_the_best_single_search_ends(models):
    corners = [dict(zip(MODELS, map(float, row))) for row in np.eye(3)]
    alone = [B.refine_weights(models, MODELS, c, step=0.25, min_step=0.03) for c in corners]
    together = B.refine_weights(models, MODELS, corners, step=0.25, min_step=0.03)
    assert together in alone
    reached = [score(models, [w[m] for m in MODELS]) for w in alone]
    assert score(models, [together[m] for m in MODELS]) == pytest.approx(max(reached), abs=1e-12)


def test_shift_zero_is_the_raw_prediction(models):
    df = models.selectExpr("y_log", "m1 as p_log")
    shifts = B.shift_scores(df)
    raw = E.r2_original_scale(df).first()["r2"]
    assert shifts.count() == 71
    assert shifts.where("log_shift = 0").first()["r2"] == pytest.approx(raw)
    best = B.best_shift(shifts).first()
    assert best["r2"] >= raw and best["applied_shift"] == 0


def test_reconcile_counts_both_sides(spark):
    a, b = (spark.createDataFrame([(i,) for i in ids], "Index bigint") for ids in ([1, 2, 3], [3, 4]))
    assert tuple(Q.reconcile(a, b, "Index").first()) == (2, 1, 1)


def test_check_rows_report_missing_values_as_failed(spark):
    rows = Q.check_rows(spark.sql("select cast(null as double) as val_r2, 0.5D as macro_acc"))
    assert {r["check"]: r["ok"] for r in rows.collect()} == {"val_r2": False, "macro_acc": True}


def test_a_report_reads_the_predictions_in_one_pass(spark):
    """Every part taken from the shared sums equals the same part taken from the rows."""
    rng = np.random.default_rng(8)
    y, p = np.exp(rng.normal(-3, 1, 300)), np.exp(rng.normal(-3, 1, 300))
    df = predictions(spark, list(zip(y, p))).withColumn("p_log", F.expr("if(hour = 5, null, p_log)"))
    sums = E.level_sums(df)
    same = [
        (E.bucket_metrics(df), E.bucket_metrics(df, found=sums["bucket"])),
        (E.confusion_matrix(df), E.confusion_matrix(df, found=sums["bucket"])),
        (E.temporal_breakdown(df), E.temporal_breakdown(df, found=sums["hour"])),
        (E.spatial_breakdown(df), E.spatial_breakdown(df, found=sums["key"])),
        (E.worst_entities(df), E.worst_entities(df, found=sums["key"])),
    ]
    for plain, shared in same:
        assert plain.columns == shared.columns
        a, b = (sorted(map(tuple, x.collect()), key=repr) for x in (plain, shared))
        assert len(a) == len(b) and all(u == pytest.approx(v) for x, z in zip(a, b) for u, v in zip(x, z))
    stats = {r["section"]: r for r in E.distributions(df.selectExpr("'a' as section", "y_log as v")).collect()}
    assert stats["a"]["n"] == 300 and stats["a"]["p25"] == pytest.approx(np.quantile(np.log(y), 0.25))


def test_a_report_without_predictions(spark):
    from slotcast.plans.reports import evaluation_report

    none = predictions(spark, [(0.1, 0.1)]).where("false")
    rows = {(r["section"], r["item"]): r["value"] for r in evaluation_report(none, none.select("geohash")).collect()}
    assert rows["residuals", "median"] is None and rows["val_true_dist", "p99"] is None
    assert rows["spatial", "n_keys"] == 0 and rows["cold_start", "n_keys"] == 0 and rows["confusion", "0-0"] == 0

"""Learned operators on a table in which the day before does predict the day."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from slotcast.operators import blend as B
from slotcast.operators import categories, clusters
from slotcast.operators import models as M
from slotcast.operators import quality as Q
from slotcast.plans.feature_matrix import build_features
from slotcast.plans.forecast import run_forecast
from slotcast.session import materialize, scratch_path
from slotcast.sources.tables import read_run_log
from slotcast.spec import Spec

SMALL = M.ModelParams(boosting_rounds=15, min_final_rounds=15, step=0.2, forest_trees=8, depth_a=3, depth_b=3,
                      depth_c=4, forest_depth=6, max_bins=32)


@pytest.fixture(scope="module")
def planted(observed):
    rng = random.Random(21)
    train, test = [], []
    for k in range(12):
        level = rng.uniform(0.05, 0.3)
        for s in range(0, 1440, 15):
            shape = level * (1 + 0.8 * math.sin(2 * math.pi * s / 1440))
            train.append((f"qp00{k // 10}{k % 10}", 48, s, max(shape * rng.uniform(0.9, 1.1), 1e-3)))
            now = (f"qp00{k // 10}{k % 10}", 49, s)
            train.append((*now, max(shape * rng.uniform(0.9, 1.1), 1e-3))) if s < 720 else test.append((*now, None))
    test_df = observed(test, value=False, temperature=[20.0] * len(test))
    test_df = test_df.selectExpr("Index + 100000 as Index", *[c for c in test_df.columns if c != "Index"])
    train_df = observed(train, temperature=[None if i % 7 == 0 else float(i % 30) for i in range(len(train))])
    return train_df, test_df


@pytest.fixture(scope="module")
def built(planted):
    train_df, test_df = planted
    zones = clusters.spatial_clusters(train_df, test_df, k=3, restarts=2)
    return materialize(build_features(train_df, test_df, clusters=zones))


@pytest.fixture(scope="module")
def trained(built):
    return M.train_ensemble(built, SMALL)


def test_zones_cover_every_key(built):
    zones = built.select("geohash", "geohash_cluster").distinct().collect()
    assert len(zones) == 12 and len({z["geohash_cluster"] for z in zones}) == 3


def test_predictions_only_where_they_belong(trained):
    counts = trained.oof.selectExpr("fold", *[f"{m} is null as {m}" for m in M.MODELS]).distinct().collect()
    assert {(r["fold"], r[m]) for r in counts for m in M.MODELS} == {(-1, True), (0, False)}
    assert trained.test.count() == 12 * 48


def test_models_find_the_planted_signal(trained):
    scores = {r["model"]: r["r2"] for r in M.ensemble_r2(trained).collect()}
    assert set(scores) == set(M.MODELS) and max(scores.values()) > 0.5
    fold = M.fold_metrics(trained).first()
    assert fold["n_train"] == 12 * 96 and fold["n_val"] == 12 * 48 and fold["rounds_a"] >= 1


def test_importance_and_blend(spark, trained):
    fold = trained.fold_models
    top = M.top_features(M.feature_importance(fold.models["oof_a"], fold.inputs["oof_a"], spark), 5).collect()
    assert len(top) == 5 and top[0]["score"] >= top[-1]["score"]
    rows = materialize(trained.oof.where("fold = 0"))
    best = B.best_weights(B.simplex_scores(rows, M.MODELS, steps=5), M.MODELS)
    final = B.apply_weights(trained.test, M.MODELS, best)
    assert final.where("blend <= 0 or blend > 1 or blend is null").count() == 0


def test_feature_checks_hold_here(built):
    rows = {r["check"]: r["ok"] for r in Q.feature_checks(built).collect()}
    assert all(rows.values()), rows


def test_codes_are_shared_and_unseen_gets_its_own(spark):
    train = spark.createDataFrame([("b",), ("a",), ("b",)], "c string")
    rows = spark.createDataFrame([("a",), ("b",), ("zz",)], "c string")
    coded = categories.ordinal_encode(train, rows, ["c"]).collect()
    assert [r["c_code"] for r in coded] == [0.0, 1.0, 2.0]


def test_nearest_centroid_takes_the_smaller_on_ties(spark):
    points = spark.createDataFrame([("a", 0.0, 0.0), ("b", 5.0, 5.0)], "geohash string, lat double, lon double")
    got = clusters.assign_centroid(points, [(1.0, 0.0), (-1.0, 0.0), (5.0, 4.0)]).collect()
    assert [r["cluster"] for r in got] == [0, 2]


def test_whole_run_from_files(spark, planted):
    raw = ["Index", "geohash", "day", "timestamp", "RoadType", "NumberofLanes", "LargeVehicles", "Landmarks",
           "Temperature", "Weather"]
    base = scratch_path(spark, "run")
    planted[0].select(*raw, "demand").write.csv(f"{base}/train", header=True)
    planted[1].select(*raw).write.csv(f"{base}/test", header=True)
    tiny = M.ModelParams(boosting_rounds=3, min_final_rounds=3, step=0.3, forest_trees=4, depth_a=3, depth_b=3,
                         depth_c=3, forest_depth=5, max_bins=32)
    done = run_forecast(spark, f"{base}/train", f"{base}/test", f"{base}/out", tiny, Spec(n_clusters=3),
                        simplex_steps=4, shrink=0.5, restarts=1)
    stored = spark.read.csv(f"{base}/out/predictions", header=True, inferSchema=True)
    assert stored.columns == ["Index", "demand"] and stored.count() == 12 * 48
    assert tuple(Q.reconcile(planted[1], stored, "Index").first())[:2] == (0, 0)
    assert stored.where("demand <= 0 or demand > 1 or demand is null").count() == 0
    run = read_run_log(spark, f"{base}/out/runs").first()
    assert run["n_feat"] == 50 and run["n_val"] == 12 * 48 and run["eval"]["cold_start"] == 0
    assert abs(sum(run["w"]) - 1) < 1e-9 and run["blend_raw"] >= max(run["lgbm"], run["cat"], run["et"]) - 0.02
    assert run["eval"]["worst_geo_mae"] >= run["eval"]["spatial_mae_mean"] and any(v is not None for v in run["eval"]["bucket_r2"])
    sections = {r["section"] for r in done.report.select("section").distinct().collect()}
    assert {"residuals", "bucket_metrics", "confusion", "spatial", "temporal", "test_pred_dist", "worst", "feature_importance"} <= sections
    assert spark.read.json(f"{base}/out/feature_stats").where("n_null > 0").count() == 0


@pytest.mark.parametrize("losses,patience,kept", [([5, 4, 3, 3.5, 3.6, 1], 2, 3), ([5, 4, 3, 3.5, 3.6, 1], 9, 6), ([1.0], 5, 1), ([2, 2, 2], 1, 1)])
def test_best_round(losses, patience, kept):
    assert M.best_round(losses, patience) == kept


def test_the_kept_round_is_the_best_one(built):
    from pyspark.ml.regression import GBTRegressor

    inputs = M.model_inputs(built.limit(1))["oof_a"]
    columns = [c for c in inputs if not c.endswith("_code")]
    rows = M._assemble(built.where("not is_test").fillna(0.0, columns), columns).select("fold", "features", "y_log")
    model = GBTRegressor(featuresCol="features", labelCol="y_log", maxIter=12, stepSize=0.9, maxDepth=4, seed=1).fit(rows.where("fold = -1"))
    losses = model.evaluateEachIteration(rows.where("fold = 0"), "squared")
    kept = M.best_round(losses, 150)
    cut = M.first_rounds(model, kept)
    assert losses[kept - 1] == min(losses) and cut.getNumTrees == kept
    assert cut.evaluateEachIteration(rows.where("fold = 0"), "squared") == pytest.approx(losses[:kept])
    loss = cut.transform(rows.where("fold = 0")).selectExpr("avg((y_log - prediction) * (y_log - prediction)) as l").first()["l"]
    assert loss == pytest.approx(min(losses)) and len(cut.featureImportances) == len(columns)


def test_key_code_does_not_see_its_own_row(spark):
    from slotcast.operators.encoding import inner_fold_te

    def codes(change=None):
        data = [(i, f"k{i % 3}", -1 if i < 30 else 0, float(i % 7) + (100.0 if i == change else 0.0)) for i in range(40)]
        rows = spark.createDataFrame(data, "Index bigint, geohash string, fold int, y double")
        rows = rows.unionByName(spark.createDataFrame([(99, "k0", None, None), (98, "new", None, None)], rows.schema))
        coded = inner_fold_te(rows.where("y is not null"), rows, "geohash", "Index", "y", 5, 1.0, "code")
        return {r["Index"]: r["code"] for r in coded.collect()}

    before = codes()
    for i in (0, 17, 29):
        after = codes(i)
        assert after[i] == before[i] and after[99 if i % 3 == 0 else 31] is not None
    for i in (30, 39):
        assert codes(i) == before
    fit = [(i, float(i % 7)) for i in range(30) if i % 3 == 0]
    prior = sum(float(i % 7) for i in range(30)) / 30
    assert before[99] == pytest.approx((sum(v for _, v in fit) + prior) / (len(fit) + 1)) and before[98] == pytest.approx(prior)


def test_many_categories_do_not_stop_the_learners(built):
    wide = built.withColumn("Weather", F.expr("concat('w', Index % 70)"))
    quick = M.ModelParams(boosting_rounds=2, min_final_rounds=2, step=0.2, forest_trees=2, depth_a=2, depth_b=2, depth_c=2,
                          forest_depth=2, max_bins=32)
    assert M.train_ensemble(materialize(wide), quick, refit=False).oof.where("fold = 0 and oof_a is null").count() == 0


def test_an_absent_model_drops_out(spark):
    rows = spark.createDataFrame([(math.log(v), math.log(v * 1.1), math.log(v * 0.7)) for v in (0.1, 0.2, 0.4, 0.3)], "y_log double, a double, b double")
    rows = materialize(rows.selectExpr("*", "cast(null as double) as c"))
    best = B.best_weights(B.simplex_scores(rows, ["a", "b", "c"], steps=5), ["a", "b", "c"]).first()
    two = B.best_weights(B.simplex_scores(rows, ["a", "b"], steps=5), ["a", "b"]).first()
    assert (best["w_a"], best["w_b"], best["w_c"], best["score"]) == (two["w_a"], two["w_b"], 0.0, pytest.approx(two["score"]))
    fine = B.refine_weights(rows, ["a", "b", "c"], {m: best[f"w_{m}"] for m in "abc"}, 0.2)
    assert fine["c"] == 0 and sum(fine.values()) == pytest.approx(1)
    table = spark.createDataFrame([tuple(fine[m] for m in "abc")], "w_a double, w_b double, w_c double")
    assert table.count() == 1
    mixed = B.reblend(rows, {"a": 0.5, "b": 0.2, "c": 0.3}, ("a", "b", 0.25), required=("c",)).selectExpr("p_log", "0.25D * a + 0.75D * b as w").collect()
    dropped = B.reblend(rows, {"a": 0.5, "b": 0.2, "c": 0.3}, ("a", "b", 0.25)).selectExpr("p_log", "0.5D * a + 0.2D * b as w").collect()
    assert all(r["p_log"] == pytest.approx(r["w"]) for r in [*mixed, *dropped])


def test_inputs_are_assembled_once_for_all_learners_and_fits(built, monkeypatch):
    calls = []
    monkeypatch.setattr(M, "_assemble", lambda df, columns, assemble=M._assemble: calls.append(len(columns)) or assemble(df, columns))
    quick = M.ModelParams(boosting_rounds=1, min_final_rounds=1, forest_trees=1, depth_a=1, depth_b=1, depth_c=1, forest_depth=1)
    done = M.train_ensemble(built, quick)
    predicting = 2 * len(M.MODELS)  # labelled and unlabelled rows
    assert len(calls) == len({tuple(c) for c in done.fold_models.inputs.values()}) + predicting
    assert set(done.final_models.models) == set(M.MODELS)

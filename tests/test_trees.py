"""Learner sizes of the registered queries, and trees grown within one task."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from slotcast import queries as Qs
from slotcast.operators import models as M
from slotcast.operators import trees as T
from slotcast.operators.boosting import TreeParams
from slotcast.session import materialize


@pytest.mark.parametrize("refit", [False, True])
def test_registered_queries_fit_learners_of_full_size(monkeypatch, refit):
    class Seen(Exception):
        pass

    def seen(built, p=M.ModelParams(), sp=None, refit=True):
        raise Seen(p, refit)

    monkeypatch.setattr(Qs, "stored", lambda spark, d: (None, None))
    monkeypatch.setattr(Qs.clusters, "spatial_clusters", lambda *a: None)
    monkeypatch.setattr(Qs.FM, "build_features", lambda *a, **k: None)
    monkeypatch.setattr(Qs.M, "train_ensemble", seen)
    with pytest.raises(Seen) as got:
        Qs.trained(None, "", refit)
    p, again = got.value.args
    assert again is refit and (p.rounds_a, p.rounds_b, p.rounds_c, p.boosting_rounds) == (3000, 4000, 2000, None)
    assert (p.patience, p.min_final_rounds, p.step, p.forest_trees) == (150, 500, 0.03, 600)
    assert (p.depth_a, p.depth_b, p.depth_c, p.forest_depth, p.max_bins) == (6, 6, 7, 12, 64)


@pytest.fixture(scope="module")
def rows(spark):
    """Vectors of two numbers, a nominal input and a constant."""
    rng = random.Random(8)
    data = []
    for i in range(500):
        a, b, c = rng.randrange(12) / 4, rng.uniform(0, 9), rng.choice("uvwxyz")
        data.append((i, -1 if i % 5 else 0, a, float(int(b)), c, 1.0,
                     math.sin(a) + (2 if c in "vy" else 0) + b / 9 + rng.gauss(0, 0.2)))
    df = spark.createDataFrame(data, "Index bigint, fold int, a double, b double, c string, k double, y_log double")
    df = StringIndexer(inputCol="c", outputCol="code", handleInvalid="keep").fit(df).transform(df)
    vectors = VectorAssembler(inputCols=["a", "b", "code", "k"], outputCol="features", handleInvalid="keep").transform(df)
    return materialize(vectors.select("Index", "fold", "features", "y_log"))


def predictions(model, rows):
    return {r["Index"]: r["prediction"] for r in model.transform(rows).collect()}


def test_the_first_tree_is_the_one_of_mllib(rows):
    blocks = T.binned_blocks(rows, "Index", 16)
    for depth, leaf in ((1, 1), (3, 1), (5, 9)):
        tree = DecisionTreeRegressor(featuresCol="features", labelCol="y_log", maxDepth=depth, maxBins=16, minInstancesPerNode=leaf).fit(rows.where("fold = -1"))
        got, _ = T.fit_boosted(blocks, TreeParams(depth=depth, min_leaf=leaf, max_bins=16), 1, None)
        assert got.getNumTrees == 1 and got.totalNumNodes == tree.numNodes and predictions(got, rows) == pytest.approx(predictions(tree, rows))
        assert got.featureImportances.toArray() == pytest.approx(tree.featureImportances.toArray())


def test_a_forest_has_all_its_trees_on_all_fit_rows(rows):
    learner = RandomForestRegressor(
        featuresCol="features", labelCol="y_log", numTrees=13, maxDepth=4, maxBins=16, bootstrap=False, featureSubsetStrategy="all", seed=3)
    blocks = T.binned_blocks(rows, "Index", 16)
    got, same = T.fit_forest(blocks, learner), learner.fit(rows.where("fold = -1"))
    assert got.getNumTrees == 13 and len(set(got.trees)) == 1 and predictions(got, rows) == pytest.approx(predictions(same, rows))
    assert got.featureImportances.toArray() == pytest.approx(same.featureImportances.toArray())
    some = T.fit_forest(blocks, learner.copy({learner.featureSubsetStrategy: "0.5"}))
    assert len(set(some.trees)) > 6


def test_losses_are_those_of_the_model_and_patience_ends_the_fit(rows):
    eager = TreeParams(depth=6, step=1.0, min_leaf=1, max_bins=16)  # learns the noise, so its loss soon rises
    blocks = T.binned_blocks(rows, "Index", 16)
    model, losses = T.fit_boosted(blocks, eager, 60, 4)
    kept = model.getNumTrees
    assert len(losses) == kept + 4 < 60 and losses[kept - 1] == min(losses)
    error = model.transform(rows.where("fold = 0")).selectExpr("avg((y_log - prediction) * (y_log - prediction)) as e").first()["e"]
    assert error == pytest.approx(losses[kept - 1])
    assert T.fit_boosted(blocks, eager, 9, None)[0].getNumTrees == 9
    alone, none = T.fit_boosted(T.binned_blocks(rows.where("fold = -1"), "Index", 16), eager, 3, 1)
    assert alone.getNumTrees == 3 and none == []


def test_a_fit_does_not_depend_on_how_rows_are_dealt(rows):
    p = TreeParams(depth=3, step=0.3, row_share=0.7, feature_share=0.7, min_leaf=5, max_bins=16)
    one, other = (T.fit_boosted(T.binned_blocks(df, "Index", 16), p, 6, None)[0] for df in (rows, rows.repartition(7, F.expr("hash(Index)"))))
    assert predictions(one, rows) == predictions(other, rows)
    shares = [T._chosen(T.np.arange(20_000), 42, k, 0.8).mean() for k in range(3)]
    assert shares == pytest.approx([0.8] * 3, abs=0.02)


def test_cuts_of_many_values_are_at_even_ranks(spark):
    values = list(range(40_000))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(i, -1, float(v) ** 2, 0.0) for i, v in enumerate(values)], "Index bigint, fold int, v double, y_log double")
    blocks = T.binned_blocks(VectorAssembler(inputCols=["v"], outputCol="features").transform(df.repartition(3)), "Index", 64)
    assert len(blocks.cuts[0]) == 63
    assert [math.sqrt(c) for c in blocks.cuts[0]] == pytest.approx([40_000 * (i + 1) / 64 for i in range(63)], abs=200)


def test_rows_beyond_one_task_go_to_the_shared_fit(rows, monkeypatch):
    monkeypatch.setattr(T, "LARGEST", 499 * 4)
    assert T.binned_blocks(rows, "Index", 16) is None
    monkeypatch.setattr(T, "LARGEST", 500 * 4)
    assert T.binned_blocks(rows, "Index", 16) is not None
    assert T.binned_blocks(rows, "Index", 300) is None  # two bytes each
    assert T.binned_blocks(rows.where("fold = 0"), "Index", 16) is None


def test_missing_targets_and_values_are_an_error(rows):
    with pytest.raises(Exception, match="labels must not be null"):
        T.binned_blocks(rows.withColumn("y_log", F.expr("if(Index = 7, null, y_log)")), "Index", 16)
    holes = rows.select("Index", "fold", "y_log", F.expr("if(Index = 10, double('NaN'), 1D)").alias("v"))
    with pytest.raises(Exception, match="vector values must be finite"):
        T.binned_blocks(VectorAssembler(inputCols=["v"], outputCol="features", handleInvalid="keep").transform(holes), "Index", 16)


def test_full_rounds_and_trees_reach_the_models(rows, monkeypatch):
    monkeypatch.setattr(M, "model_inputs", lambda df: {m: ["a", "b", "code", "k"] for m in M.MODELS})
    monkeypatch.setattr(M, "_widest", lambda codes: 7)
    monkeypatch.setattr(M, "Boosting", None)  # nothing goes to fits of many jobs
    p, vectors = M.ModelParams(min_final_rounds=40, forest_trees=30), {m: rows for m in M.MODELS}
    fold = M.fit_fold(rows, None, p, vectors=vectors)
    assert all(1 <= n for n in fold.rounds.values()) and fold.models["oof_forest"].getNumTrees == 30
    final = M.fit_final(rows, None, {m: 0 for m in fold.rounds} | {"oof_a": 55}, p, vectors=vectors)
    assert final.rounds == {"oof_a": 55, "oof_b": 40, "oof_c": 40} and list(final.models) == M.MODELS

"""Boosted trees that can stop and go on: one tree per round on stored residuals.

A fit is a chain of chunks. Within a chunk every round fits one tree to what the trees before
it leave over; at the end of a chunk the losses of its rounds on the validation rows are
computed in one job, and the caller decides whether to go on. If so, the predictions so far
are stored first. So rounds that patience would throw away are never fitted, several fits can take turns,
and a lost executor costs a chunk at most. Which rows a round samples depends on their ids,
not on how they are stored, so a fit is the same in chunks of any size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import SparkContext
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.session import materialize, replaced


@dataclass(frozen=True)
class TreeParams:
    """One learner: the step that scales every tree after the first, and how trees grow."""

    depth: int = 6
    step: float = 0.03
    row_share: float = 1.0
    feature_share: float = 1.0
    min_leaf: int = 1
    max_bins: int = 64
    seed: int = 42


@dataclass
class Boosting:
    """A fit in progress. ``rows`` has a row id, ``fold`` (-1 fit, 0 validation), ``features`` and the target.

    With ``keep_predictions`` the rows are stored anew with their predictions before every
    further chunk; without, they are predicted anew from the trees so far, and ``rows`` can be one
    table that many fits share.
    """

    rows: DataFrame
    params: TreeParams
    row_id: str = "Index"
    target: str = "y_log"
    keep_predictions: bool = True
    trees: list[object] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    def __post_init__(self) -> None:
        self._now = self.rows.selectExpr(f"{self.row_id} as _id", "fold", "features", f"{self.target} as _y", "0D as _f")
        self._after = self._now

    def advance(self, rounds: int) -> None:
        """Fits ``rounds`` more trees and appends their mean squared errors on fold 0 (none without such rows)."""
        if self.trees and self.keep_predictions:
            with replaced(self._now):
                self._now = materialize(self._after)
        now = self._now
        if self.trees and not self.keep_predictions:
            now = self.model().setPredictionCol("_p").transform(now).withColumn("_f", F.col("_p")).drop("_p")
        seen = []
        for _ in range(rounds):
            tree = self._fit_one(now)
            weight = self._weight(len(self.trees))
            self.trees.append(tree._java_obj.trees()[0])
            now = tree.transform(now).withColumn("_f", F.col("_f") + F.lit(weight) * F.col("_p")).drop("_p")
            seen.append(f"_f{len(seen)}")
            now = now.withColumn(seen[-1], F.col("_f"))
        errors = now.where("fold = 0").agg(F.count("*").alias("n"), *[F.avg((F.col("_y") - F.col(c)) ** 2).alias(c) for c in seen]).first()
        if errors["n"]:
            self.losses += [errors[c] for c in seen]
        self._after = now.drop(*seen)

    def _weight(self, i: int) -> float:
        return self.params.step if i else 1.0

    def _fit_one(self, now: DataFrame):
        p, k = self.params, len(self.trees)
        rows = now.where("fold = -1")
        if p.row_share < 1:
            rows = rows.where(f"pmod(xxhash64(_id, {p.seed}, {k}), 10000) < {round(p.row_share * 10_000)}")
        return RandomForestRegressor(
            featuresCol="features", labelCol="_r", predictionCol="_p", numTrees=1, bootstrap=False, maxDepth=p.depth, seed=p.seed + k,
            featureSubsetStrategy="all" if p.feature_share >= 1 else str(p.feature_share), minInstancesPerNode=p.min_leaf,
            maxBins=p.max_bins, maxMemoryInMB=512, cacheNodeIds=True,
        ).fit(rows.selectExpr("features", "_y - _f as _r"))

    def model(self, rounds: int | None = None) -> GBTRegressionModel:
        """The first ``rounds`` trees (all by default) as one Spark model."""
        kept = self.trees[:rounds]
        shape = GBTRegressor(featuresCol="features", maxDepth=self.params.depth, stepSize=self.params.step)
        return _assembled(kept, [self._weight(i) for i in range(len(kept))], shape, shape.uid)


def _assembled(trees: list[object], weights: list[float], shape: GBTRegressor | GBTRegressionModel, uid: str) -> GBTRegressionModel:
    """A model of the given JVM trees with the parameters of ``shape``."""
    sc = SparkContext._active_spark_context
    trees_ = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    weights_ = sc._gateway.new_array(sc._jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        trees_[i], weights_[i] = tree, weight
    java = sc._jvm.org.apache.spark.ml.regression.GBTRegressionModel(uid, trees_, weights_, trees[0].numFeatures())
    model = GBTRegressionModel(java)
    shape._copyValues(model)
    model._transfer_params_to_java()
    return model


def first_rounds(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The boosted model with its first trees only."""
    java = model._java_obj
    return _assembled(list(java.trees())[:rounds], list(java.treeWeights())[:rounds], model, java.uid())


def best_round(losses: Sequence[float], patience: int) -> int:
    """Number of rounds up to the smallest loss, seen by one who stops after ``patience`` rounds without a better one."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def boost(fit: Boosting, rounds: int, patience: int | None = None, chunk: int = 25) -> int:
    """Up to ``rounds`` trees, fewer once ``patience`` rounds brought no smaller loss; returns how many to keep."""
    while len(fit.trees) < rounds:
        fit.advance(min(chunk, rounds - len(fit.trees)))
        if patience is not None and len(fit.losses) - best_round(fit.losses, patience) >= patience:
            break
    return best_round(fit.losses, patience) if patience is not None and fit.losses else len(fit.trees)

"""Four regressors, their out-of-fold predictions and the refit for the unlabelled rows.

Learner A sees the smoothed encodings and no raw key. Learner B adds an encoding of the key
with little smoothing in place of the raw category, whose cardinality grows with the data.
The forest and learner C see the ordinal view.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast import spec as S
from slotcast.functions.scalar import to_number
from slotcast.operators.boosting import Boosting, TreeParams, best_round, boost, first_rounds  # noqa: F401
from slotcast.operators.categories import fit_codes
from slotcast.operators.encoding import inner_fold_te
from slotcast.operators.evaluate import model_r2, on_value_scale, r2
from slotcast.operators.profile import grouped
from slotcast.operators.trees import binned_blocks, fit_boosted, fit_forest
from slotcast.session import materialize
from slotcast.spec import DEFAULT, Spec

MODELS = ["oof_a", "oof_b", "oof_forest", "oof_c"]
CATEGORIES = ["RoadType", "Weather", "geohash_cluster"]


@dataclass(frozen=True)
class ModelParams:
    """Sizes of the learners; the defaults are meant for a cluster.

    Fixed values: the rounds, step, depths and trees here, and the shares and leaf sizes in
    ``_learners``, are those of the forecast that is to be matched. ``boosting_rounds`` bounds the
    rounds of all boosted learners alike. ``pool`` learners are fitted at a time; where they do not
    fit into tasks, ``chunk`` rounds of a boosted one are fitted between two looks at its losses.
    """

    rounds_a: int = 3000
    rounds_b: int = 4000
    rounds_c: int = 2000
    boosting_rounds: int | None = None
    patience: int = 150
    min_final_rounds: int = 500
    step: float = 0.03
    forest_trees: int = 600
    depth_a: int = 6
    depth_b: int = 6
    depth_c: int = 7
    forest_depth: int = 12
    max_bins: int = 64
    chunk: int = 25
    pool: int = 4
    key_smoothing: float = 1.0
    key_folds: int = 5
    seed: int = 42


@dataclass
class Ensemble:
    """Fitted models by name, the category codes and the columns each model reads."""

    models: dict[str, object]
    inputs: dict[str, list[str]]
    codes: StringIndexerModel
    rounds: dict[str, int] = field(default_factory=dict)


def _categories(df: DataFrame) -> list[str]:
    return [c for c in CATEGORIES if c in df.columns]


def model_inputs(df: DataFrame) -> dict[str, list[str]]:
    view = [*S.NUMERIC_FEATURES, *[f"{c}_code" for c in _categories(df)]]
    return {"oof_a": view, "oof_b": [*view, "key_code"], "oof_forest": view, "oof_c": view}


def _learners(p: ModelParams, max_bins: int) -> dict[str, TreeParams | RandomForestRegressor]:
    bins = max(p.max_bins, max_bins)
    common = {"step": p.step, "max_bins": bins, "seed": p.seed}
    return {
        "oof_a": TreeParams(depth=p.depth_a, row_share=0.8, feature_share=0.7, min_leaf=100, **common),
        "oof_b": TreeParams(depth=p.depth_b, min_leaf=20, **common),
        "oof_forest": RandomForestRegressor(
            featuresCol="features", labelCol="y_log", maxBins=bins, seed=p.seed, maxMemoryInMB=512, cacheNodeIds=True,
            numTrees=p.forest_trees, maxDepth=p.forest_depth, bootstrap=False, featureSubsetStrategy="0.6", minInstancesPerNode=20),
        "oof_c": TreeParams(depth=p.depth_c, row_share=0.8, feature_share=0.8, **common),
    }


def _widest(codes: StringIndexerModel) -> int:
    """Bins that tell all categories of every coded column apart, with one for unseen ones."""
    return max([len(labels) + 1 for labels in codes.labelsArray], default=0)


def _prepare(rows: DataFrame, labelled: DataFrame, codes: StringIndexerModel, p: ModelParams, sp: Spec) -> DataFrame:
    with_key = inner_fold_te(labelled, rows, sp.key, sp.row_id, "y_log", p.key_folds, p.key_smoothing, "key_code")
    numeric = with_key.selectExpr(*[
        f"{to_number(c)} as {c}" if c in S.NUMERIC_FEATURES and c != sp.hour else c for c in with_key.columns])
    return codes.transform(numeric)


def _assemble(df: DataFrame, columns: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=out, handleInvalid="keep").transform(df)


def _predict(df: DataFrame, ensemble: Ensemble, sp: Spec) -> DataFrame:
    out = df
    for name, model in ensemble.models.items():
        out = model.transform(_assemble(out, ensemble.inputs[name])).withColumnRenamed("prediction", name)
        out = out.drop("features")
    return out


def assembled(train: DataFrame, sp: Spec = DEFAULT) -> dict[str, DataFrame]:
    """Per learner its rows with their inputs as one vector.

    A tree reads its rows several times, so every set of inputs is assembled and stored once,
    however many learners, rounds and fits read it.
    """
    inputs, stored = model_inputs(train), {}
    for columns in inputs.values():
        if tuple(columns) not in stored:
            stored[tuple(columns)] = materialize(_assemble(train, columns).select(sp.row_id, "fold", "features", "y_log"))
    return {name: stored[tuple(columns)] for name, columns in inputs.items()}


def _fit_all(
    inputs: dict[str, list[str]], vectors: dict[str, DataFrame], codes: StringIndexerModel, p: ModelParams, sp: Spec,
    rounds: dict[str, int], patience: int | None,
) -> Ensemble:
    """All learners on the rows of fold -1, ``pool`` of them at a time; within tasks if a task holds the binned rows."""
    learners = _learners(p, _widest(codes))
    learners["oof_forest"] = learners.pop("oof_forest")  # many tasks: those of one task each go first
    blocks = {}
    for name, columns in inputs.items():
        if tuple(columns) not in blocks:
            blocks[tuple(columns)] = binned_blocks(vectors[name], sp.row_id, learners["oof_forest"].getMaxBins())

    def fit(item: tuple[str, object]) -> tuple[object, int]:
        name, learner = item
        rows, binned = vectors[name], blocks[tuple(inputs[name])]
        if not isinstance(learner, TreeParams):
            return fit_forest(binned, learner) if binned else learner.fit(rows.where("fold = -1")), p.forest_trees
        if binned:
            model, _ = fit_boosted(binned, learner, rounds[name], patience)
            return model, model.getNumTrees
        boosting = Boosting(rows, learner, sp.row_id)
        kept = boost(boosting, rounds[name], patience, p.chunk)
        return boosting.model(kept), kept

    with ThreadPoolExecutor(p.pool) as workers:
        fitted = dict(zip(learners, workers.map(fit, learners.items())))
    for binned in blocks.values():
        if binned:
            binned.drop()
    used = {name: kept for name, (_, kept) in fitted.items() if name != "oof_forest"}
    return Ensemble({name: fitted[name][0] for name in MODELS}, inputs, codes, used)


def fit_fold(
    train: DataFrame, codes: StringIndexerModel, p: ModelParams, sp: Spec = DEFAULT, vectors: dict[str, DataFrame] | None = None
) -> Ensemble:
    """Fits on fold -1; the boosted learners keep the rounds up to the best one on fold 0.

    They stop once ``patience`` rounds brought no smaller loss. ``vectors`` are the rows of
    ``train`` as ``assembled`` returns them.
    """
    rounds = {m: n if p.boosting_rounds is None else p.boosting_rounds
              for m, n in (("oof_a", p.rounds_a), ("oof_b", p.rounds_b), ("oof_c", p.rounds_c))}
    return _fit_all(model_inputs(train), vectors or assembled(train, sp), codes, p, sp, rounds, p.patience)


def fit_final(
    train: DataFrame, codes: StringIndexerModel, rounds: dict[str, int], p: ModelParams, sp: Spec = DEFAULT,
    vectors: dict[str, DataFrame] | None = None,
) -> Ensemble:
    """Refit on all labelled rows with at least ``min_final_rounds`` boosting rounds."""
    wanted = {m: max(rounds.get(m, 0), p.min_final_rounds) for m in MODELS}
    every = {name: rows.withColumn("fold", F.lit(-1)) for name, rows in (vectors or assembled(train, sp)).items()}
    return _fit_all(model_inputs(train), every, codes, p, sp, wanted, None)


@dataclass
class Trained:
    """What training leaves behind: predictions by row id, both ensembles and the prepared rows."""

    oof: DataFrame
    test: DataFrame
    fold_models: Ensemble
    final_models: Ensemble | None
    prepared: DataFrame


def train_ensemble(
    built: DataFrame, p: ModelParams = ModelParams(), sp: Spec = DEFAULT, refit: bool = True
) -> Trained:
    """Fold fit, out-of-fold predictions, refit and predictions for the unlabelled rows."""
    labelled = built.where("not is_test")
    codes = fit_codes(labelled, _categories(built))
    prepared = materialize(_prepare(built, labelled, codes, p, sp))
    train = prepared.where("not is_test")
    vectors = assembled(train, sp)
    fold = fit_fold(train, codes, p, sp, vectors)
    predicted = _predict(train, fold, sp)
    keep = [sp.row_id, sp.key, sp.hour, "fold", "y_log"]
    oof = predicted.selectExpr(*keep, *[f"case when fold = 0 then {m} end as {m}" for m in MODELS])
    final = fit_final(train, codes, fold.rounds, p, sp, vectors) if refit else None
    test = _predict(prepared.where("is_test"), final or fold, sp).select(sp.row_id, sp.key, sp.hour, *MODELS)
    return Trained(oof, test, fold, final, prepared)


def fold_metrics(trained: Trained, sp: Spec = DEFAULT) -> DataFrame:
    """Train R2 of learner A, validation R2 of the mean of A and B, sizes and rounds."""
    predicted = _predict(trained.prepared.where("not is_test"), trained.fold_models, sp)
    scored = on_value_scale(predicted.selectExpr(
        "fold", "y_log", "case when fold = -1 then oof_a else 0.5D * oof_a + 0.5D * oof_b end as p_log"), sp)
    by_fold = grouped(scored, ["fold"], n="count(*)", r2=r2("y", "p"))
    rounds = trained.fold_models.rounds
    return grouped(
        by_fold, [], train_r2="max(case when fold = -1 then r2 end)", val_r2="max(case when fold = 0 then r2 end)",
        n_train="max(case when fold = -1 then n end)", n_val="max(case when fold = 0 then n end)",
    ).selectExpr("*", *[f"{rounds[m]} as rounds_{m[4:]}" for m in sorted(rounds)])


def feature_importance(model: object, columns: list[str], spark) -> DataFrame:  # noqa: ANN001
    """(name, score) rows, one per model input: model metadata, not data."""
    scores = model.featureImportances.toArray()
    return spark.createDataFrame([(c, float(s)) for c, s in zip(columns, scores)], "name string, score double")


def top_features(importance: DataFrame, n: int = 10) -> DataFrame:
    return importance.orderBy(["score", "name"], ascending=[False, True]).limit(n)


def ensemble_r2(trained: Trained, sp: Spec = DEFAULT) -> DataFrame:
    return model_r2(trained.oof.where("fold = 0"), MODELS, sp)

"""From the two observation files to delivered predictions, metrics and a run record."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast.operators import blend as B
from slotcast.operators import evaluate as E
from slotcast.operators import models as M
from slotcast.operators.clusters import spatial_clusters
from slotcast.operators.profile import grouped
from slotcast.plans.feature_matrix import build_features, feature_matrix
from slotcast.plans.history import cold_keys
from slotcast.plans.reports import evaluation_document, evaluation_report
from slotcast.session import materialize, stored_tables_dropped
from slotcast.sources import sinks
from slotcast.sources.tables import read_observations, read_run_log, with_time
from slotcast import spec as S
from slotcast.spec import DEFAULT, Spec


@dataclass
class Outcome:
    """Frames of a finished run; all of them are stored below the output folder as well."""

    predictions: DataFrame
    oof: DataFrame
    report: DataFrame
    record: DataFrame


def run_forecast(
    spark: SparkSession, train_path: str, test_path: str, out_dir: str, params: M.ModelParams = M.ModelParams(),
    sp: Spec = DEFAULT, fmt: str = "csv", simplex_steps: int = B.SIMPLEX_STEPS, shrink: float = B.CALIBRATION_SHRINK,
    leaderboard: float | None = None, restarts: int = 10,
) -> Outcome:
    """Reads, builds features, trains, blends, evaluates and writes.

    Below ``out_dir``: predictions (CSV), oof (parquet), metrics, feature_stats, eval, importances
    (JSON) and runs, to which every call appends one line. What the run stored elsewhere is
    deleted at its end; the frames returned read the output folder.
    """
    with stored_tables_dropped(spark):
        _run(spark, train_path, test_path, out_dir, params, sp, fmt, simplex_steps, shrink, leaderboard, restarts)
    return Outcome(
        spark.read.schema(f"{sp.row_id} bigint, demand double").csv(f"{out_dir}/predictions", header=True),
        spark.read.parquet(f"{out_dir}/oof"), spark.read.parquet(f"{out_dir}/report"), read_run_log(spark, f"{out_dir}/runs"))


def _run(
    spark: SparkSession, train_path: str, test_path: str, out_dir: str, params: M.ModelParams, sp: Spec, fmt: str,
    simplex_steps: int, shrink: float, leaderboard: float | None, restarts: int,
) -> None:
    train = with_time(read_observations(spark, train_path, fmt=fmt), sp)
    test = with_time(read_observations(spark, test_path, labelled=False, fmt=fmt), sp)
    zones = materialize(spatial_clusters(train, test, sp, restarts=restarts))
    built = materialize(build_features(train, test, sp, clusters=zones))
    trained = M.train_ensemble(built, params, sp)
    oof = materialize(trained.oof)
    validation = oof.where("fold = 0")

    starts = B.grid_optima(B.simplex_scores(validation, M.MODELS, simplex_steps, sp=sp), M.MODELS, simplex_steps).collect()
    fine = B.refine_weights(validation, M.MODELS, [{m: r[f"w_{m}"] for m in M.MODELS} for r in starts], 1 / simplex_steps, sp=sp)
    best = spark.createDataFrame([tuple(fine[m] for m in M.MODELS)], ", ".join(f"w_{m} double" for m in M.MODELS))
    blended = materialize(B.apply_weights(validation, M.MODELS, best, sp).withColumnRenamed("blend_log", "p_log"))
    shift = materialize(B.best_shift(B.shift_scores(blended, sp=sp), shrink))
    applied = shift.first()["applied_shift"]
    calibrated = blended.withColumn("p_log", F.col("p_log") + F.lit(applied))
    raw = B.apply_weights(trained.test, M.MODELS, best, sp)
    predictions = materialize(B.calibrated(raw, applied, sp).selectExpr(sp.row_id, "blend as demand"))

    importance = M.feature_importance(trained.final_models.models["oof_a"], trained.final_models.inputs["oof_a"], spark)
    report = materialize(evaluation_report(calibrated, cold_keys(train, test, sp), sp, predictions, importance))
    metrics = materialize(_metrics(trained, validation, blended, calibrated, best, applied, sp))
    matrix = feature_matrix(built.where("not is_test"), sp).drop(sp.row_id, "is_test", "fold")
    record = materialize(_record(metrics, predictions, report, len(matrix.columns), leaderboard))

    sinks.write_predictions(predictions, f"{out_dir}/predictions", sp)
    sinks.write_oof(oof, f"{out_dir}/oof")
    sinks.write_json(metrics, f"{out_dir}/metrics")
    sinks.write_json(sinks.null_counts(matrix), f"{out_dir}/feature_stats")
    sinks.write_json(evaluation_document(report), f"{out_dir}/eval")
    sinks.write_json(importance.orderBy(F.desc("score"), "name"), f"{out_dir}/importances")
    report.write.mode("overwrite").parquet(f"{out_dir}/report")
    sinks.append_run_record(record, f"{out_dir}/runs")


# The names under which metrics and run log report the four models.
REPORTED = {"oof_a": "lgbm", "oof_b": "cat", "oof_forest": "et", "oof_c": "xgb"}


def _metrics(
    trained: M.Trained, validation: DataFrame, blended: DataFrame, calibrated: DataFrame, best: DataFrame,
    applied: float, sp: Spec,
) -> DataFrame:
    """One row: fold metrics, R2 per model and of the blend, weights and calibration."""
    scores = E.model_r2(validation, M.MODELS, sp)
    by_model = grouped(scores, [], **{f"{name}_oof_r2": f"max(case when model = '{m}' then r2 end)"
                                      for m, name in REPORTED.items()})
    weights = ", ".join(f"'{name}', w_{m}" for m, name in REPORTED.items())
    return (
        by_model.withColumn("fold_row", M.fold_metrics(trained, sp).selectExpr(
            "struct(train_r2, val_r2, n_train, n_val) as s").scalar())
        .withColumn("blend_oof_r2_raw", E.r2_original_scale(blended, sp).select("r2").scalar())
        .withColumn("blend_oof_r2", E.r2_original_scale(calibrated, sp).select("r2").scalar())
        .withColumn("blend_weights", best.selectExpr(f"named_struct({weights}) as w").scalar())
        .withColumn("calibration", F.array(F.lit(1.0), F.lit(float(applied))))
        .selectExpr("*", "blend_weights.lgbm as blend_weight", "fold_row.*").drop("fold_row")
    )


def _record(
    metrics: DataFrame, predictions: DataFrame, report: DataFrame, n_features: int, leaderboard: float | None
) -> DataFrame:
    """The run-log line of a finished run."""
    spread = grouped(predictions, [], s="named_struct('mean', avg(demand), 'std', stddev_pop(demand),"
                                        " 'min', min(demand), 'max', max(demand))").scalar()
    picked = {"res_mean": ("residuals", "mean"), "res_std": ("residuals", "std"), "macro_acc": ("confusion", "macro_acc"),
              "spatial_mae_mean": ("spatial", "mae_mean"), "spatial_mae_max": ("spatial", "mae_max"),
              "test_pred_mean": ("test_pred_dist", "mean"), "test_pred_std": ("test_pred_dist", "std")}
    compact = grouped(report, [], e="named_struct({})".format(", ".join(
        f"'{name}', max(case when section = '{s}' and item = '{i}' then value end)" for name, (s, i) in picked.items()
    ) + ", 'bucket_r2', named_struct({}), 'worst_geo_mae', max(case when section = 'worst' then value end)".format(", ".join(
        f"'{label.split(' ')[0]}', max(case when section = 'bucket_metrics' and item = '{label} r2' then value end)"
        for label in S.BUCKET_LABELS)) + ", 'cold_start', cast(max(case when section = 'cold_start' then value end) as bigint)")).scalar()
    lb = "cast(null as double)" if leaderboard is None else f"{float(leaderboard)!r}D"
    return metrics.withColumn("s", spread).withColumn("eval", compact).selectExpr(
        "date_format(current_timestamp(), \"yyyy-MM-dd'T'HH:mm:ss\") as ts", f"{lb} as lb",
        "round(blend_oof_r2, 4) as blend_calib", "round(blend_oof_r2_raw, 4) as blend_raw",
        "round(lgbm_oof_r2, 4) as lgbm", "round(cat_oof_r2, 4) as cat", "round(et_oof_r2, 4) as et",
        "blend_weights as w", "calibration as calib_ab", "round(val_r2, 4) as val_r2", "round(train_r2, 4) as train_r2",
        f"{n_features}L as n_feat", "n_train", "n_val", "round(s.mean, 5) as pred_mean", "round(s.std, 5) as pred_std",
        "s.min as pred_min", "s.max as pred_max", "eval",
    )

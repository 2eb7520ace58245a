"""Data-quality checks as rows (check, value, threshold, ok).

A check reports; it never raises. Each group of checks is one aggregate over its input.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast import spec as S
from slotcast.functions import scalar as X
from slotcast.operators import evaluate as E
from slotcast.operators.encoding import target_day_stats
from slotcast.operators.profile import grouped
from slotcast.spec import DEFAULT, Spec

# What each check's value is compared with.
RULES: dict[str, tuple[str, float]] = {
    "proxy_equals_own_share": ("<", 0.05),
    "proxy_own_corr_low": (">", 0.5),
    "proxy_own_corr_high": ("<", 0.999),
    "loo_equals_own_share": ("<", 0.01),
    "last_known_violations": ("<", 0.01),
    "nonzero_anchor_share": (">", 0.95),
    "te_recomputation_gap": ("<", 1e-5),
    "value_column_in_matrix": ("=", 0),
    "nulls_train": ("=", 0),
    "nulls_test": ("=", 0),
    "temperature_nulls": ("=", 0),
    "out_of_bounds": ("=", 0),
    "formula_log_same_slot": ("<", 1e-5),
    "formula_relative_slot": ("<", 1e-5),
    "formula_log_target": ("<", 1e-5),
    "missing_features": ("=", 0),
    "unseen_key_share": ("<", 0.10),
    "train_val_gap": ("<", 0.45),
    "val_r2": (">", 0.22),
    "model_a_r2": (">", 0.25),
    "model_b_r2": (">", 0.20),
    "blend_minus_best": (">=", -0.005),
    "oof_corr": ("<", 0.999),
    "oof_not_finite": ("=", 0),
    "oof_min": (">=", 1e-7),
    "oof_max": ("<=", 1.000001),
    "residual_mean": ("<", 0.45),
    "residual_median": ("<", 0.55),
    "residual_extreme_share": ("<", 0.01),
    "macro_acc": (">", 0.40),
    "very_low_acc": (">", 0.70),
    "high_as_very_low": ("<", 0.10),
    "very_low_as_high": ("<", 0.05),
    "bucket_acc_min": (">", 0.10),
    "spatial_mae_mean": ("<", 1.5),
    "hour_r2_min": (">", -0.15),
    "residual_skew": ("<", 2),
    "output_row_gap": ("=", 0),
    "output_nulls": ("=", 0),
    "output_out_of_range": ("=", 0),
    "output_missing_ids": ("=", 0),
    "output_extra_ids": ("=", 0),
    "output_mean_low": (">", 0.03),
    "output_mean_high": ("<", 0.30),
    "output_std": (">", 0.05),
    "output_val_ratio_low": (">", 0.33),
    "output_val_ratio_high": ("<", 3),
}


def reconcile(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Ids only on the left (missing), only on the right (extra) and on both sides."""
    a = left.selectExpr(f"{key} as a").distinct()
    b = right.selectExpr(f"{key} as b").distinct()
    both = a.join(b, a["a"] == b["b"], "full_outer")
    return grouped(both, [], missing="count_if(b is null)", extra="count_if(a is null)",
                   matched="count_if(a is not null and b is not null)")


def check_rows(values: DataFrame) -> DataFrame:
    """Turns one row of values, named as in RULES, into rows; a NULL value is not ok."""
    names = [c for c in values.columns if c in RULES]
    cells = ", ".join(
        f"'{c}', cast({c} as double), {RULES[c][1]!r}D, coalesce({c} {RULES[c][0]} {RULES[c][1]!r}D, false)" for c in names
    )
    return values.selectExpr(f"stack({len(names)}, {cells}) as (check, value, threshold, ok)")


def _share(condition: str, among: str) -> str:
    return f"avg(case when {among} then cast({condition} as double) end)"


def _relative(a: str, b: str) -> str:
    """Largest difference relative to the expected value ``b``."""
    return f"max(abs(({a}) - ({b})) / greatest(abs({b}), 1e-12D))"


def feature_checks(built: DataFrame, sp: Spec = DEFAULT, matrix: DataFrame | None = None) -> DataFrame:
    """Leakage, nulls, bounds and formulas of a built feature frame and of the matrix made from it."""
    matrix_columns = (built.select(*[c for c in S.NUMERIC_FEATURES if c in built.columns]) if matrix is None else matrix).columns
    y, eps = sp.value, f"{sp.eps!r}D"
    hist, target = f"not is_test and {sp.day} = {sp.history_day}", f"not is_test and {sp.day} = {sp.target_day}"
    same, mean = "demand_d48_same_slot", "demand_d48_geohash_mean"
    declared = [c for c in S.NUMERIC_FEATURES if c in built.columns]
    nulls = " + ".join(f"cast({c} is null as int)" for c in declared)
    waves = [c for c in declared if c.startswith("mod_")]
    bounds = [*[f"abs({c}) > 1.000000001D" for c in waves], "abs(lat) > 90", "abs(lon) > 180",
              f"{sp.slot} < 0", f"{sp.slot} > {sp.day_minutes - sp.slot_minutes}",
              "large_vehicles not in (0, 1)", "landmarks not in (0, 1)"]
    corr = f"corr(case when {hist} then {same} end, case when {hist} then {y} end)"
    direct = grouped(
        built, [],
        proxy_equals_own_share=_share(f"abs({same} - {y}) < 1e-10D", hist),
        proxy_own_corr_low=corr, proxy_own_corr_high=corr,
        nonzero_anchor_share=_share("demand_d49_morning_mean > 0", hist),
        nulls_train=f"sum(case when not is_test then {nulls} else 0 end)",
        nulls_test=f"sum(case when is_test then {nulls} else 0 end)",
        temperature_nulls="count_if(Temperature is null)",
        out_of_bounds=f"count_if({' or '.join(bounds)})",
        formula_log_same_slot=_relative("log_demand_d48_same_slot", f"ln(greatest({same}, {eps}))"),
        formula_relative_slot=_relative("demand_d48_relative_slot", f"{same} / ({mean} + {eps})"),
        formula_log_target=_relative("exp(y_log)", y),
    ).withColumns({
        "value_column_in_matrix": F.lit(int(sp.value in matrix_columns)),
        "missing_features": F.lit(len(S.NUMERIC_FEATURES) - len(declared)),
    })
    keys = grouped(built, [sp.key], in_test="bool_or(is_test)", in_train="bool_or(not is_test)")
    unseen = grouped(keys, [], unseen_key_share=_share("not in_train", "in_test"))
    return reduce(DataFrame.unionByName, [check_rows(direct), check_rows(_recomputed(built, target, sp)), check_rows(unseen)])


def _recomputed(built: DataFrame, target: str, sp: Spec) -> DataFrame:
    """Target-day columns against values computed anew per key and joined back."""
    stats = target_day_stats(built.where(target), sp)
    fit = grouped(built.where("fold = -1"), [sp.key], fit_s="sum(y_log)", fit_c="count(y_log)")
    prior = grouped(built.where("not is_test"), [], p="avg(y_log)").scalar()
    rows = (
        built.where(target).select(sp.key, sp.value, "demand_d49_morning_mean", "demand_d49_last_known", "geohash_te")
        .join(stats, sp.key, "left").join(fit, sp.key, "left").withColumn("prior", prior)
    )
    m = sp.te_smoothing
    expected = f"(coalesce(fit_s, 0D) + {m} * prior) / (coalesce(fit_c, 0) + {m})"
    return grouped(
        rows, [],
        loo_equals_own_share=_share(f"abs(demand_d49_morning_mean - {sp.value}) < 1e-10D", "day_cnt > 1"),
        last_known_violations=_share("abs(demand_d49_last_known - day_last) > 1e-10D", "true"),
        te_recomputation_gap=_relative("geohash_te", expected),
    )


def model_checks(predictions: DataFrame, a: str, b: str, train_r2: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """Fit, diversity, residuals and buckets of validation predictions.

    ``predictions`` has y_log, p_log (the blend) and the log predictions of models ``a``
    and ``b``; ``train_r2`` is one row with the training R2.
    """
    scaled = E.on_value_scale(predictions, sp).selectExpr(
        "*", f"{X.from_log(a, sp)} as a", f"{X.from_log(b, sp)} as b", f"{X.from_log(f'0.5D * {a} + 0.5D * {b}', sp)} as ab")
    scores = grouped(scaled, [], val_r2=E.r2("y", "ab"), model_a_r2=E.r2("y", "a"), model_b_r2=E.r2("y", "b"),
                     blend=E.r2("y", "p"), oof_corr=f"corr({a}, {b})",
                     oof_not_finite=f"count_if({a} is null or {b} is null or isnan({a}) or isnan({b}))",
                     oof_min="min(a)", oof_max="max(a)")
    scores = scores.withColumn("train_r2", train_r2.scalar()).selectExpr(
        "*", "abs(train_r2 - val_r2) as train_val_gap", "blend - greatest(model_a_r2, model_b_r2) as blend_minus_best")
    stats = E.residual_stats(predictions)
    sigma = stats.select("std").scalar()
    extreme = predictions.withColumn("sigma", sigma).agg(
        F.expr("avg(cast(abs(y_log - p_log) > 5 * sigma as double))")).scalar()
    residuals = stats.selectExpr("abs(mean) as residual_mean", "abs(median) as residual_median", "abs(skew) as residual_skew")
    residuals = residuals.withColumn("residual_extreme_share", extreme)
    matrix = E.confusion_matrix(predictions, sp)
    total = "(p0 + p1 + p2 + p3)"
    buckets = grouped(
        matrix.join(E.bucket_accuracy(matrix), "bucket"), [],
        macro_acc="avg(acc)", very_low_acc="max(case when bucket = 0 then acc end)",
        high_as_very_low=f"max(case when bucket = 3 then try_divide(p0, {total}) end)",
        very_low_as_high=f"max(case when bucket = 0 then try_divide(p3, {total}) end)",
        bucket_acc_min=f"min(case when {total} >= 10 then acc end)",
    )
    spatial = E.spatial_breakdown(predictions, sp).selectExpr("mae_mean as spatial_mae_mean")
    hours = grouped(E.temporal_breakdown(predictions, sp), [], hour_r2_min="min(r2)")
    return reduce(DataFrame.unionByName, map(check_rows, [scores, residuals, buckets, spatial, hours]))


def output_checks(output: DataFrame, expected: DataFrame, validation_mean: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """Shape, range, ids and distribution of the predictions to deliver."""
    ids = reconcile(expected.select(sp.row_id), output.select(sp.row_id), sp.row_id).selectExpr(
        "missing as output_missing_ids", "extra as output_extra_ids")
    n_expected = grouped(expected, [], n="count(*)").scalar()
    shape = grouped(
        output, [], n="count(*)", output_nulls="count_if(demand is null)",
        output_out_of_range="count_if(demand <= 0 or demand > 1.000000001D)",
        output_mean_low="avg(demand)", output_mean_high="avg(demand)", output_std="stddev_pop(demand)",
    ).withColumn("n_expected", n_expected).withColumn("val_mean", validation_mean.scalar())
    ratio = "output_mean_low / greatest(val_mean, 1e-9D)"
    shape = shape.selectExpr("*", "abs(n - n_expected) as output_row_gap",
                             f"{ratio} as output_val_ratio_low", f"{ratio} as output_val_ratio_high")
    return check_rows(shape).unionByName(check_rows(ids))

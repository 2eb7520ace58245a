"""Evaluation document and run history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.functions import scalar as X
from slotcast.operators import evaluate as E
from slotcast.operators.models import top_features
from slotcast.operators.profile import grouped
from slotcast.spec import DEFAULT, Spec


def _items(df: DataFrame, section: str, digits: dict[str, int], item: str | None = None) -> DataFrame:
    """(section, item, value) rows from the columns of ``df``, rounded as reported."""
    label = f"{item} || ' ' || " if item else ""
    pairs = ", ".join(f"{label}'{c}', {X.rounded(c, n)}" for c, n in digits.items())
    return df.selectExpr(f"stack({len(digits)}, {pairs}) as (item, value)").selectExpr(
        f"'{section}' as section", "item", "value"
    )


DISTRIBUTION = {**{f"p{q}": 5 for q in (10, 25, 50, 75, 90, 99)}, "mean": 5, "std": 5, **{f"frac{i}": 4 for i in range(4)}}
RESIDUALS = {"mean": 4, "p50 as median": 4, "std": 4, "skew": 4, "p5": 4, "p25": 4, "p75": 4, "p95": 4}


def _section(stats: DataFrame, section: str, digits: dict[str, int]) -> DataFrame:
    """The items of one section of ``E.distributions``; their values are NULL where the section has no rows."""
    columns = {c.split(" as ")[-1]: n for c, n in digits.items()}
    one = stats.where(f"section = '{section}'").selectExpr(*[f"max({c.split(' as ')[0]}) as {c.split(' as ')[-1]}" for c in digits])
    return _items(one, section, columns)


def evaluation_report(
    predictions: DataFrame, cold_keys: DataFrame, sp: Spec = DEFAULT, test_values: DataFrame | None = None,
    importance: DataFrame | None = None,
) -> DataFrame:
    """All diagnostics of a stored prediction frame as (section, item, value) rows.

    ``test_values`` adds the distribution of the final predictions in its column ``demand``,
    ``importance`` (name, score) the ten most important features.
    """
    sums = E.level_sums(predictions, sp)
    scaled = E.on_value_scale(predictions, sp).selectExpr("stack(3, 'residuals', y_log - p_log, 'val_pred_dist', p, 'val_true_dist', y) as (section, v)")
    if test_values is not None:
        scaled = scaled.unionByName(test_values.selectExpr("'test_pred_dist' as section", "demand as v"))
    stats = E.distributions(scaled)
    matrix = E.confusion_matrix(predictions, sp, sums["bucket"])
    by_hour = E.temporal_breakdown(predictions, sp, sums["hour"])
    spatial = {"mae_mean": 4, "mae_std": 4, "mae_min": 4, "mae_max": 4, "n_keys": 0}
    cells = ", ".join(f"'{i}', p{i}" for i in range(4))
    parts = [
        _section(stats, "residuals", RESIDUALS),
        _items(E.bucket_metrics(predictions, sp, sums["bucket"]), "bucket_metrics", {"n": 0, "r2": 4, "mae": 5, "acc": 4}, "label"),
        matrix.selectExpr("bucket", f"stack(4, {cells}) as (pred, n)").selectExpr(
            "'confusion' as section", "bucket || '-' || pred as item", "cast(n as double) as value"),
        _items(E.macro_accuracy(matrix), "confusion", {"macro_acc": 4}),
        E.bucket_accuracy(matrix).selectExpr(
            "'confusion' as section", "'acc-' || bucket as item", f"{X.rounded('acc', 4)} as value"),
        _section(stats, "val_pred_dist", DISTRIBUTION),
        _section(stats, "val_true_dist", DISTRIBUTION),
        _items(E.spatial_breakdown(predictions, sp, sums["key"]), "spatial", spatial),
        E.worst_entities(predictions, sp=sp, found=sums["key"]).selectExpr(
            "'worst' as section", f"{sp.key} as item", f"{X.rounded('mae', 4)} as value"),
        by_hour.selectExpr(
            "'temporal' as section", f"cast({sp.hour} as string) as item", f"{X.rounded('r2', 4)} as value"),
        _items(E.temporal_summary(by_hour, sp), "temporal", {"r2_min": 4, "r2_max": 4, "worst_hour": 0}),
        cold_keys.agg(F.count("*").alias("n")).selectExpr(
            "'cold_start' as section", "'n_keys' as item", "cast(n as double) as value"),
    ]
    if test_values is not None:
        parts.append(_section(stats, "test_pred_dist", DISTRIBUTION))
    if importance is not None:
        parts.append(top_features(importance).selectExpr(
            "'feature_importance' as section", "name as item", f"{X.rounded('score', 4)} as value"))
    return reduce(DataFrame.unionByName, parts)


def evaluation_document(report: DataFrame) -> DataFrame:
    """The report as one nested row, section -> item -> value, for the JSON sink."""
    sections = grouped(report, ["section"], items="map_from_entries(collect_list(struct(item, value)))")
    return grouped(sections, [], eval="map_from_entries(collect_list(struct(section, items)))")


def run_history(runs: DataFrame) -> DataFrame:
    """Run records as display text; what is missing, or zero where it never is, shows as '-'."""

    def number(c: str, digits: int, zero_is_missing: bool = False) -> str:
        shown = f"format_string('%.{digits}f', {c})"
        empty = f"{c} is null or {c} = 0" if zero_is_missing else f"{c} is null"
        return f"case when {empty} then '-' else {shown} end as {c}"

    weights = "format_string('%.2f/%.2f/%.2f', coalesce(w.lgbm, 0D), coalesce(w.cat, 0D), coalesce(w.et, 0D))"
    calibration = "coalesce(calib_ab, array(1D, 0D))"
    return runs.selectExpr(
        "coalesce(substring(ts, 1, 16), '-') as ts", number("lb", 2, True), number("blend_calib", 5),
        number("blend_raw", 5), number("lgbm", 5), number("cat", 5), number("et", 5, True),
        f"case when w is null then '-' else {weights} end as weights",
        f"format_string('%.3f,%.3f', {calibration}[0], {calibration}[1]) as calibration",
        number("val_r2", 5, True), "coalesce(cast(n_feat as string), '-') as n_feat", "coalesce(note, '') as note",
    )


def best_run(runs: DataFrame) -> DataFrame:
    """Best leaderboard value, best blended R2 and the latest record."""
    return grouped(runs, [], best_lb="max(lb)", best_oof="max(blend_calib)", latest_ts="max(ts)",
                   latest_note="max_by(note, struct(ts, blend_calib))")

"""Forecast quality: R2 on the value scale, residuals, buckets, locations, hours.

Prediction frames hold ``y_log`` and ``p_log`` (log scale), the key and the hour. All group
results are plain aggregates, combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast import spec as S
from slotcast.functions import scalar as X
from slotcast.functions.quantiles import exact_quantiles
from slotcast.operators.profile import grouped
from slotcast.session import materialize
from slotcast.spec import DEFAULT, Spec


def r2(y: str, p: str) -> str:
    """Aggregate SQL text: 1 - SSE / SST, with SST around the group's own mean.

    Without variance it is 1 for a perfect and 0 for any other prediction.
    """
    sse, sst = f"sum(({y} - {p}) * ({y} - {p}))", f"var_pop({y}) * count({y})"
    return f"case when {sst} > 0 then 1 - {sse} / ({sst}) when {sse} = 0 then 1D when count({y}) > 0 then 0D end"


def on_value_scale(df: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """Adds y and p, the true and predicted values after exp and clipping."""
    return df.where("p_log is not null").selectExpr(
        "*", f"{X.from_log('y_log', sp)} as y", f"{X.from_log('p_log', sp)} as p"
    )


def r2_original_scale(df: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    return grouped(on_value_scale(df, sp), [], n="count(*)", r2=r2("y", "p"))


def competition_score(r2_value: str) -> str:
    return f"greatest(0D, 100 * ({r2_value}))"


def unpivot_models(df: DataFrame, models: list[str], sp: Spec = DEFAULT) -> DataFrame:
    """One row per observation and model; rows a model did not predict are left out."""
    pairs = ", ".join(f"'{m}', {m}" for m in models)
    return df.selectExpr("y_log", f"stack({len(models)}, {pairs}) as (model, p_log)").where("p_log is not null")


def model_r2(df: DataFrame, models: list[str], sp: Spec = DEFAULT) -> DataFrame:
    """R2 per model; a model without any prediction has no row."""
    return grouped(on_value_scale(unpivot_models(df, models, sp), sp), ["model"],
                   n="count(*)", r2=r2("y", "p"), pred_mean="avg(p)")


def residual_stats(df: DataFrame) -> DataFrame:
    """Mean, median, population deviation, population skewness and percentiles of y_log - p_log."""
    probs = {"p5": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95}
    return exact_quantiles(
        df.selectExpr("y_log - p_log as residual"), [], "residual", probs, n="count(*)", mean="avg(_v)", std="stddev_pop(_v)",
        skew="skewness(_v)").select("n", "mean", "std", "skew", *probs)


def all_buckets(df: DataFrame) -> DataFrame:
    """One row per bucket, empty or not."""
    last = len(S.BUCKET_EDGES)
    buckets = df.sparkSession.range(1).selectExpr(f"explode(sequence(0, {last})) as bucket")
    return buckets.selectExpr("bucket", f"{X.bucket_label('bucket')} as label")


# What a group of predictions is reported by; ``pred`` and ``actual`` are the buckets of p and y.
_SUMS = {
    "n": "count(*)", "r2": r2("y", "p"), "mae": "avg(abs(y - p))", "acc": "avg(case when pred = actual then 1D else 0D end)",
    "log_mae": "avg(abs(y_log - p_log))", **{f"p{i}": f"count_if(pred = {i})" for i in range(len(S.BUCKET_EDGES) + 1)},
}


def level_sums(df: DataFrame, sp: Spec = DEFAULT) -> dict[str, DataFrame]:
    """The reported sums per true bucket, per hour and per key, all from one pass over the predictions.

    Stored, since every part of a report reads them; the functions below take them as ``found``.
    """
    by = ["bucket", sp.hour, sp.key]
    rows = _bucketed(df, sp).withColumn("bucket", F.col("actual"))
    sums = [F.expr(f"{e} as {name}") for name, e in _SUMS.items()]
    found = materialize(rows.groupingSets([[c] for c in by], *by).agg(F.grouping_id().alias("_level"), *sums))
    alone = [(1 << len(by)) - 1 - (1 << (len(by) - 1 - i)) for i in range(len(by))]  # all other columns are summed over
    return {name: found.where(f"_level = {level}") for name, level in zip(("bucket", "hour", "key"), alone)}


def _bucketed(df: DataFrame, sp: Spec) -> DataFrame:
    return on_value_scale(df, sp).selectExpr("*", f"{X.bucket('y')} as actual", f"{X.bucket('p')} as pred")


def bucket_metrics(df: DataFrame, sp: Spec = DEFAULT, found: DataFrame | None = None) -> DataFrame:
    """Per true bucket: rows, R2, mean absolute error and share predicted into it; NULL below 2 rows."""
    if found is None:
        found = grouped(_bucketed(df, sp), ["actual as bucket"], **{c: _SUMS[c] for c in ("n", "r2", "mae", "acc")})
    metric = "case when n >= 2 then {0} end as {0}"
    return all_buckets(df).join(found.select("bucket", "n", "r2", "mae", "acc"), "bucket", "left").selectExpr(
        "bucket", "label", "coalesce(n, 0) as n", *[metric.format(m) for m in ("r2", "mae", "acc")]
    )


def confusion_matrix(df: DataFrame, sp: Spec = DEFAULT, found: DataFrame | None = None) -> DataFrame:
    """Per true bucket the number of rows predicted into each bucket (p0, p1, ...)."""
    last = len(S.BUCKET_EDGES)
    if found is None:
        found = grouped(_bucketed(df, sp), ["actual as bucket"], **{f"p{i}": _SUMS[f"p{i}"] for i in range(last + 1)})
    return all_buckets(df).join(found, "bucket", "left").selectExpr(
        "bucket", *[f"coalesce(p{i}, 0) as p{i}" for i in range(last + 1)]
    )


def bucket_accuracy(matrix: DataFrame) -> DataFrame:
    """Share of each true bucket on the diagonal; NULL for an empty bucket."""
    cells = [c for c in matrix.columns if c != "bucket"]
    diagonal = "case bucket " + " ".join(f"when {i} then {c}" for i, c in enumerate(cells)) + " end"
    return matrix.selectExpr("bucket", f"try_divide({diagonal}, {' + '.join(cells)}) as acc")


def macro_accuracy(matrix: DataFrame) -> DataFrame:
    """Mean of the bucket accuracies over buckets that occur."""
    return grouped(bucket_accuracy(matrix), [], macro_acc="avg(acc)", n_buckets="count(acc)")


def value_distribution(df: DataFrame, value: str) -> DataFrame:
    """Percentiles, mean, population deviation and bucket shares of a value column."""
    probs = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p99": 0.99}
    last = len(S.BUCKET_EDGES)
    shares = {f"frac{i}": f"avg(case when {X.bucket('_v')} = {i} then 1D else 0D end)" for i in range(last + 1)}
    return exact_quantiles(df, [], value, probs, n="count(*)", mean="avg(_v)", std="stddev_pop(_v)", **shares).select(
        *probs, "n", "mean", "std", *shares)


def distributions(values: DataFrame) -> DataFrame:
    """Of every ``section`` of a frame (section, v): percentiles, moments and bucket shares, in one plan; stored."""
    percentiles = {f"p{q}": q / 100 for q in (5, 10, 25, 50, 75, 90, 95, 99)}
    shares = {f"frac{i}": f"avg(case when {X.bucket('_v')} = {i} then 1D else 0D end)" for i in range(len(S.BUCKET_EDGES) + 1)}
    return materialize(exact_quantiles(
        values, ["section"], "v", percentiles, n="count(*)", mean="avg(_v)", std="stddev_pop(_v)", skew="skewness(_v)", **shares))


def entity_errors(df: DataFrame, sp: Spec = DEFAULT, found: DataFrame | None = None) -> DataFrame:
    """Mean absolute error per key on the log scale."""
    if found is not None:
        return found.selectExpr(sp.key, "log_mae as mae", "n")
    return grouped(df.where("p_log is not null"), [sp.key], mae="avg(abs(y_log - p_log))", n="count(*)")


def spatial_breakdown(df: DataFrame, sp: Spec = DEFAULT, found: DataFrame | None = None) -> DataFrame:
    return grouped(entity_errors(df, sp, found), [], mae_mean="avg(mae)", mae_std="stddev_pop(mae)",
                   mae_min="min(mae)", mae_max="max(mae)", n_keys="count(*)")


def worst_entities(df: DataFrame, n: int = 5, sp: Spec = DEFAULT, found: DataFrame | None = None) -> DataFrame:
    """The n keys with the largest error, equal errors by key."""
    return entity_errors(df, sp, found).select(sp.key, "mae").orderBy(["mae", sp.key], ascending=[False, True]).limit(n)


def temporal_breakdown(df: DataFrame, sp: Spec = DEFAULT, found: DataFrame | None = None) -> DataFrame:
    """R2 for each of the 24 hours; NULL below 2 rows."""
    if found is None:
        found = grouped(on_value_scale(df, sp), [sp.hour], n="count(*)", r2=r2("y", "p"))
    found = found.select(sp.hour, "n", "r2")
    hours = df.sparkSession.range(1).selectExpr(f"explode(sequence(0, 23)) as {sp.hour}")
    return hours.join(found, sp.hour, "left").selectExpr(
        sp.hour, "coalesce(n, 0) as n", "case when n >= 2 then r2 end as r2"
    )


def temporal_summary(by_hour: DataFrame, sp: Spec = DEFAULT, digits: int = 4) -> DataFrame:
    """Lowest and highest hourly R2 and the hour with the lowest, the first one on ties."""
    rounded = by_hour.where("r2 is not null").selectExpr(sp.hour, f"{X.rounded('r2', digits)} as r2")
    return grouped(rounded, [], r2_min="min(r2)", r2_max="max(r2)", worst_hour=f"min_by({sp.hour}, struct(r2, {sp.hour}))")


def prediction_summary(df: DataFrame, value: str, sp: Spec = DEFAULT) -> DataFrame:
    """Range, mean, median, deviation and share of clipped predictions."""
    clipped = f"_v <= {sp.clip_lo + 1e-12!r}D or _v >= {sp.clip_hi - 1e-12!r}D"
    return exact_quantiles(
        df, [], value, {"median": 0.5}, n="count(*)", min="min(_v)", max="max(_v)", mean="avg(_v)", std="stddev_pop(_v)",
        pct_clipped=f"100 * avg(case when {clipped} then 1D else 0D end)",
    ).select("n", "min", "max", "mean", "std", "pct_clipped", "median")


def fold_summary(df: DataFrame, value: str, fold: str = "fold") -> DataFrame:
    """Rows, mean and exact median of a value per fold."""
    q = exact_quantiles(df, [fold], value, {"median": 0.5})
    return grouped(df, [fold], n="count(*)", mean=f"avg({value})").join(q, fold, "left")


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, one row per pair."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    wide = grouped(df, [], **{f"c{i}": f"corr({a}, {b})" for i, (a, b) in enumerate(pairs)})
    cells = ", ".join(f"'{a}', '{b}', c{i}" for i, (a, b) in enumerate(pairs))
    return wide.selectExpr(f"stack({len(pairs)}, {cells}) as (a, b, r)")


def describe(df: DataFrame, value: str, key: str, day: str) -> DataFrame:
    """Row and key counts, the days, and count/mean/deviation/quartiles of a value."""
    q = exact_quantiles(df, [], value, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    out = grouped(df, [], n_rows="count(*)", n_keys=f"count(distinct {key})",
                  days=f"array_join(array_sort(collect_set({day})), ',')",
                  n_values=f"count({value})", mean=f"avg({value})", std=f"stddev_samp({value})",
                  min=f"min({value})", max=f"max({value})")
    return out.withColumn("q", q.selectExpr("struct(q25, q50, q75) as q").scalar()).select("*", "q.*").drop("q")

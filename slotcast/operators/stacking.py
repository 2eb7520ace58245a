"""Ridge stacking: a second-level linear model over out-of-fold predictions and other columns.

All that a fit needs from the rows is one aggregate per fold: counts, sums and sums of
products. The fit without a fold is the total minus that fold's part, so cross-validation
over any number of folds and penalties reads the rows twice, once for the sums and once for
the scores. The normal equations, of the size of the feature list, are solved by a Cholesky
factorisation written out as columns of the one-row-per-system frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.operators.evaluate import on_value_scale, r2
from slotcast.operators.profile import grouped
from slotcast.spec import DEFAULT, Spec

SINGULAR = 1e-12  # share of its own variance below which a feature is a combination of the earlier ones
EVERY_ROW = -1  # fold number of the fit that leaves nothing out


def _complete(rows: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    present = " and ".join(f"{c} is not null and not isnan({c})" for c in [*features, target])
    return rows.where(present)


def fold_sums(rows: DataFrame, features: Sequence[str], target: str, fold: str) -> DataFrame:
    """Per fold: n, sums and sums of products of the features and the target; rows that lack one are left out."""
    names = [*features, target]
    sums = {"n": "count(*)", **{f"s{i}": f"sum({a})" for i, a in enumerate(names)}}
    sums |= {f"p{i}_{j}": f"sum({a} * {names[j]})" for i, a in enumerate(names) for j in range(i, len(names))}
    return grouped(_complete(rows, features, target), [f"{fold} as fold"], **sums)


def systems(sums: DataFrame) -> DataFrame:
    """The sums of all rows, as fold EVERY_ROW, and of all rows outside each fold."""
    columns = [c for c in sums.columns if c != "fold"]
    every = grouped(sums, [], **{c: f"sum({c})" for c in columns})
    total = every.select(F.struct(*columns).alias("t")).scalar()
    outside = sums.withColumn("t", total).selectExpr("fold", *[f"t.{c} - {c} as {c}" for c in columns])
    return every.selectExpr(f"{EVERY_ROW} as fold", *columns).unionByName(outside).where("n > 0")


def solve(sums: DataFrame, features: Sequence[str], alphas: Sequence[float]) -> DataFrame:
    """``fold, alpha, n, w_<feature>..., intercept`` for every system and penalty alpha * |w|^2; the intercept is free.

    A feature that the earlier ones determine gets weight 0.
    """
    k = len(features)
    lists = ", ".join(f"{float(a)!r}D" for a in alphas)
    out = sums.selectExpr("*", f"explode(array({lists})) as alpha")
    centred = [f"p{i}_{j} - s{i} * s{j} / n + {'alpha' if i == j else '0D'} as a{j}_{i}" for i in range(k) for j in range(i, k)]
    centred += [f"p{i}_{k} - s{i} * s{k} / n as b{i}" for i in range(k)]
    out = out.selectExpr("fold", "alpha", "n", *[f"s{i} / n as m{i}" for i in range(k + 1)], *centred)
    for j in range(k):  # one column of the factor at a time
        left = [f"a{i}_{j}" + "".join(f" - l{i}_{m} * l{j}_{m}" for m in range(j)) for i in range(j, k)]
        out = out.selectExpr("*", f"case when {left[0]} > {SINGULAR!r}D * a{j}_{j} then sqrt({left[0]}) else 0D end as l{j}_{j}")
        out = out.selectExpr("*", *[f"case when l{j}_{j} > 0 then ({x}) / l{j}_{j} else 0D end as l{i}_{j}"
                                    for i, x in zip(range(j + 1, k), left[1:])])
        out = out.selectExpr("*", f"case when l{j}_{j} > 0 then (b{j}{''.join(f' - l{j}_{m} * z{m}' for m in range(j))}) / l{j}_{j} else 0D end as z{j}")
    for j in reversed(range(k)):
        below = "".join(f" - l{i}_{j} * w{i}" for i in range(j + 1, k))
        out = out.selectExpr("*", f"case when l{j}_{j} > 0 then (z{j}{below}) / l{j}_{j} else 0D end as w{j}")
    intercept = f"m{k}" + "".join(f" - w{i} * m{i}" for i in range(k))
    return out.selectExpr("fold", "alpha", "n", *[f"w{i} as w_{f}" for i, f in enumerate(features)], f"{intercept} as intercept")


def fit(rows: DataFrame, features: Sequence[str], target: str = "y_log", alpha: float = 1.0) -> DataFrame:
    """One row of weights from all rows."""
    return solve(systems(fold_sums(rows.withColumn("_one", F.lit(0)), features, target, "_one")).where(f"fold = {EVERY_ROW}"), features, [alpha])


def cross_validate(
    rows: DataFrame, features: Sequence[str], fold: str, alphas: Sequence[float], target: str = "y_log", sp: Spec = DEFAULT
) -> DataFrame:
    """``alpha, n, r2`` on the value scale, every row predicted by the fit without its fold."""
    weights = solve(systems(fold_sums(rows, features, target, fold)), features, alphas).where(f"fold <> {EVERY_ROW}")
    fields = ", ".join(["alpha", *[f"w_{f}" for f in features], "intercept"])
    lists = grouped(weights, ["fold as _fold"], _fits=f"collect_list(struct({fields}))")
    scored = (
        _complete(rows, features, target).join(lists, F.col(fold) == F.col("_fold"))
        .selectExpr(*features, f"{target} as y_log", "explode(_fits) as _w")
        .selectExpr("_w.alpha as alpha", "y_log", f"{_linear(features, '_w.')} as p_log"))
    return grouped(on_value_scale(scored, sp), ["alpha"], n="count(*)", r2=r2("y", "p"))


def best_alpha(scores: DataFrame) -> DataFrame:
    """The row with the highest R2, the smallest penalty on ties."""
    return scores.orderBy(F.desc("r2"), "alpha").limit(1)


def _linear(features: Sequence[str], weights: str) -> str:
    return " + ".join([f"{weights}intercept", *[f"{weights}w_{f} * {f}" for f in features]])


def predict(rows: DataFrame, weights: DataFrame, features: Sequence[str]) -> DataFrame:
    """Adds p_log from the one row of ``weights``; null where a feature is."""
    one = weights.select(F.struct(*[f"w_{f}" for f in features], "intercept").alias("w")).scalar()
    return rows.withColumn("_w", one).selectExpr("*", f"{_linear(features, '_w.')} as p_log").drop("_w")

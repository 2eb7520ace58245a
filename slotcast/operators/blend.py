"""Blend weights on the simplex and the log-shift calibration.

Candidates are enumerated inside the row (a fixed number per row) and reduced to one sum of
squared errors per candidate before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.functions import scalar as X
from slotcast.operators.evaluate import r2
from slotcast.operators.profile import grouped
from slotcast.spec import DEFAULT, Spec

# Concentration penalty, grid resolutions, largest shift, shrinkage.
PENALTY = 0.01
SIMPLEX_STEPS = 20
SHIFT_STEPS = 71
MAX_SHIFT = 0.7
CALIBRATION_SHRINK = 0.0


def _counts(df: DataFrame, models: Sequence[str]) -> Column:
    """Scalar: a struct with the number of predictions of every model; 0 marks one that is absent."""
    counts = grouped(df, [], s=f"named_struct({', '.join(f'{m!r}, count({m})' for m in models)})")
    return counts.select("s").scalar()


def _complete(df: DataFrame, models: Sequence[str], sp: Spec) -> DataFrame:
    """Rows that every model predicted; one that is absent altogether counts as 0 and must get no weight."""
    present = " and ".join(f"({m} is not null or _have.{m} = 0)" for m in models)
    return df.withColumn("_have", _counts(df, models)).where(f"{present} and y_log is not null").selectExpr(
        *[f"coalesce({m}, 0D) as {m}" for m in models], f"{X.from_log('y_log', sp)} as y")


def simplex_scores(
    df: DataFrame, models: Sequence[str], steps: int = SIMPLEX_STEPS, penalty: float = PENALTY, sp: Spec = DEFAULT
) -> DataFrame:
    """Weights w_<model> on a grid of step 1/steps with R2 and score = R2 - penalty * sum of squares."""
    rows = _complete(df, models, sp)
    sst = grouped(rows, [], v="var_pop(y) * count(y)").scalar()
    free = [f"i{j}" for j in range(len(models) - 1)]
    for j, name in enumerate(free):
        rest = " - ".join([str(steps), *free[:j]])
        rows = rows.selectExpr("*", f"explode(sequence(0, {rest})) as {name}")
    counts = [*free, f"({' - '.join([str(steps), *free])})"]
    blended = " + ".join(f"{c} * {m}" for c, m in zip(counts, models))
    rows = rows.selectExpr("y", *free, f"{X.from_log(f'({blended}) / {float(steps)!r}D', sp)} as p")
    scored = grouped(rows, free, sse="sum((y - p) * (y - p))").select(
        *[F.expr(f"{c} / {float(steps)!r}D").alias(f"w_{m}") for c, m in zip(counts, models)],
        _r2_of(F.col("sse"), sst).alias("r2"),
    )
    usable = " and ".join(f"(w_{m} = 0 or _have.{m} > 0)" for m in models)
    scored = scored.withColumn("_have", _counts(df, models)).where(usable).drop("_have")
    return _with_score(scored, models, penalty)


def _r2_of(sse: Column, sst: Column) -> Column:
    return F.when(sst > 0, 1 - sse / sst).when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))


def _with_score(scored: DataFrame, models: Sequence[str], penalty: float) -> DataFrame:
    squares = " + ".join(f"w_{m} * w_{m}" for m in models)
    return scored.selectExpr("*", f"r2 - {penalty!r}D * ({squares}) as score")


def best_weights(scores: DataFrame, models: Sequence[str]) -> DataFrame:
    """The row with the highest score; equal scores take the smallest weights in model order."""
    weights = [f"w_{m}" for m in models]
    return scores.orderBy(["score", *weights], ascending=[False] + [True] * len(weights)).limit(1)


def grid_optima(scores: DataFrame, models: Sequence[str], steps: int = SIMPLEX_STEPS, most: int = 5) -> DataFrame:
    """Grid points that no neighbour beats, best first: the starts of a local search. Ties as in ``best_weights``.

    A neighbour has one step of weight moved between two models.
    """
    at, weights = [f"i{j}" for j in range(len(models))], [f"w_{m}" for m in models]
    grid = scores.selectExpr(*[f"cast(round({w} * {steps}) as int) as {i}" for i, w in zip(at, weights)], *weights, "r2", "score")
    moved = [", ".join(f"{i} + {int(j == up) - int(j == down)} as {i}" for j, i in enumerate(at))
             for up in range(len(at)) for down in range(len(at)) if up != down]
    reached = grid.selectExpr("score as near", f"explode(array({', '.join(f'struct({m})' for m in moved)})) as cell").selectExpr("near", "cell.*")
    tops = grid.join(grouped(reached, at, near="max(near)"), at, "left").where("near is null or score >= near")
    return tops.select(*weights, "r2", "score").orderBy(["score", *weights], ascending=[False] + [True] * len(weights)).limit(most)


def refine_weights(
    df: DataFrame, models: Sequence[str], start: dict[str, float] | Sequence[dict[str, float]], step: float,
    min_step: float = 1e-3, penalty: float = PENALTY, sp: Spec = DEFAULT,
) -> dict[str, float]:
    """Moves weight between two models at a time around ``start``, halving the step when nothing improves.

    Several starts are refined together, one pass over the rows for all of them, and the best
    end is returned; of equal ones that of the earliest start. A model without any prediction
    gets no weight. Only a score per candidate comes to the driver.
    """
    have = grouped(df, [], **{m: f"count({m})" for m in models}).first()
    ends = [_End([s[m] for m in models], step) for s in ([start] if isinstance(start, dict) else start)]
    while moving := [e for e in ends if e.step >= min_step]:
        trials = [e.trials([have[m] > 0 for m in models]) for e in moving]
        found = _score_candidates(df, models, [w for t in trials for w in t], penalty, sp)
        scores = [r["score"] for r in found.orderBy("candidate").collect()]
        for end, mine in zip(moving, trials):
            end.take(mine, scores[:len(mine)])
            scores = scores[len(mine):]
    return dict(zip(models, max(ends, key=lambda e: e.score).weights))


@dataclass
class _End:
    """Where a local search stands."""

    weights: list[float]
    step: float
    score: float = float("-inf")

    def trials(self, usable: list[bool]) -> list[list[float]]:
        """The weights themselves, then every move of one step."""
        found = [self.weights]
        for i in range(len(self.weights)):
            for j in range(len(self.weights)):
                moved = min(self.step, self.weights[j])
                if i != j and moved > 0 and usable[i]:
                    trial = list(self.weights)
                    trial[i], trial[j] = trial[i] + moved, trial[j] - moved
                    found.append(trial)
        return found

    def take(self, trials: list[list[float]], scores: list[float]) -> None:
        top = max(range(len(trials)), key=lambda i: scores[i])  # the first of equal ones
        if scores[top] > self.score:
            self.weights, self.score = trials[top], scores[top]
        else:
            top = 0
        if top == 0:
            self.step /= 2


def _score_candidates(
    df: DataFrame, models: Sequence[str], candidates: list[list[float]], penalty: float, sp: Spec
) -> DataFrame:
    rows = _complete(df, models, sp)
    aggregates = {"sst": "var_pop(y) * count(y)"}
    for i, w in enumerate(candidates):
        p = X.from_log(" + ".join(f"{x!r}D * {m}" for x, m in zip(w, models)), sp)
        aggregates[f"e{i}"] = f"sum((y - {p}) * (y - {p}))"
    pairs = ", ".join(
        f"{i}, e{i}, {sum(x * x for x in w) * penalty!r}D" for i, w in enumerate(candidates))
    return (
        grouped(rows, [], **aggregates)
        .selectExpr("sst", f"stack({len(candidates)}, {pairs}) as (candidate, sse, cost)")
        .selectExpr("candidate", "(case when sst > 0 then 1 - sse / sst when sse = 0 then 1D else 0D end) - cost as score")
    )


def weighted_log(models: Sequence[str], weights: str = "w") -> str:
    """SQL text: blended log prediction from a struct column of weights w_<model>."""
    return " + ".join(f"{weights}.w_{m} * {m}" for m in models)


def apply_weights(df: DataFrame, models: Sequence[str], best: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """Adds blend_log and the clipped value ``blend`` using the one row of weights in ``best``."""
    w = best.selectExpr(f"struct({', '.join(f'w_{m}' for m in models)}) as w").scalar()
    out = df.withColumn("w", w).selectExpr("*", f"{weighted_log(models)} as blend_log").drop("w")
    return out.selectExpr("*", f"{X.from_log('blend_log', sp)} as blend")


def calibrated(df: DataFrame, shift: float, sp: Spec = DEFAULT) -> DataFrame:
    """``blend`` recomputed with the applied log shift; blend_log is what it is computed from."""
    return df.withColumn("blend", F.expr(X.from_log(f"blend_log + {float(shift)!r}D", sp)))


def shift_scores(df: DataFrame, steps: int = SHIFT_STEPS, max_shift: float = MAX_SHIFT, sp: Spec = DEFAULT) -> DataFrame:
    """R2 for every log shift on the grid; shift 0 is the uncorrected prediction."""
    shift = f"i * {max_shift!r}D / {steps - 1}"
    rows = (
        df.where("p_log is not null").selectExpr("p_log", f"{X.from_log('y_log', sp)} as y")
        .selectExpr("*", f"explode(sequence(0, {steps - 1})) as i")
        .selectExpr("i", "y", f"{X.from_log(f'p_log + {shift}', sp)} as p")
    )
    return grouped(rows, ["i"], r2=r2("y", "p")).selectExpr(f"{shift} as log_shift", "r2")


def best_shift(scores: DataFrame, shrink: float = CALIBRATION_SHRINK) -> DataFrame:
    """Smallest shift with the highest R2 and the part of it that is applied."""
    top = scores.orderBy(["r2", "log_shift"], ascending=[False, True]).limit(1)
    return top.selectExpr("log_shift", "r2", f"log_shift * {shrink!r}D as applied_shift")


def reblend(
    df: DataFrame, weights: dict[str, float] | None, fallback: tuple[str, str, float],
    calibration: tuple[float, float] | None = None, required: Sequence[str] = ("oof_forest",),
) -> DataFrame:
    """Blended log prediction from stored columns.

    With weights, a model column missing on a row makes the blend missing there; a model
    without any prediction drops out of the sum. Without weights, or where a ``required``
    model is absent, the two fallback models are mixed w to 1 - w. ``calibration`` is a*x + b.
    """
    a, b, w = fallback
    mixed = f"{w!r}D * {a} + {1 - w!r}D * {b}"
    if weights:
        total = " + ".join(f"case when _have.{m} > 0 then {x!r}D * {m} else 0D end" for m, x in weights.items())
        lacking = " or ".join([f"_have.{m} = 0" for m in required if m in weights] or ["false"])
        blended = f"case when {lacking} then {mixed} else {total} end"
        df = df.withColumn("_have", _counts(df, list(weights)))
    else:
        blended = mixed
    if calibration:
        blended = f"{calibration[0]!r}D * ({blended}) + {calibration[1]!r}D"
    return df.selectExpr("*", f"{blended} as p_log").drop("_have")

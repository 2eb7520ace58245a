"""Exact quantiles in one lazy plan, whatever the size of a group.

A mergeable sketch per group gives, around every wanted rank, two values between which the
rank lies for certain. In a second pass rows inside such a bracket are counted by value and
rows between brackets by the gap they fall into, both combined before the shuffle; running
sums over these few counts give the ranks. So of a large group only a small, fixed share
reaches one task; groups of up to WHOLE rows are their own bracket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000  # the sketch errs by at most 1 / ACCURACY of the ranks
EDGE = 3e-4  # half width of a bracket as a share of the ranks; must exceed that error
WHOLE = 1 << 16  # (EDGE - 1 / ACCURACY) * WHOLE ranks must be several, so that rounding ranks stays inside


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float], weight: str | None = None,
    **also: str,
) -> DataFrame:
    """``by`` columns plus one linearly interpolated quantile per entry of ``probs``.

    Null values are left out; NaN counts as larger than all other values. ``also`` names
    further aggregates (SQL over the values, as ``_v``) that the first pass computes beside
    the sketch. ``weight`` names a column that says how often a row counts; such rows are
    equal values that were counted before, and all of a group's go through one task, in order.
    """
    by = list(by)
    rows = df.select(*by, F.col(value).cast("double").alias("_v"),
                     (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("_c")).where("_v is not null and _c > 0")
    wanted = sorted(set(probs.values()))
    sides = [(max(p - EDGE, 0.0), min(p + EDGE, 1.0)) for p in wanted]
    points = ", ".join(f"{e!r}D" for pair in sides for e in pair)
    sketch = "cast(null as array<double>)" if weight else f"approx_percentile({_ORDERED}, array({points}), {ACCURACY})"
    first = rows.groupBy(*by).agg(
        F.sum("_c").alias("_n"), F.expr(sketch).alias("_q"), *[F.expr(f"{e} as {name}") for name, e in also.items()])
    limits = [_limits(i, *pair) for i, pair in enumerate(sides)]
    inside = " or ".join(f"({_ORDERED} >= {lo} and {_ORDERED} <= {hi})" for lo, hi in limits)
    gap = " + ".join(f"cast({_ORDERED} > {hi} as int)" for _, hi in limits)
    bracketed = _with_group(rows, first.select(*by, "_n", "_q"), by)
    marked = bracketed.selectExpr(
        *[f"`{c}`" for c in by], "_n", "_v", "_c", f"case when not ({inside}) then {gap} end as _gap")
    counts = marked.groupBy(*by, "_n", "_gap", F.expr("case when _gap is null then _v end").alias("_x")).agg(
        F.sum("_c").alias("_c"), F.min("_v").alias("_v"))
    upto = Window.partitionBy(*by).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counts.withColumn("_past", F.sum("_c").over(upto))
    ends = {name: (F.floor(_position(p)), F.ceil(_position(p))) for name, p in probs.items()}
    found = placed.groupBy(*by).agg(F.max("_n").alias("_n"), *[
        F.max(F.when(_holds(rank), F.col("_v"))).alias(f"_{name}_{i}") for name, pair in ends.items() for i, rank in enumerate(pair)])
    values = [_between(f"_{name}_0", f"_{name}_1", p).alias(name) for name, p in probs.items()]
    if not also:
        return found.select(*by, *values)
    return _with_group(found.select(*by, *values), first.select(*by, *also), by)


# Numbers in their order, NaN with the infinite ones at the upper end.
_ORDERED = "nanvl(_v, double('Infinity'))"


def _limits(i: int, low: float, high: float) -> tuple[str, str]:
    """SQL for the ends of the i-th bracket; small groups and the outermost ranks have no end."""
    lo = f"if(_n > {WHOLE} and {low!r}D > 0D, coalesce(_q[{2 * i}], double('-Infinity')), double('-Infinity'))"
    hi = f"if(_n > {WHOLE} and {high!r}D < 1D, coalesce(_q[{2 * i + 1}], double('Infinity')), double('Infinity'))"
    return lo, hi


def _with_group(rows: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` with the other columns of their group's row; a null group is a group."""
    added = [c for c in groups.columns if c not in by]
    if not by:
        one = groups.select(F.struct(*added).alias("s")).scalar()
        return rows.withColumn("_g", one).select(*rows.columns, "_g.*")
    renamed = groups.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], *added)
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    return rows.join(renamed, same).select(*rows.columns, *added)


def _position(p: float) -> Column:
    return F.lit(float(p)) * (F.col("_n") - 1)


def _holds(rank: Column) -> Column:
    """Whether a row's run of equal values covers the rank."""
    return (rank >= F.col("_past") - F.col("_c")) & (rank < F.col("_past"))


def _between(low: str, high: str, p: float) -> Column:
    share = _position(p) - F.floor(_position(p))
    return F.when(F.col(low) == F.col(high), F.col(low)).otherwise(F.col(low) + (F.col(high) - F.col(low)) * share)

"""Target encodings and leave-one-out means.

All of them come from sums and counts that are combined before the shuffle; a row's own
contribution, or its fold's, is subtracted or left out afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.operators.profile import grouped
from slotcast.session import materialize
from slotcast.spec import DEFAULT, Spec


def smooth(total: str, count: str, prior: Column, m: float) -> Column:
    """(sum + m * prior) / (count + m), the prior itself where nothing was counted."""
    c = F.coalesce(F.col(count), F.lit(0))
    return F.when(c > 0, (F.col(total) + prior * m) / (c + m)).otherwise(prior)


def smoothed_te(rows: DataFrame, by: Sequence[str], target: str, prior: Column, m: float, name: str = "te") -> DataFrame:
    """One encoded value per group."""
    totals = grouped(rows, list(by), s=f"sum({target})", c=f"count({target})")
    return totals.select(*by, smooth("s", "c", prior, m).alias(name))


def fold_totals(rows: DataFrame, by: Sequence[str], target: str, fold: str = "fold") -> DataFrame:
    """Per group and fold: sum and count of the target."""
    return grouped(rows, [*by, f"{fold} as fold"], s=f"sum({target})", c=f"count({target})")


def encoding_array(n_folds: int, prior: Column, m: float) -> Column:
    """Array from sums s, c (all rows) and s0, c0, s1, c1, ... (all rows outside that fold)."""
    return F.array(*[smooth(f"s{f}", f"c{f}", prior, m) for f in ["", *range(n_folds)]])


def encodings_by_fold(
    totals: DataFrame, by: Sequence[str], n_folds: int, prior: Column, m: float, name: str, keep_sums: bool = False
) -> DataFrame:
    """Per group an array: entry 0 uses all rows, entry f + 1 all rows outside fold f."""
    outside = {f"s{f}": f"sum(case when fold <> {f} then s end)" for f in range(n_folds)}
    outside |= {f"c{f}": f"sum(case when fold <> {f} then c end)" for f in range(n_folds)}
    sums = grouped(totals, list(by), s="sum(s)", c="sum(c)", **outside)
    kept = ["s", "c", *outside] if keep_sums else []
    return sums.select(*by, *kept, encoding_array(n_folds, prior, m).alias(name))


def for_fold(encodings: str, prior: Column, fold: str = "fold") -> Column:
    """The encoding a row of this fold may see; unlabelled and training rows see all rows."""
    return F.coalesce(F.expr(f"get({encodings}, coalesce({fold}, -1) + 1)"), prior)


def foldsafe_te(
    train: DataFrame, rows: DataFrame, by: Sequence[str], target: str, n_folds: int = 1,
    m: float = DEFAULT.te_smoothing, name: str = "te", fold: str = "fold",
) -> DataFrame:
    """``rows`` with the encoding of their group that leaves out their own fold."""
    prior = grouped(train, [], p=f"avg({target})").scalar()
    table = encodings_by_fold(fold_totals(train, by, target, fold), by, n_folds, prior, m, "_te")
    return rows.join(table, list(by), "left").withColumn(name, for_fold("_te", prior, fold)).drop("_te")


def inner_fold_te(
    train: DataFrame, rows: DataFrame, key: str, row_id: str, target: str, n_folds: int, m: float, name: str,
    fold: str = "fold",
) -> DataFrame:
    """``rows`` with a key encoding fitted on fold -1 alone, without the part a row itself is in.

    Rows of fold -1 are dealt into ``n_folds`` parts by a hash of their id and see the other
    parts only; validation and unlabelled rows see all of fold -1. Neither a row's own value
    nor any validation value reaches the encoding of a training row, the prior included.
    """
    part = f"pmod(xxhash64({row_id}), {n_folds})"
    fit = train.where(f"{fold} = -1 and {target} is not null").selectExpr(key, f"cast({part} as int) as part", target)
    totals = materialize(grouped(fit, [key, "part"], s=f"sum({target})", c=f"count({target})"))
    outside = [("", "true"), *[(str(i), f"part <> {i}") for i in range(n_folds)]]
    sums = {f"s{i}": f"coalesce(sum(case when {w} then s end), 0D)" for i, w in outside}
    sums |= {f"c{i}": f"coalesce(sum(case when {w} then c end), 0)" for i, w in outside}
    arrays = [f"array({', '.join(f'{x}{i}' for i, _ in outside)}) as _{x}" for x in "sc"]
    by_key = grouped(totals, [key], **sums).selectExpr(key, *arrays)
    overall = grouped(totals, [], **sums).selectExpr(
        f"array({', '.join(f'try_divide(s{i}, c{i})' for i, _ in outside)}) as p").scalar()
    at = f"case when {fold} = -1 then cast({part} as int) + 1 else 0 end"
    return (
        rows.join(by_key, key, "left").withColumn("_p", overall).selectExpr("*", f"{at} as _at")
        .withColumn(name, F.expr(f"(coalesce(_s[_at], 0D) + {m!r}D * coalesce(_p[_at], _p[0], 0D)) / (coalesce(_c[_at], 0) + {m!r}D)"))
        .drop("_s", "_c", "_p", "_at")
    )


def leave_one_out(total: str, count: str, own: str, otherwise: str) -> str:
    """Mean of the group without the row itself; ``otherwise`` where it is alone (SQL text)."""
    return f"case when {count} > 1 then ({total} - {own}) / ({count} - 1) else {otherwise} end"


def target_day_stats(rows: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """Per key on the target day: sum, count, mean and the value of the latest slot."""
    y = sp.value
    return grouped(rows, [sp.key], day_sum=f"sum({y})", day_cnt=f"count({y})", day_mean=f"avg({y})",
                   day_last=f"max_by({y}, struct({sp.slot}, {sp.row_id}))")

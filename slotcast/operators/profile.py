"""Aggregates of one day's observations: the (key, slot) profile and what follows from it.

The profile holds one row per key and slot, at most ``day_minutes / slot_minutes`` per
key however many raw rows a key has. Every coarser mean is a sum of its sums, and every
window over a key runs on those few rows, so a key with very many rows costs no more
than the map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.functions.quantiles import exact_quantiles
from slotcast.functions.scalar import hour_of_slot
from slotcast.spec import DEFAULT, Spec

# Period-of-day windows [from hour, to hour).
PERIODS = {"night": (0, 6), "peak_am": (7, 10), "midday": (10, 14), "peak_pm": (16, 20)}

MEAN = "sum(total) / sum(n)"


def grouped(df: DataFrame, by: list[str], **aggregates: str) -> DataFrame:
    """``groupBy`` with aggregates given as SQL text; ``by`` may hold ``expr as name``."""
    return df.groupBy(*[F.expr(b) for b in by]).agg(*[F.expr(f"{e} as {name}") for name, e in aggregates.items()])


def on_day(df: DataFrame, day: int, sp: Spec = DEFAULT) -> DataFrame:
    return df.where(f"{sp.day} = {day}")


def slot_profile(rows: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """(key, slot) -> n, total, mean and m2, the squared deviations around that mean."""
    y = sp.value
    return grouped(
        rows.where(f"{y} is not null"), [sp.key, sp.slot],
        n=f"count({y})", total=f"sum({y})", mean=f"avg({y})", m2=f"var_pop({y}) * count({y})",
    )


def global_mean(profile: DataFrame) -> DataFrame:
    return grouped(profile, [], global_mean=MEAN)


def slot_mean(profile: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    return grouped(profile, [sp.slot], slot_mean=MEAN)


def slot_shape(profile: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """Slot mean as a multiple of the overall mean."""
    by_slot = grouped(profile, [sp.slot], t="sum(total)", c="sum(n)")
    overall = grouped(by_slot, [], m="sum(t) / sum(c)").scalar()
    return by_slot.select(sp.slot, (F.expr("t / c") / (overall + sp.eps)).alias("slot_shape"))


def global_row(profile: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """One row, one struct: overall mean, number of slots, slot -> mean (one entry per slot)."""
    by_slot = grouped(profile, [sp.slot], t="sum(total)", c="sum(n)")
    return grouped(by_slot, [], g=f"""named_struct(
        'mean', sum(t) / sum(c), 'n_slots', count(*),
        'slot_mean', map_from_entries(collect_list(struct({sp.slot}, t / c))))""")


def entries(value: str, key: str) -> str:
    """SQL text: map from ``key`` to ``value`` over the rows of a group."""
    return f"map_from_entries(collect_list(struct({key}, {value})))"


def key_table(profile: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """Everything about one key in one row, from a single shuffle by key.

    n, total, mean, sample deviation, variation, log mean, period means; ``prof`` maps the
    slot to its mean and ``dyn`` to (velocity, acceleration, rank in day). A caller that
    needs few of the columns pays for those only.
    """
    key, hour = sp.key, hour_of_slot(sp.slot)
    centred = rank_in_day(dynamics(profile, sp), sp).selectExpr(
        "*", f"sum(total) over (partition by {key}) / sum(n) over (partition by {key}) as mu"
    )

    def period(lo: int, hi: int) -> str:
        inside = f"{hour} >= {lo} and {hour} < {hi}"
        return f"try_divide(sum(case when {inside} then total end), sum(case when {inside} then n end))"

    stats = grouped(
        centred, [key], n="sum(n)", total="sum(total)", mean=MEAN,
        deviations="sum(m2 + n * (mean - mu) * (mean - mu))",
        prof=entries("mean", sp.slot),
        dyn=entries("struct(velocity, acceleration, rank_in_day)", sp.slot),
        **{f"{name}_mean": period(*span) for name, span in PERIODS.items()},
    )
    std = "case when n > 1 then sqrt(deviations / greatest(n - 1, 1)) else 0D end"
    return (
        stats.selectExpr("*", f"{std} as std")
        .selectExpr("*", f"std / (mean + {sp.eps!r}D) as cv", f"ln(mean + {sp.eps!r}D) as log_mean")
        .drop("deviations")
    )


def entity_stats(profile: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """Per key: n, total, mean, sample deviation, variation, log mean and period means."""
    return key_table(profile, sp).drop("prof", "dyn")


def entity_hour_stats(profile: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """(key, hour) -> sum, count, mean."""
    return grouped(profile, [sp.key, f"{hour_of_slot(sp.slot)} as {sp.hour}"],
                   hour_sum="sum(total)", hour_cnt="sum(n)", hour_mean=MEAN)


def prefix_mean(profile: DataFrame, length: int, sp: Spec = DEFAULT) -> DataFrame:
    return grouped(profile, [f"substring({sp.key}, 1, {length}) as prefix"], prefix_mean=MEAN)


def prefix_slot_mean(profile: DataFrame, length: int, sp: Spec = DEFAULT) -> DataFrame:
    return grouped(profile, [f"substring({sp.key}, 1, {length}) as prefix", sp.slot], prefix_slot_mean=MEAN)


def cluster_slot_mean(
    profile: DataFrame, clusters: DataFrame, sp: Spec = DEFAULT, cluster: str = "geohash_cluster"
) -> DataFrame:
    """(cluster, slot) means for a given key -> cluster table."""
    return grouped(profile.join(clusters.select(sp.key, cluster), sp.key), [cluster, sp.slot], cluster_slot_mean=MEAN)


def entity_quantiles(rows: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """Exact 10th and 90th percentile of the value per key."""
    probs = {"p10": 0.1, "p90": 0.9}
    return exact_quantiles(rows, [sp.key], sp.value, probs)


# --- windows over a key's profile -------------------------------------------------------

def average_rank(order: str, by: str) -> str:
    """Rank from 1 within ``by`` with ties averaged, as a share of the group size."""
    return (f"(rank() over (partition by {by} order by {order})"
            f" + (count(*) over (partition by {by}, {order}) - 1) / 2D)"
            f" / count(*) over (partition by {by})")


def dynamics(profile: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """Adds velocity and acceleration: differences to two rows before, 0 where there is none."""
    w = f"over (partition by {sp.key} order by {sp.slot})"
    return (
        profile.selectExpr("*", f"mean - lag(mean, 2) {w} as v")
        .selectExpr("*", f"v - lag(v, 2) {w} as a")
        .selectExpr("*", "coalesce(v, 0D) as velocity", "coalesce(a, 0D) as acceleration").drop("v", "a")
    )


def rank_in_day(profile: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """Adds the share rank of the slot mean within the key's day."""
    return profile.selectExpr("*", f"{average_rank('mean', sp.key)} as rank_in_day")


def hour_rank(hours: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    return hours.selectExpr("*", f"{average_rank('hour_mean', sp.key)} as hour_rank")


def group_size(rows: DataFrame, by: str) -> DataFrame:
    """Every row with its group's size, counted before the shuffle and joined back."""
    return rows.join(grouped(rows, [by], group_size="count(*)"), by, "left")

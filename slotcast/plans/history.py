"""Features carried over from the history day, attached through distinct (key, slot) cells.

Rows never meet the lookup tables directly. Per key one wide row is assembled (profile map,
neighbour means, prefix profiles, statistics), the key's own slots are exploded from it,
every feature is computed once per (key, slot), and the rows join those narrow cells in a
single equi-join that adaptive execution can split when a key holds very many rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.functions import scalar as X
from slotcast.operators import knn
from slotcast.operators import profile as P
from slotcast.operators.encoding import leave_one_out
from slotcast.session import materialize
from slotcast.spec import DEFAULT, Spec

WARM, TARGET_ONLY, COLD = "warm", "target_only", "cold"


# --- one pass over the rows -----------------------------------------------------------

def stack_rows(train: DataFrame, test: DataFrame) -> DataFrame:
    """Training and unlabelled rows in one frame; ``is_test`` tells them apart."""
    return train.withColumn("is_test", F.lit(False)).unionByName(
        test.withColumn("is_test", F.lit(True)), allowMissingColumns=True
    )


def observation_grid(rows: DataFrame, sp: Spec = DEFAULT, counted: Iterable[str] = ()) -> DataFrame:
    """(key, slot, day, is_test) -> n, total, mean, m2, log sum, last value.

    The only aggregate over the raw rows that the feature build needs besides exact
    quantiles; it holds one row per slot of the day however many rows a key has.
    ``counted`` columns get their number of non-null values as ``n_<column>``.
    """
    y = sp.value
    return P.grouped(
        rows, [sp.key, sp.slot, sp.day, "is_test"],
        n=f"count({y})", total=f"sum({y})", mean=f"avg({y})", m2=f"var_pop({y}) * count({y})",
        log_total=f"sum({X.log_value(y, sp)})", last=f"max_by({y}, {sp.row_id})",
        **{f"n_{c}": f"count({c})" for c in counted},
    )


def profile_of(grid: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """History-day profile: the grid is already one row per (key, slot) on that day."""
    own = grid.where(f"not is_test and {sp.day} = {sp.history_day} and n > 0")
    return own.select(sp.key, sp.slot, "n", "total", "mean", "m2")


# --- key classes --------------------------------------------------------------------

def key_classes(rows: DataFrame, sp: Spec = DEFAULT, **more: str) -> DataFrame:
    """One row per key: its class, the slots it occurs at and ``more`` aggregates.

    warm: seen on the history day; target_only: in training but not on that day;
    cold: only among the unlabelled rows.
    """
    return P.grouped(
        rows, [sp.key],
        key_class=f"""case when bool_or(not is_test and {sp.day} = {sp.history_day}) then '{WARM}'
                           when bool_or(not is_test) then '{TARGET_ONLY}' else '{COLD}' end""",
        slots=f"collect_set({sp.slot})",
        **more,
    )


def cold_keys(train: DataFrame, test: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    return test.select(sp.key).distinct().join(train.select(sp.key).distinct(), sp.key, "left_anti")


# --- per-key tables -----------------------------------------------------------------

def hour_maps(prof: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """key -> map from hour to (sum, count, mean, rank)."""
    hours = P.hour_rank(P.entity_hour_stats(prof, sp), sp)
    return P.grouped(hours, [sp.key], hours=P.entries("struct(hour_sum, hour_cnt, hour_mean, hour_rank)", sp.hour))


def prefix_maps(prof: DataFrame, length: int, sp: Spec = DEFAULT) -> DataFrame:
    """prefix -> (mean, map from slot to mean)."""
    by_slot = P.grouped(prof, [f"substring({sp.key}, 1, {length}) as _px", sp.slot], t="sum(total)", c="sum(n)")
    return P.grouped(by_slot, ["_px"], **{
        f"px{length}_mean": "sum(t) / sum(c)", f"px{length}_slot": P.entries("t / c", sp.slot)})


def neighbor_edges(keys: DataFrame, sp: Spec = DEFAULT, warm: bool = True) -> DataFrame:
    """Edges to history keys: ``k_warm`` for warm keys, ``k_cold`` for cold ones, none for others.

    With ``warm`` false only cold keys ask; warm ones are there to be found.
    """
    asking = keys.where(f"key_class <> '{TARGET_ONLY}'")
    flagged = asking.selectExpr(
        sp.key, "true as asks" if warm else f"key_class = '{COLD}' as asks", f"key_class = '{WARM}' as is_data")
    edges = knn.key_neighbors(flagged, max(sp.k_warm, sp.k_cold) if warm else sp.k_cold, sp)
    wanted = f"rank <= case when key_class = '{WARM}' then {sp.k_warm} else {sp.k_cold} end"
    return edges.join(asking.select(sp.key, "key_class"), sp.key).where(wanted).drop("key_class")


def neighbor_slot_means(edges: DataFrame, prof: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """(key, slot) -> mean over those neighbours that have a value at the slot."""
    right = prof.selectExpr(f"{sp.key} as neighbor", sp.slot, "mean")
    return P.grouped(edges.select(sp.key, "neighbor").join(right, "neighbor"), [sp.key, sp.slot], nb_mean="avg(mean)")


def neighbor_maps(edges: DataFrame, prof: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """key -> map from slot to the neighbours' mean."""
    return P.grouped(neighbor_slot_means(edges, prof, sp), [sp.key], nb=P.entries("nb_mean", sp.slot))


# --- lookup expressions over a wide cell row ------------------------------------------

def mean_of_present(a: str, b: str) -> str:
    """Mean of the non-null ones of two values, NULL where there is none."""
    return f"coalesce(({a} + {b}) / 2D, {a}, {b})"


# Looked up once per cell and used by several features: name -> (SQL text, table needed).
def cell_lookups(sp: Spec = DEFAULT) -> dict[str, tuple[str, str]]:
    s = sp.slot
    return {
        "_own_slot_mean": (f"element_at(g.slot_mean, {s})", ""),
        "_nb": (f"element_at(nb, {s})", "neighbors"),
        "_dyn": (f"element_at(dyn, {s})", "dynamics"),
        "_hour": (f"element_at(hours, {X.hour_of_slot(s)})", "hours"),
    }


_HERE = "coalesce(_own_slot_mean, g.mean)"


def _slot_mean(slot: str) -> str:
    return f"coalesce(element_at(g.slot_mean, {slot}), g.mean)"


def _genuine(slot: str) -> str:
    """Profile (a cold key's neighbours instead), else the slot's overall mean."""
    return f"coalesce(element_at(look, {slot}), {_slot_mean(slot)})"


def _proxy(sp: Spec) -> str:
    s, step = sp.slot, sp.slot_minutes
    around = mean_of_present(f"element_at(prof, {s} - {step})", f"element_at(prof, {s} + {step})")
    return f"coalesce({around}, mean, {_HERE})"


def _nearby(sp: Spec) -> str:
    def side(slot: str) -> str:
        return f"case when {slot} < 0 then g.mean else {_genuine(slot)} end"

    return f"({side(f'{sp.slot} - {sp.slot_minutes}')} + {side(f'{sp.slot} + {sp.slot_minutes}')}) / 2D"


def _lag(minutes: int, sp: Spec) -> str:
    slot = f"({sp.slot} + {minutes})"
    return f"case when {slot} < 0 then coalesce(mean, g.mean) else {_genuine(slot)} end"


def cell_features(sp: Spec = DEFAULT) -> dict[str, tuple[str, set[str]]]:
    """Feature name -> (SQL text over a wide cell row, per-key tables it reads).

    These depend on (key, slot) only.
    """
    s, eps = sp.slot, f"{sp.eps!r}D"
    own_mean = f"coalesce(mean, {_HERE})"
    shape = f"coalesce(_own_slot_mean / (g.mean + {eps}), 1D)"
    neighbors = f"coalesce(_nb, {_HERE})"
    stats, look = {"stats"}, {"profile", "neighbors"}
    return {
        "same_slot_genuine": (f"coalesce(element_at(look, {s}), {_HERE})", look),
        "same_slot_proxy": (_proxy(sp), {"profile", "stats"}),
        "profile_or_slot": (f"coalesce(element_at(prof, {s}), {_HERE})", {"profile"}),
        "cold_fill": (neighbors, {"neighbors", "spatial"}),
        "demand_d48_nearby_slots": (_nearby(sp), look),
        "demand_d48_slot_m60": (_lag(-60, sp), look | stats),
        "demand_d48_slot_m30": (_lag(-30, sp), look | stats),
        "demand_d48_slot_p30": (_lag(30, sp), look | stats),
        "demand_d48_slot_p60": (_lag(60, sp), look | stats),
        "demand_d48_spatial_neighbor_slot": (neighbors, {"neighbors", "spatial"}),
        "demand_d48_geohash_mean": (own_mean, stats),
        "hour_fallback": ("coalesce(mean, g.mean)", stats),
        "demand_d48_geohash_std": ("coalesce(std, 0D)", stats),
        "demand_d48_geohash_cv": ("coalesce(cv, 0D)", stats),
        "demand_d48_log_geohash_mean": (f"coalesce(log_mean, ln(g.mean + {eps}))", stats),
        "demand_d48_day_total": ("coalesce(total, g.mean * g.n_slots)", stats),
        "demand_d48_night_mean": ("coalesce(night_mean, g.mean)", stats),
        "demand_d48_peak_am_mean": ("coalesce(peak_am_mean, g.mean)", stats),
        "demand_d48_midday_mean": ("coalesce(midday_mean, g.mean)", stats),
        "demand_d48_peak_pm_mean": ("coalesce(peak_pm_mean, g.mean)", stats),
        "demand_d48_geohash_p10": ("coalesce(p10, g.mean * 0.1D)", {"quantiles"}),
        "demand_d48_geohash_p90": ("coalesce(p90, g.mean * 2D)", {"quantiles"}),
        "slot_shape": (shape, set()),
        "demand_d48_expected": (f"{shape} * {own_mean}", stats),
        "hour_sum": ("_hour.hour_sum", {"hours"}),
        "hour_cnt": ("coalesce(_hour.hour_cnt, 1)", {"hours"}),
        "hour_mean": ("_hour.hour_mean", {"hours"}),
        "demand_d48_gh_hour_rank": ("coalesce(_hour.hour_rank, 0.5D)", {"hours"}),
        "demand_d48_velocity": ("coalesce(_dyn.velocity, 0D)", {"dynamics"}),
        "demand_d48_acceleration": ("coalesce(_dyn.acceleration, 0D)", {"dynamics"}),
        "demand_d48_rank_in_day": ("coalesce(_dyn.rank_in_day, 0.5D)", {"dynamics"}),
        "demand_d48_prefix5_mean": ("coalesce(px5_mean, g.mean)", {"prefix5"}),
        "demand_d48_prefix4_mean": ("coalesce(px4_mean, g.mean)", {"prefix4"}),
        "demand_d48_prefix5_slot_mean": (f"coalesce(element_at(px5_slot, {s}), {_HERE})", {"prefix5"}),
        "demand_d48_prefix4_slot_mean": (f"coalesce(element_at(px4_slot, {s}), {_HERE})", {"prefix4"}),
    }


# --- cells ----------------------------------------------------------------------------

def entities(
    history: DataFrame, prof: DataFrame, keys: DataFrame, needs: set[str], sp: Spec = DEFAULT
) -> DataFrame:
    """One wide row per key with the tables named in ``needs``."""
    out = keys
    if needs & {"profile", "stats", "dynamics"}:
        out = out.join(P.key_table(prof, sp).drop("n"), sp.key, "left")
    if "quantiles" in needs:
        out = out.join(P.entity_quantiles(history, sp), sp.key, "left")
    if "hours" in needs:
        out = out.join(hour_maps(prof, sp), sp.key, "left")
    for length in (5, 4):
        if f"prefix{length}" in needs:
            px = prefix_maps(prof, length, sp)
            out = out.selectExpr("*", f"substring({sp.key}, 1, {length}) as _px").join(px, "_px", "left").drop("_px")
    if "neighbors" in needs:
        # stored: the descent is a long plan that nothing later should carry along
        nb = materialize(neighbor_maps(neighbor_edges(keys, sp, warm="spatial" in needs), prof, sp))
        out = out.join(nb, sp.key, "left")
        if "profile" in needs:
            out = out.selectExpr("*", f"case when key_class = '{COLD}' then nb else prof end as look")
    return out


def cells(
    wide: DataFrame, prof: DataFrame, features: Iterable[str], sp: Spec = DEFAULT, keep: Iterable[str] = ()
) -> DataFrame:
    """(key, slot) -> the named cell features and ``keep`` expressions, one row per distinct pair."""
    features = list(features)
    known, needs = cell_features(sp), needs_of(features, sp) | {""}
    shared = [f"{e} as {name}" for name, (e, table) in cell_lookups(sp).items() if table in needs]
    return (
        wide.selectExpr("*", f"explode(slots) as {sp.slot}")
        # below the explode the whole slot map of g would be written into every cell before a join looks at it
        .withColumn("g", P.global_row(prof, sp).scalar()).selectExpr("*", *shared)
        .selectExpr(sp.key, sp.slot, *keep, *[f"{known[name][0]} as {name}" for name in features])
    )


def needs_of(features: Iterable[str], sp: Spec = DEFAULT) -> set[str]:
    known = cell_features(sp)
    return set().union(*[known[name][1] for name in features])


def attach_cell_features(
    train: DataFrame, test: DataFrame, features: list[str], sp: Spec = DEFAULT
) -> DataFrame:
    """Training and unlabelled rows, each with the named cell features and its key class."""
    rows = stack_rows(train, test)
    grid = materialize(observation_grid(rows, sp))
    history, prof = P.on_day(train, sp.history_day, sp), profile_of(grid, sp)
    needs = needs_of(features, sp)
    wide = entities(history, prof, key_classes(grid, sp), needs, sp)
    if len(needs) > 3:
        wide = materialize(wide, sp.key)
    return join_cells(rows, cells(wide, prof, features, sp, keep=["key_class"]), sp)


def join_cells(rows: DataFrame, cell: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """Rows with their cell. A merge join: the planner cannot see how much the explode adds to
    the size of the cells, and splits of a skewed key work on this kind of join.
    """
    return rows.join(cell.hint("merge"), [sp.key, sp.slot], "left")


# --- row-level features -----------------------------------------------------------------

ROW_INPUTS = ["same_slot_genuine", "same_slot_proxy", "hour_fallback", "hour_sum", "hour_cnt", "hour_mean"]
HISTORY_COLUMNS = [name for name in cell_features() if name.startswith("demand_") or name == "slot_shape"]


def row_features(rows: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """Columns that also need the row's day or own value.

    History-day training rows see the slots around their own and an hour mean without
    themselves; all other rows see the genuine values.
    """
    own_day = f"not is_test and {sp.day} = {sp.history_day}"
    loo = leave_one_out("hour_sum", "hour_cnt", sp.value, "hour_fallback")
    same, mean = "demand_d48_same_slot", "demand_d48_geohash_mean"
    return (
        rows.selectExpr(
            "*",
            f"case when {own_day} then same_slot_proxy else same_slot_genuine end as {same}",
            f"case when {own_day} then {loo} else coalesce(hour_mean, hour_fallback) end as demand_d48_gh_hour_mean",
        )
        .drop(*ROW_INPUTS)
        .selectExpr(
            "*",
            f"{X.floored_log(same, sp)} as log_demand_d48_same_slot",
            f"{same} / ({mean} + {sp.eps!r}D) as demand_d48_relative_slot",
            f"({same} - {mean}) / (demand_d48_geohash_std + 1e-3D) as demand_d48_zscore",
        )
    )


def cluster_features(
    rows: DataFrame, prof: DataFrame, clusters: DataFrame | None, sp: Spec = DEFAULT, cluster: str = "geohash_cluster"
) -> DataFrame:
    """Mean of the row's cluster at its slot and the row's distance from it.

    Without a cluster table the mean is the slot's overall one and the distance 0.
    """
    out = rows.withColumn("g", P.global_row(prof, sp).scalar())
    overall = _slot_mean(sp.slot)
    if clusters is None:
        return out.selectExpr(
            "*", f"{overall} as demand_d48_cluster_slot_mean", "0D as demand_d48_diff_from_cluster").drop("g")
    means = P.cluster_slot_mean(prof, clusters, sp, cluster)
    return (
        out.join(clusters.select(sp.key, cluster), sp.key, "left").join(means, [cluster, sp.slot], "left")
        .selectExpr("*", f"coalesce(cluster_slot_mean, {overall}) as demand_d48_cluster_slot_mean")
        .selectExpr("*", f"demand_d48_same_slot / (demand_d48_cluster_slot_mean + {sp.eps!r}D) - 1D"
                         " as demand_d48_diff_from_cluster")
        .drop("cluster_slot_mean", "g")
    )


def history_features(train: DataFrame, test: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """All history-day columns for training and unlabelled rows in one frame."""
    rows = attach_cell_features(train, test, HISTORY_COLUMNS + ROW_INPUTS, sp)
    return row_features(rows, sp)

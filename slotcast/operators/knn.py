"""Exact k nearest neighbours on an integer lattice.

Both sides are cut into the same nested square blocks. Going from coarse to fine, every
block of queries keeps only the data blocks that can still hold a neighbour of one of its
points: the block counts give a radius that surely contains k points, and a block farther
away than that is dropped. Only the finest blocks, a few cells wide, are opened into
points. Distances are squared integers, so equal distances are equal and ties go to the
smaller id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.functions.geo import lat_bits, lattice_points, lon_bits
from slotcast.operators.profile import grouped
from slotcast.session import materialize
from slotcast.spec import DEFAULT, Spec

LEAF_SHIFT = 3
STEP = 4
# The descent starts at the coarsest level with at most 2**ROOT_BITS blocks per axis.
ROOT_BITS = 5


def degrees_per_unit(sp: Spec = DEFAULT) -> float:
    """Latitude degrees of one lattice unit."""
    return 180.0 / 2 ** (lat_bits(sp.key_length) + 1)


def lon_weight(sp: Spec = DEFAULT) -> int:
    """Width of a lattice unit in units of its height: 2 for even key lengths, 1 for odd."""
    return 2 if lon_bits(sp.key_length) == lat_bits(sp.key_length) else 1


def levels(bits: int, leaf_shift: int, step: int) -> list[int]:
    """Block sizes of the descent, coarsest first."""
    shifts = [leaf_shift]
    while bits - shifts[0] > ROOT_BITS:
        shifts.insert(0, shifts[0] + step)
    return shifts


def nearest(
    points: DataFrame, k: int, bits: int, x_weight: int = 1, leaf_shift: int = LEAF_SHIFT, step: int = STEP
) -> DataFrame:
    """(id, neighbor, rank, dist2): for every point that asks, the k nearest other data points.

    ``points`` has columns id, x, y with 0 <= x, y < 2**bits, one row per id, and the flags
    ``asks`` and ``is_data``. It is read several times and should be a stored table.
    """
    shifts = levels(bits, leaf_shift, step)
    blocks = materialize(_blocks(points, shifts, step))
    frontier = None
    for shift in shifts:
        # an asking point may be data itself, so k others need k + 1 points
        frontier = _descend(frontier, blocks.where(f"shift = {shift}"), shift, k + 1, x_weight)
    pairs = (
        _in_block(points.where("asks"), leaf_shift, "q").join(frontier.select("qx", "qy", "dx", "dy"), ["qx", "qy"])
        .join(_in_block(points.where("is_data"), leaf_shift, "d"), ["dx", "dy"])
        .where("q_id <> d_id")
    )
    dist2 = f"{x_weight * x_weight} * (q_x - d_x) * (q_x - d_x) + (q_y - d_y) * (q_y - d_y)"
    return (
        pairs.selectExpr("q_id as id", "d_id as neighbor", f"{dist2} as dist2")
        .selectExpr("*", "row_number() over (partition by id order by dist2, neighbor) as rank")
        .where(f"rank <= {k}")
    )


def _in_block(points: DataFrame, shift: int, side: str) -> DataFrame:
    return points.selectExpr(
        f"shiftright(x, {shift}) as {side}x", f"shiftright(y, {shift}) as {side}y",
        f"id as {side}_id", f"x as {side}_x", f"y as {side}_y",
    )


def _blocks(points: DataFrame, shifts: list[int], step: int) -> DataFrame:
    """Occupied blocks of every level with their parent and how many points ask and are data.

    Points are first summed into the finest blocks, which then count for all levels at once.
    """
    finest = shifts[-1]
    leaves = grouped(points, [f"shiftright(x, {finest}) as lx", f"shiftright(y, {finest}) as ly"],
                     asking="count_if(asks)", n="count_if(is_data)")
    every = leaves.selectExpr("*", f"explode(array({', '.join(map(str, shifts))})) as shift")
    merged = grouped(every, ["shift", f"shiftright(lx, shift - {finest}) as bx", f"shiftright(ly, shift - {finest}) as by"],
                     asking="sum(asking)", n="sum(n)")
    return merged.selectExpr("*", f"shiftright(bx, {step}) as px", f"shiftright(by, {step}) as py")


def _descend(
    frontier: DataFrame | None, blocks: DataFrame, shift: int, need: int, x_weight: int
) -> DataFrame:
    """Block pairs of this level: children of the kept pairs, minus those too far apart."""
    q = blocks.where("asking > 0").selectExpr("bx as qx", "by as qy", "px as qpx", "py as qpy")
    d = blocks.where("n > 0").selectExpr("bx as dx", "by as dy", "px as dpx", "py as dpy", "n as dn")
    if frontier is None:
        # coarsest level: all blocks have the one root as parent, at most 4**ROOT_BITS blocks on either side
        q = q.selectExpr("qx", "qy", f"shiftright(qx, {ROOT_BITS}) as root")
        d = d.selectExpr("dx", "dy", "dn", f"shiftright(dx, {ROOT_BITS}) as root")
        pairs = q.join(d.hint("broadcast"), "root").selectExpr("*", "cast(null as bigint) as reach")
    else:
        parents = frontier.selectExpr("qx as qpx", "qy as qpy", "dx as dpx", "dy as dpy", "reach")
        pairs = parents.join(q, ["qpx", "qpy"]).join(d, ["dpx", "dpy"])
    size, w2 = 1 << shift, x_weight * x_weight
    near = "case when {0} = 0 then 0 else ({0} - 1) * {1} + 1 end"
    far = "(({0} + 1) * {1} - 1)"
    nx, ny, fx, fy = (f.format(axis, size) for f in (near, far) for axis in ("ax", "ay"))
    return (
        pairs.selectExpr("qx", "qy", "dx", "dy", "dn", "reach", "abs(qx - dx) as ax", "abs(qy - dy) as ay")
        .selectExpr("qx", "qy", "dx", "dy", "dn", "reach", f"{nx} as nx", f"{ny} as ny", f"{fx} as fx", f"{fy} as fy")
        .selectExpr("qx", "qy", "dx", "dy", "dn", "reach",
                    f"{w2} * nx * nx + ny * ny as near", f"{w2} * fx * fx + fy * fy as far")
        .where("reach is null or near <= reach")
        .selectExpr("*", "sum(dn) over (partition by qx, qy order by far) as covered")
        .selectExpr("qx", "qy", "dx", "dy", "near",
                    f"min(case when covered >= {need} then far end) over (partition by qx, qy) as reach")
        .where("reach is null or near <= reach")
        .select("qx", "qy", "dx", "dy", "reach")
    )


def key_neighbors(keys: DataFrame, k: int, sp: Spec = DEFAULT) -> DataFrame:
    """The k nearest other keys that are data, for every key that asks.

    ``keys`` has the key column and the flags ``asks`` and ``is_data``, in any number of
    rows per key. Returns (key, neighbor, rank, dist, dist2).
    """
    flags = keys.groupBy(sp.key).agg(F.bool_or("asks").alias("asks"), F.bool_or("is_data").alias("is_data"))
    # read once per level of the descent, so it is stored
    points = materialize(lattice_points(flags, sp))
    pairs = nearest(points, k, lon_bits(sp.key_length) + 1, lon_weight(sp))
    return pairs.selectExpr(
        f"id as {sp.key}", "neighbor", "rank",
        f"sqrt(cast(dist2 as double)) * {degrees_per_unit(sp)!r}D as dist", "dist2",
    )


def warm_neighbors(history_keys: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """Every history key with its nearest other history keys."""
    return key_neighbors(history_keys.selectExpr(sp.key, "true as asks", "true as is_data"), sp.k_warm, sp)


def cold_neighbors(cold_keys: DataFrame, history_keys: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """Every key unseen in training with its nearest history keys."""
    asking = cold_keys.selectExpr(sp.key, "true as asks", "false as is_data")
    data = history_keys.selectExpr(sp.key, "false as asks", "true as is_data")
    return key_neighbors(asking.unionByName(data), sp.k_cold, sp)

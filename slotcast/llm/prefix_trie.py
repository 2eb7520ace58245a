"""Prefix trie of conversations, with subtree totals by centroid decomposition.

A node is a distinct sequence of first turns (role, text); the textless root has depth 0.
Nodes come from one aggregate: a sequence is told by the exclusive or of 128-bit hashes of its
(position, role, text), so a node's parent is known from the node alone.

Totals over subtrees do not climb the tree level by level, which would take as many rounds
as the longest conversation has turns. Removing a centroid from a component of the
parent-edge forest leaves components of at most half its weight. The centroid's own total
over the part of its component below it is added to every node on the path from the
centroid to the component's top; every pair of a node and one below it is parted by exactly
one centroid, so every node gets each of its descendants once, in a number of rounds that
grows with the logarithm of the rows. The weight of a node is the number of conversations
that pass through it; its total over a subtree is the number of rows at or below a node,
which the aggregate that makes the nodes gives for free. Components above PIECE rows are
split by Spark joins, all of them in one round; smaller ones are dealt to tasks whole, and
each task decomposes all it has at once.

Defined results. Rows without conversation id take no part. Turns go by turn (null first),
then role, then a hash of the text; null role and text are empty; repeated rows are turns of
their own. Long conversations are numbered in pieces, so none has to fit a task. An empty
table has no nodes, not even a root. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from slotcast.session import materialize

PIECE = 1 << 14  # weight of a component that is decomposed within a task
BLOCK = 4096  # turns of a conversation whose hashes are summed together
WORD = r"[^\\x20\\x09-\\x0D]+"


def number_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, n, t1, t2, words``: the turns of every conversation counted from 1, with hashes and word counts.

    Rows are range-partitioned in order and stored; a conversation that reaches over several
    partitions gets the number of its turns in earlier ones added. At most two conversations
    per partition do, and only those are broadcast.
    """
    r, t = f"coalesce(CAST(`{role}` AS STRING), '')", f"coalesce(CAST(`{text}` AS STRING), '')"
    narrow = rows.where(f"`{conv}` IS NOT NULL").selectExpr(
        f"CAST(`{conv}` AS BIGINT) AS conv", f"CAST(`{turn}` AS BIGINT) AS turn", f"{r} AS role",
        f"xxhash64(1, {r}, {t}) AS t1", f"xxhash64(2, {t}, {r}) AS t2", f"CAST(regexp_count({t}, '{WORD}') AS BIGINT) AS words")
    narrow = narrow.withColumn("same", F.monotonically_increasing_id())  # equal rows may be dealt to several partitions
    order = ["turn", "role", "t1", "t2", "same"]  # null turns come first
    ranged = materialize(narrow.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id()))
    counts = ranged.groupBy("conv", "part").agg(F.count("*").alias("k"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    later = counts.withColumn("before", F.sum("k").over(before)).where("before IS NOT NULL").drop("k")
    here = Window.partitionBy("conv", "part").orderBy(*order)
    numbered = ranged.withColumn("i", F.row_number().over(here)).join(F.broadcast(later), ["conv", "part"], "left")
    return materialize(numbered.selectExpr("conv", "i + coalesce(before, 0) AS n", "t1", "t2", "words"))


def regraft(turns: DataFrame, base: str, keep: str) -> DataFrame:
    """``conv, pos, t1, t2, words, len``: every conversation with its first turns taken from another one.

    ``base`` and ``keep`` are SQL over ``conv``: the first ``keep`` turns of conversation
    ``base`` (all if it has fewer, none if it is absent), then the own turns after the first
    ``keep``. ``keep`` must be small; a conversation left without turns has one row of
    position 0.
    """
    lengths = turns.groupBy("conv").agg(F.max("n").alias("own"))
    convs = lengths.selectExpr("conv", "own", f"CAST({base} AS BIGINT) AS base", f"CAST({keep} AS BIGINT) AS h")
    known = lengths.selectExpr("conv AS base", "own AS base_len")
    convs = convs.join(known, "base", "left").selectExpr(
        "conv", "base", "h", "least(h, coalesce(base_len, 0)) AS g", "own").withColumn("len", F.expr("g + greatest(own - h, 0)"))
    convs = materialize(convs)
    most = convs.agg(F.max("h")).first()[0] or 0
    heads = turns.where(F.col("n") <= most).withColumnRenamed("conv", "base")
    heads = convs.where("g > 0").join(heads, "base").where("n <= g").selectExpr("conv", "n AS pos", "t1", "t2", "words", "len")
    own = turns.join(convs.select("conv", "h", "g", "len"), "conv").where("n > h").selectExpr(
        "conv", "n - h + g AS pos", "t1", "t2", "words", "len")
    bare = convs.where("len = 0").selectExpr("conv", "0L AS pos", "0L AS t1", "0L AS t2", "0L AS words", "0L AS len")
    return heads.unionByName(own).unionByName(bare)


def whole(turns: DataFrame) -> DataFrame:
    """The conversations as they are, in the form that ``paths`` takes."""
    lengths = turns.groupBy("conv").agg(F.max("n").alias("len"))
    return turns.join(lengths, "conv").selectExpr("conv", "n AS pos", "t1", "t2", "words", "len")


def paths(turns: DataFrame) -> DataFrame:
    """``conv, depth, p1, p2, q1, q2, words, len``: every conversation's nodes below the root, with their parents' hashes.

    Hashes are combined within blocks of positions, then over the blocks before. The row of
    depth 0 of a turnless conversation stays; its hashes are the root's.
    """
    x = [f"IF(pos = 0, 0L, xxhash64({i}, pos, t1, t2)) AS x{i}" for i in (1, 2)]
    rows = turns.selectExpr("conv", "pos", "words", "len", *x, f"(pos - 1) DIV {BLOCK} AS block")
    upto = Window.partitionBy("conv", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    running = rows.withColumns({f"y{i}": F.bit_xor(f"x{i}").over(upto) for i in (1, 2)})
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    long = rows.where(f"len > {BLOCK}").groupBy("conv", "block").agg(*[F.bit_xor(f"x{i}").alias(f"x{i}") for i in (1, 2)])
    long = long.select("conv", "block", *[F.bit_xor(f"x{i}").over(before).alias(f"b{i}") for i in (1, 2)]).where("b1 IS NOT NULL")
    joined = running.join(long, ["conv", "block"], "left").selectExpr(
        "*", *[f"y{i} ^ coalesce(b{i}, 0L) AS p{i}" for i in (1, 2)])
    return joined.selectExpr("conv", "pos AS depth", "p1", "p2", "p1 ^ x1 AS q1", "p2 ^ x2 AS q2", "words", "len")


def nodes(path: DataFrame) -> DataFrame:
    """One row per node: hashes, parent's hashes, depth, members, smallest member, words, children and rows below.

    ``weight`` is the number of path rows at or below the node, the node's own included.
    """
    below = path.where("depth > 0").groupBy("p1", "p2").agg(
        F.max("depth").alias("depth"), F.max("q1").alias("q1"), F.max("q2").alias("q2"), F.min("conv").alias("m"),
        F.count("*").alias("n_convs"), F.max("words").alias("words"), F.sum(F.expr("len - depth + 1")).alias("weight"))
    ends = path.where("depth = least(1, len)")
    root = ends.agg(F.min("conv").alias("m"), F.count("*").alias("n_convs"), F.sum(F.expr("len + 1")).alias("weight")).where(
        "n_convs > 0").selectExpr("0L AS p1", "0L AS p2", "0L AS depth", "CAST(NULL AS BIGINT) AS q1", "CAST(NULL AS BIGINT) AS q2",
                                  "m", "n_convs", "0L AS words", "weight")
    found = materialize(below.unionByName(root))
    children = found.where("depth > 0").groupBy("q1", "q2").agg(F.count("*").alias("n_children")).selectExpr(
        "q1 AS p1", "q2 AS p2", "n_children")
    return found.join(children, ["p1", "p2"], "left").fillna(0, ["n_children"])


def rollup(tree: DataFrame, path: DataFrame, values: list[str], piece: int = PIECE) -> DataFrame:
    """``tree`` rows (p1, p2, q1, q2, m, depth, weight and more) with ``values`` summed over every node's subtree."""
    sums = [f"CAST(0 AS BIGINT) AS sum_{v}" for v in values]
    active = materialize(tree.selectExpr("p1", "p2", "q1", "q2", "m", "depth", "weight", *values, *sums, "0L AS c1", "0L AS c2"))
    steps, finished = path.where("depth > 0").select("conv", "depth", "p1", "p2", "q1", "q2"), []
    while True:
        totals = active.groupBy("c1", "c2").agg(F.max("weight").alias("total"), F.min("depth").alias("top"))
        heavy = materialize(totals.where(F.col("total") > piece))
        light = active.join(heavy.select("c1", "c2"), ["c1", "c2"], "left_anti")
        finished.append(_within_tasks(light, values))
        if heavy.isEmpty():
            break
        done, active = _split(active.join(heavy, ["c1", "c2"]), steps, values)
        finished.append(done.select("p1", "p2", *[f"sum_{v}" for v in values]))
    found = finished[0]
    for part in finished[1:]:
        found = found.unionByName(part)
    return tree.join(found, ["p1", "p2"])


def _split(active: DataFrame, steps: DataFrame, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """One round: the centroid of every component is taken out. Returns the centroids, finished, and the other nodes."""
    # Nodes with at least half the weight below them form a path; the lowest is the centroid.
    centre = active.where("2 * weight >= total").groupBy("c1", "c2").agg(
        F.max_by(F.struct("p1", "p2", "m", "depth", "weight"), "depth").alias("z"), F.max("top").alias("top"))
    centre = materialize(centre.selectExpr("c1", "c2", "z.p1 AS z1", "z.p2 AS z2", "z.m AS zm", "z.depth AS zd", "z.weight AS zw", "top"))
    # A node below the centroid belongs to that child of it which any of its members passes.
    placed = active.drop("top", "total").join(centre.drop("zm", "zw", "top"), ["c1", "c2"])
    child = steps.selectExpr("conv AS m", "depth - 1 AS zd", "p1 AS a1", "p2 AS a2", "q1 AS b1", "q2 AS b2")
    lower = placed.where("depth > zd").join(child, ["m", "zd"]).withColumn("below", F.expr("b1 = z1 AND b2 = z2")).drop("b1", "b2")
    upper = placed.where("depth <= zd").selectExpr("*", "0L AS a1", "0L AS a2", "false AS below")
    placed = materialize(lower.unionByName(upper).withColumn("is_z", F.expr("p1 = z1 AND p2 = z2")))
    parts = placed.where("below OR is_z").groupBy("c1", "c2").agg(*[F.sum(v).alias(f"add_{v}") for v in values])
    # From the centroid up to the top of its component.
    on_path = steps.unionByName(centre.selectExpr("zm AS conv", "0L AS depth", "0L AS p1", "0L AS p2", "0L AS q1", "0L AS q2").where(
        "top = 0").distinct())
    on_path = centre.join(parts, ["c1", "c2"]).join(on_path, F.col("zm") == F.col("conv")).where("depth BETWEEN top AND zd")
    on_path = on_path.selectExpr("p1", "p2", "zw", *[f"add_{v}" for v in values])
    kept = [c for c in placed.columns if c not in ("z1", "z2", "zd", "a1", "a2", "below", "is_z", "c1", "c2", "weight")]
    added = [f"sum_{v} + coalesce(add_{v}, 0L) AS sum_{v}" for v in values]
    kept = [c for c in kept if not c.startswith("sum_")]
    after = materialize(placed.join(on_path, ["p1", "p2"], "left").selectExpr(
        *kept, *added, "weight - IF(is_z, 0L, coalesce(zw, 0L)) AS weight", "IF(below, a1, c1) AS c1", "IF(below, a2, c2) AS c2", "is_z"))
    return after.where("is_z").drop("is_z"), after.where("NOT is_z").drop("is_z")


def _within_tasks(light: DataFrame, values: list[str]) -> DataFrame:
    """Decomposes components of bounded weight, each whole in a task, many at a time."""
    n = len(values)
    columns = ["c1", "c2", "p1", "p2", "q1", "q2", "depth", "weight", *values, *[f"sum_{v}" for v in values]]

    def work(batches):
        held = None
        for batch in batches:
            if held is not None and held.num_rows:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            held = batch
            c = np.stack([held.column(0).to_numpy(), held.column(1).to_numpy()], 1)
            changes = np.flatnonzero((c[1:] != c[:-1]).any(1)) + 1
            if len(changes):  # the last component may go on in the next batch
                yield summed(held.slice(0, changes[-1]))
                held = held.slice(changes[-1])
        if held is not None and held.num_rows:
            yield summed(held)

    def summed(batch):
        get = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(columns))]
        component = np.cumsum(np.r_[0, (get[0][1:] != get[0][:-1]) | (get[1][1:] != get[1][:-1])])
        parent = parents(component, *get[2:4], *[batch.column(i).fill_null(0).to_numpy() for i in (4, 5)], get[6])
        totals = decompose(component, parent, get[6], get[7], np.stack(get[8:8 + n], 1))
        out = [pa.array(get[8 + n + i] + totals[:, i]) for i in range(n)]
        return pa.RecordBatch.from_arrays([batch.column(2), batch.column(3), *out], ["p1", "p2", *columns[8 + n:]])

    dealt = light.select(*columns).repartition("c1", "c2").sortWithinPartitions("c1", "c2")
    return materialize(dealt.mapInArrow(work, "p1 bigint, p2 bigint, " + ", ".join(f"sum_{v} bigint" for v in values)))


def parents(component, p1, p2, q1, q2, depth):
    """Row of every node's parent, -1 at the top of a component."""
    least = np.full(component.max(initial=-1) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, component, depth)
    first = dict(zip(zip(p1.tolist(), p2.tolist()), range(len(p1))))
    top = depth == least[component]
    return np.array([-1 if t else first[q] for t, q in zip(top, zip(q1.tolist(), q2.tolist()))], np.int64)


def decompose(component, parent, depth, weight, values):
    """Sums of ``values`` over subtrees within components, by centroid decomposition of all components at once.

    Every node owns a stretch of numbers as long as its weight, within its parent's, so one
    comparison tells whether a node is above another.
    """
    size = len(parent)
    totals = np.zeros_like(values)
    if not size:
        return totals
    weight = weight.astype(np.int64)
    begin, end = _stretches(parent, weight)
    weight, component, alive = weight.copy(), component.astype(np.int64), np.arange(size)
    while len(alive):
        c = component[alive]
        by = np.lexsort((depth[alive], c))
        alive, c = alive[by], c[by]
        starts = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
        which = np.cumsum(np.r_[0, c[1:] != c[:-1]])
        # the lowest node with at least half the weight of its component
        half = 2 * weight[alive] >= np.maximum.reduceat(weight[alive], starts)[which]
        last = np.maximum.reduceat(np.where(half, np.arange(len(alive)), -1), starts)
        centre = alive[last][which]
        below = (begin[alive] >= begin[centre]) & (begin[alive] < end[centre])
        above = (begin[alive] <= begin[centre]) & (end[alive] > begin[centre])
        part = np.stack([np.add.reduceat(np.where(below, values[alive, k], 0), starts) for k in range(values.shape[1])], 1)
        totals[alive[above]] += part[which[above]]
        cut = weight[centre]
        weight[alive[above & (alive != centre)]] -= cut[above & (alive != centre)]
        # each child of a centroid is the top of a new component that holds what its stretch holds
        lower = np.flatnonzero(below & (alive != centre))
        heads = lower[parent[alive[lower]] == centre[lower]]
        heads = heads[np.lexsort((begin[alive[heads]], which[heads]))]
        if len(lower):
            ranks = np.argsort(np.argsort(begin[alive], kind="stable"), kind="stable")
            key = which * (len(alive) + 1) + ranks
            component[alive[lower]] = size + alive[heads[np.searchsorted(key[heads], key[lower], side="right") - 1]]
        alive = alive[alive != centre]
        component[alive] = np.unique(component[alive], return_inverse=True)[1]
    return totals


def _stretches(parent, weight):
    """Begin and end of every node's stretch; tops get stretches of their own."""
    order = np.lexsort((np.arange(len(parent)), parent))
    p, w = parent[order], weight[order]
    total = np.cumsum(w) - w
    first = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
    offset = np.empty(len(parent), np.int64)
    offset[order] = total - total[first][np.cumsum(np.r_[0, p[1:] != p[:-1]])] + 1
    begin, up = offset.copy(), parent.copy()
    while (up >= 0).any():  # each round adds twice as many ancestors' offsets
        has = up >= 0
        begin, up = np.where(has, begin + begin[up], begin), np.where(has, up[up], -1)
    return begin, begin + weight


def end_hashes(path: DataFrame) -> DataFrame:
    """``p1, p2, ends_sha256`` of the nodes where conversations end: SHA-256 of their ids, ascending, comma-joined.

    Ids are joined in runs that share all but the last eight bits, then a task streams a
    node's runs through the hash, so no node has to fit a row.
    """
    last = path.where("depth = len").select("p1", "p2", "conv")
    runs = last.groupBy("p1", "p2", F.shiftright("conv", 8).alias("run")).agg(
        F.expr("array_join(transform(sort_array(collect_list(conv)), x -> CAST(x AS STRING)), ',')").alias("ids"))
    dealt = runs.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "run")

    def work(batches):
        now, state = None, None
        for batch in batches:
            out = []
            for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("p1", "p2", "ids"))):
                if (a, b) == now:
                    state.update(b"," + ids.encode())
                    continue
                if now:
                    out.append((*now, state.hexdigest()))
                now, state = (a, b), hashlib.sha256(ids.encode())
            yield batch_of(out)
        if now:
            yield batch_of([(*now, state.hexdigest())])

    def batch_of(rows):
        a, b, c = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.string())], ["p1", "p2", "ends_sha256"])

    return dealt.mapInArrow(work, "p1 bigint, p2 bigint, ends_sha256 string")


def trie(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """All nodes of the conversations given as ``regraft`` or ``whole`` give them.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves`` and ``saved_tokens`` (over the subtree), ``ends_sha256``.
    """
    path = materialize(paths(turns))
    tree = materialize(nodes(path).selectExpr(
        "*", "CAST(n_children = 0 AS BIGINT) AS leaf", "(n_convs - 1) * words AS saved"))
    summed = rollup(tree, path, ["leaf", "saved"], piece)
    above = tree.selectExpr("p1 AS q1", "p2 AS q2", "m AS parent_conv_id")
    return summed.join(above, ["q1", "q2"], "left").join(end_hashes(path), ["p1", "p2"], "left").selectExpr(
        "m AS conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "sum_leaf AS n_leaves", "sum_saved AS saved_tokens",
        "coalesce(ends_sha256, sha2('', 256)) AS ends_sha256")

"""Connected components of a stored edge list, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from slotcast.session import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: the smallest node reachable from every node of the undirected edges.

    Each round links the larger neighbours of a node to its smallest neighbour, then the
    smaller ones; trees flatten to stars in about log2 of the diameter rounds. Neighbours are
    never gathered: a round is an aggregate with map-side minimum and a join, which adaptive
    execution splits where a node has very many edges. Every round is stored, so a lost
    executor costs one round at most.
    """
    now = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    while True:
        state = _fingerprint(now)
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: every larger neighbour of u goes to the smallest of u and its neighbours.
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u AS x", "least(u, m) AS m")
        large = both.where("v > u").join(least, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where("u <> v").distinct())
        # Small star: the smaller neighbours of u, and u, go to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "x")
        small = large.join(least, F.col("u") == F.col("x")).selectExpr("v AS u", "m AS v")
        now = materialize(small.unionAll(least.selectExpr("x AS u", "m AS v")).where("u <> v").distinct())
        if _fingerprint(now) == state:
            break
    roots = now.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                    F.sum(F.shiftright(F.xxhash64("v", "u"), 20)).alias("s")).first()
    return tuple(row)

"""Cross-validation folds that keep every key whole and the folds equally large.

Keys with a noticeable share of the rows are few, whatever the data: at most ``n_folds`` *
ONE_BY_ONE. They are packed one by one, the largest first, into the fold with the fewest rows
so far. All other keys, each too small to matter, fill the folds up to one common level: a
key's place in a fixed order says how many rows come before it, and so which fold it falls
into.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotcast.operators.profile import grouped

ONE_BY_ONE = 1000


def balanced_folds(rows: DataFrame, key: str, n_folds: int = 5, one_by_one: int = ONE_BY_ONE) -> DataFrame:
    """``key, n, fold``: one fold per distinct key; a null key is a key.

    Equal counts go in the order of the key, equal folds in the order of their numbers. A key
    larger than a fold should be has a fold of its own or shares one; no fold is larger than
    the larger of that key and the mean, plus one small key (total / (n_folds * one_by_one)).
    """
    counts = grouped(rows, [key], n="count(*)")
    total = grouped(counts, [], t="coalesce(sum(n), 0)").first()["t"]
    noticeable = F.col("n") * (n_folds * one_by_one) >= total
    large = counts.where(noticeable).orderBy(F.desc("n"), F.asc_nulls_first(key)).collect()
    heap = [(0, f) for f in range(n_folds)]
    placed = []
    for row in large:
        load, fold = heap[0]
        placed.append((row[key], row["n"], fold))
        heapq.heapreplace(heap, (load + row["n"], fold))
    schema = f"`{key}` {counts.schema[key].dataType.simpleString()}, n bigint, fold int"
    first = rows.sparkSession.createDataFrame(placed, schema)
    rest = total - sum(n for _, n, _ in placed)
    if not rest:
        return first
    return first.unionByName(_filled(counts.where(~noticeable), key, fill_levels([x for x, _ in sorted(heap, key=lambda h: h[1])], rest)))


def fill_levels(loads: list[int], rest: int) -> list[int]:
    """Where each fold's share of ``rest`` rows ends when the folds are filled to one level; earlier folds take the odd rows."""
    order = sorted(range(len(loads)), key=lambda f: (loads[f], f))
    level, used = loads[order[0]], 1
    while used < len(order) and (loads[order[used]] - level) * used <= rest:
        rest -= (loads[order[used]] - level) * used
        level, used = loads[order[used]], used + 1
    share, odd = divmod(rest, used)
    low = sorted(order[:used])
    added = [0] * len(loads)
    for i, f in enumerate(low):
        added[f] = level + share + (i < odd) - loads[f]
    ends, end = [], 0
    for a in added:
        end += a
        ends.append(end)
    return ends


def _filled(counts: DataFrame, key: str, ends: list[int]) -> DataFrame:
    """Folds of many small keys by the number of rows before them, in the order of a digest of the key."""
    digest = counts.withColumn("_d", F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))).withColumn("_b", F.substring("_d", 1, 3))
    earlier = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # over at most 4096 sums
    buckets = digest.groupBy("_b").agg(F.sum("n").alias("_s")).select("_b", F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_before"))
    here = Window.partitionBy("_b").orderBy("_d", key).rowsBetween(Window.unboundedPreceding, -1)
    at = digest.withColumn("_in", F.coalesce(F.sum("n").over(here), F.lit(0))).join(buckets, "_b")
    fold = "case " + " ".join(f"when _before + _in < {e} then {f}" for f, e in enumerate(ends[:-1])) + f" else {len(ends) - 1} end"
    return at.selectExpr(f"`{key}`", "n", f"{fold} as fold")


def with_folds(rows: DataFrame, folds: DataFrame, key: str, name: str = "fold") -> DataFrame:
    """``rows`` with their key's fold."""
    known = folds.select(F.col(key).alias("_key"), F.col("fold").alias("_fold"))
    return rows.join(known, F.col(key).eqNullSafe(F.col("_key"))).withColumn(name, F.col("_fold")).drop("_key", "_fold")

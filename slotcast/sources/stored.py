"""The observation grid as a stored table: partitioned by day, bucketed by key.

A day is read without the others, and aggregates and joins on the key need no exchange. What
is bucketed is the grid, not the raw rows: it has at most one row per key, slot and day, so a
bucket stays even where one key has a third of all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slotcast.plans.history import observation_grid
from slotcast.spec import DEFAULT, Spec


def store_grid(rows: DataFrame, name: str, path: str, buckets: int, sp: Spec = DEFAULT) -> DataFrame:
    """Writes the grid of ``rows`` (see ``stack_rows``) as table ``name`` below ``path`` and returns it.

    Every task writes whole buckets, so a day has one file per bucket.
    """
    grid = observation_grid(rows, sp).repartition(buckets, sp.key)
    (grid.write.partitionBy(sp.day).bucketBy(buckets, sp.key).sortBy(sp.key, sp.slot)
     .option("path", path).mode("overwrite").saveAsTable(name))
    return rows.sparkSession.table(name)


def drop_grid(spark: SparkSession, name: str) -> None:
    """Forgets the table; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def day_sums(grid: DataFrame, day: int, sp: Spec = DEFAULT) -> DataFrame:
    """``key, n, total`` of one day's labelled rows, from that day's files alone."""
    own = grid.where(f"{sp.day} = {day} and not is_test and n > 0")
    return own.groupBy(sp.key).agg({"n": "sum", "total": "sum"}).selectExpr(sp.key, "`sum(n)` as n", "`sum(total)` as total")


def day_ratio(grid: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """``key, history_mean, target_mean, ratio`` of the keys seen on both days."""
    before, now = day_sums(grid, sp.history_day, sp), day_sums(grid, sp.target_day, sp)
    before = before.selectExpr(sp.key, "total / n as history_mean")
    now = now.selectExpr(sp.key, "total / n as target_mean")
    return before.join(now, sp.key).selectExpr("*", f"target_mean / (history_mean + {sp.eps!r}D) as ratio")

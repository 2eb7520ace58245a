"""Hierarchical median and mode imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.functions.quantiles import exact_quantiles
from slotcast.spec import DEFAULT, Spec


def median_levels(train: DataFrame, column: str, sp: Spec = DEFAULT) -> dict[str, DataFrame]:
    """Exact medians of the training rows by (key, hour), by key and overall."""
    levels = {"key_hour": [sp.key, sp.hour], "key": [sp.key], "global": []}
    return {name: exact_quantiles(train, by, column, {"median": 0.5}) for name, by in levels.items()}


def impute_median(train: DataFrame, rows: DataFrame, column: str, sp: Spec = DEFAULT) -> DataFrame:
    """Nulls of ``column`` become the (key, hour) median, else the key's, else the overall one.

    The two keyed levels are joined to each other before they meet the rows, so the rows
    are shuffled once.
    """
    levels = median_levels(train, column, sp)
    cells = rows.select(sp.key, sp.hour).distinct()
    fill = (
        cells.join(levels["key_hour"].withColumnRenamed("median", "_m1"), [sp.key, sp.hour], "left")
        .join(levels["key"].withColumnRenamed("median", "_m2"), sp.key, "left")
        .select(sp.key, sp.hour, F.coalesce("_m1", "_m2").alias("_fill"))
    )
    return (
        rows.join(fill, [sp.key, sp.hour], "left")
        .withColumn(column, F.coalesce(F.col(column), F.col("_fill"), levels["global"].scalar()))
        .drop("_fill")
    )


def mode_levels(train: DataFrame, column: str, levels: Sequence[Sequence[str]]) -> list[DataFrame]:
    """The most frequent value of ``column`` per group, for every level of grouping; equal counts go to the smaller value.

    The first level is the finest and holds the columns of all others, whose counts are sums
    of its counts: the rows are counted once, before anything is shuffled.
    """
    counts = train.where(F.col(column).isNotNull()).groupBy(*levels[0], column).agg(F.count("*").alias("_c"))
    out = []
    for by in levels:
        found = counts.groupBy(*by, column).agg(F.sum("_c").alias("_c")) if list(by) != list(levels[0]) else counts
        first = F.min(F.struct((-F.col("_c")).alias("c"), F.col(column).alias("v"))).alias("_first")
        out.append(found.groupBy(*by).agg(first).select(*by, F.col("_first.v").alias("mode")))
    return out


def impute_mode(train: DataFrame, rows: DataFrame, column: str, levels: Sequence[Sequence[str]]) -> DataFrame:
    """Nulls of ``column`` become the mode of the first level whose group has one; the last level may be [] for all rows.

    The levels are joined to each other before they meet the rows, so the rows are shuffled once.
    """
    modes = mode_levels(train, column, levels)
    keyed = [(list(by), mode) for by, mode in zip(levels, modes) if by]
    cells = rows.where(F.col(column).isNull()).select(*levels[0]).distinct()
    for i, (by, mode) in enumerate(keyed):
        cells = cells.join(mode.withColumnRenamed("mode", f"_m{i}"), by, "left")
    fill = cells.select(*levels[0], F.coalesce(*[f"_m{i}" for i in range(len(keyed))]).alias("_fill"))
    overall = [mode.scalar() for by, mode in zip(levels, modes) if not by]
    return (
        rows.join(fill, list(levels[0]), "left")
        .withColumn(column, F.coalesce(F.col(column), F.col("_fill"), *overall)).select(*rows.columns)
    )

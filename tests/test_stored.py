"""The stored grid: day files pruned, no exchange on the key."""

from __future__ import annotations

import pytest

from slotcast.plans.history import stack_rows
from slotcast.session import scratch_path
from slotcast.sources import stored


@pytest.fixture
def grid(spark, observed):
    rows = [(f"k{i % 9}", 48 + i % 2, 15 * (i % 40), 0.01 + i % 7 / 10) for i in range(700)]
    rows += [("hot", 48 + i % 2, 15 * (i % 96), 0.5) for i in range(1000)] + [("only48", 48, 0, 0.25)]
    every = stack_rows(observed(rows), observed([("new", 49, 30, None)], value=False))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    table = stored.store_grid(every, "grid_under_test", scratch_path(spark, "grid"), 4)
    yield rows, table
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    stored.drop_grid(spark, "grid_under_test")


def test_ratio_without_exchange(grid):
    rows, table = grid
    ratio = stored.day_ratio(table)
    got = {r["geohash"]: r for r in ratio.collect()}
    plan = ratio._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert "PartitionFilters: [isnotnull(day" in plan and "(day" in plan and "= 48)" in plan and "= 49)" in plan
    for key in {k for k, *_ in rows} - {"only48"}:
        means = [[v for k, d, _, v in rows if (k, d) == (key, day)] for day in (48, 49)]
        before, now = (sum(m) / len(m) for m in means)
        assert got[key]["ratio"] == pytest.approx(now / (before + 1e-9))
    assert "only48" not in got and "new" not in got


def test_a_hot_key_is_a_few_rows_of_its_bucket(grid):
    _, table = grid
    assert table.where("geohash = 'hot'").count() == 96

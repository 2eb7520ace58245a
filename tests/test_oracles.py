"""Every registered query against its SQL twin on the raw tables."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as entry
from slotcast.queries import ORACLES, QUERIES

WITH_SQL = sorted(ORACLES)
# fitted on a few hundred rows in test_models.py
LEARNED = ["train_ensemble", "oof_predictions", "final_predictions", "top_features", "spatial_clusters"]


def test_registry_is_complete():
    assert set(QUERIES) - set(WITH_SQL) == set(LEARNED)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_matches_sql(spark, duck, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    rows = df.toPandas()
    plan = df._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert compare.differences(rows, duck.execute(entry.oracle_sql()[name]).df()) is None


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0

"""Ranks of groups of any size against numpy."""

from __future__ import annotations

import numpy as np
import pytest

from slotcast.functions import quantiles
from slotcast.functions.quantiles import exact_quantiles

PROBS = {"p0": 0.0, "p05": 0.05, "p10": 0.1, "p50": 0.5, "p90": 0.9, "p999": 0.999, "p100": 1.0}


def frame(spark, groups):
    return spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs], "g string, v double")


def check(rows, groups):
    assert len(rows) == len(groups)
    for r in rows:
        for name, p in PROBS.items():
            assert r[name] == pytest.approx(np.quantile(groups[r["g"]], p), rel=1e-12, abs=1e-300), (r["g"], name)


def test_large_and_small_groups(spark):
    rng = np.random.default_rng(0)
    groups = {
        "uniform": rng.random(3000), "skewed": np.exp(rng.normal(0, 8, 2500)), "ties": rng.integers(0, 4, 2000),
        "constant": np.full(1500, 0.25), "negative": -np.exp(rng.normal(0, 3, 1200)),
        "few": rng.random(7), "one": np.array([0.5]),
    }
    check(exact_quantiles(frame(spark, groups), ["g"], "v", PROBS).collect(), groups)


def test_without_groups(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.random(2000), rng.normal(100, 1e-6, 1000)])
    df = frame(spark, {"all": values})
    row = exact_quantiles(df, [], "v", PROBS).first()
    for name, p in PROBS.items():
        assert row[name] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_nulls_are_left_out(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", None)], "g string, v double")
    assert [tuple(r) for r in exact_quantiles(df, ["g"], "v", {"m": 0.5}).collect()] == [("a", 2.0)]


def test_weights_count_rows(spark):
    groups = {"a": np.repeat(np.arange(50.0), 10), "b": np.arange(20.0)}
    rows = spark.createDataFrame([("a", float(v), 10) for v in range(50)] + [("b", float(v), 1) for v in range(20)]
                                 + [("b", 99.0, 0)], "g string, v double, n int")
    check(exact_quantiles(rows, ["g"], "v", PROBS, weight="n").collect(), groups)


def test_infinity_and_nan(spark):
    inf = float("inf")
    groups = {"inf": [float(i) for i in range(99)] + [inf], "both": [-inf] + [0.0] * 50 + [inf] * 30, "huge": [-1.7e308, 1.7e308] * 40}
    got = {r["g"]: r for r in exact_quantiles(frame(spark, groups), ["g"], "v", {"m": 0.5, "top": 1.0, "low": 0.0}).collect()}
    assert (got["inf"]["m"], got["inf"]["top"]) == (49.5, inf) and (got["both"]["m"], got["both"]["low"]) == (0.0, -inf)
    assert (got["huge"]["low"], got["huge"]["top"]) == (-1.7e308, 1.7e308)
    nan = exact_quantiles(frame(spark, {"n": [1.0, 2.0, 3.0, float("nan"), float("nan")]}), ["g"], "v", {"m": 0.5, "top": 1.0}).first()
    assert nan["m"] == 3.0 and np.isnan(nan["top"])


def test_a_group_over_many_partitions(spark):
    rng = np.random.default_rng(3)
    values = rng.normal(0, 1, 20_000)
    df = frame(spark, {"big": values, "null group": [1.0, 2.0]}).selectExpr("nullif(g, 'null group') as g", "v")
    kept = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", PROBS).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept[1])
    assert got[None]["p50"] == 1.5 and set(got) == {"big", None}
    for name, p in PROBS.items():
        assert got["big"][name] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_no_rows(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert exact_quantiles(df, ["g"], "v", PROBS).collect() == []
    assert [tuple(r) for r in exact_quantiles(df, [], "v", {"m": 0.5}).collect()] == [(None,)]


def test_brackets_of_large_groups(spark, monkeypatch):
    """Groups beyond WHOLE rows: only the rows around a rank are sorted, and the result stays exact."""
    monkeypatch.setattr(quantiles, "WHOLE", 400)
    monkeypatch.setattr(quantiles, "EDGE", 0.02)
    rng = np.random.default_rng(4)
    groups = {
        "uniform": rng.random(6000), "skewed": np.exp(rng.normal(0, 8, 5000)), "ties": rng.integers(0, 4, 3000),
        "constant": np.full(2000, 0.25), "two": np.repeat([1.0, 2.0], [2999, 3001]), "small": rng.random(399),
        "narrow": 1 + rng.random(4000) * 1e-12, "border": rng.random(401),
    }
    df = frame(spark, groups)
    check(exact_quantiles(df, ["g"], "v", PROBS).collect(), groups)
    every = np.concatenate([np.asarray(v, float) for v in groups.values()])
    row = exact_quantiles(df, [], "v", PROBS, n="count(*)", top="max(_v)").first()
    assert row["n"] == len(every) and row["top"] == every.max()
    for name, p in PROBS.items():
        assert row[name] == pytest.approx(np.quantile(every, p), rel=1e-12)


def test_infinity_in_brackets(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "WHOLE", 400)
    monkeypatch.setattr(quantiles, "EDGE", 0.02)
    inf, nan = float("inf"), float("nan")
    values = [-inf] * 300 + [float(i) for i in range(1000)] + [inf] * 200 + [nan] * 100
    row = exact_quantiles(frame(spark, {"a": values}), [], "v", {"a": 0.1, "b": 0.5, "c": 0.85, "d": 0.99, "e": 1.0}).first()
    assert (row["a"], row["c"]) == (-inf, inf) and row["b"] == np.quantile(np.array(values[:1500] + [inf] * 100), 0.5)
    assert np.isnan(row["d"]) and np.isnan(row["e"])


def test_nothing_runs_before_the_first_action(spark):
    df = frame(spark, {"a": range(100)}).repartition(3)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("quantiles", "plan only")
    exact_quantiles(df, ["g"], "v", PROBS, mean="avg(_v)")
    assert list(tracker.getJobIdsForGroup("quantiles")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

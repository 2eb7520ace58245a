"""Chunked boosting, random search by halving, and k-means restarts in one pass."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor

from slotcast.operators import clusters, search
from slotcast.operators.boosting import Boosting, TreeParams, best_round, boost
from slotcast.session import materialize


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    data = []
    for i in range(600):
        x = [rng.uniform(-2, 2) for _ in range(3)]
        data.append((i, -1 if i % 4 else 0, *x, math.sin(2 * x[0]) + x[1] * x[2] + rng.gauss(0, 0.6)))
    return materialize(spark.createDataFrame(data, "Index bigint, fold int, a double, b double, c double, y_log double"))


@pytest.fixture(scope="module")
def matrix(rows):
    return search.binned(rows, ["a", "b", "c"], ["Index", "fold", "y_log"], 16)


PARAMS = TreeParams(depth=3, step=0.5, row_share=0.7, feature_share=0.7, min_leaf=5, max_bins=16)


def test_a_fit_is_the_same_in_chunks_of_any_size(matrix):
    whole, parts = Boosting(matrix, PARAMS), Boosting(matrix, PARAMS)
    whole.advance(7)
    for n in (1, 4, 2):
        parts.advance(n)
    assert parts.losses == pytest.approx(whole.losses, rel=1e-9) and len(parts.trees) == 7
    again = Boosting(matrix, PARAMS, keep_predictions=False)
    again.advance(5)
    again.advance(2)
    assert again.losses == pytest.approx(whole.losses, rel=1e-9)
    error = whole.model().transform(matrix.where("fold = 0")).selectExpr("avg((y_log - prediction) * (y_log - prediction)) as e").first()["e"]
    assert error == pytest.approx(whole.losses[-1])
    first = whole.model(1).transform(matrix.where("fold = 0")).selectExpr("avg((y_log - prediction) * (y_log - prediction)) as e").first()["e"]
    assert first == pytest.approx(whole.losses[0])


def test_patience_keeps_the_same_round_and_fits_fewer(matrix):
    eager = TreeParams(depth=5, step=1.5, min_leaf=1, max_bins=16)  # overshoots, so its loss soon rises
    full, stopped = Boosting(matrix, eager), Boosting(matrix, eager)
    boost(full, 12)
    kept = boost(stopped, 12, patience=3, chunk=2)
    assert kept == best_round(full.losses, 3) and len(stopped.trees) < len(full.trees) == 12
    assert stopped.losses == pytest.approx(full.losses[:len(stopped.losses)])


def test_first_round_is_a_plain_tree(matrix):
    fit = Boosting(matrix, TreeParams(depth=2, max_bins=16))
    fit.advance(1)
    tree = DecisionTreeRegressor(featuresCol="features", labelCol="y_log", maxDepth=2, maxBins=16).fit(matrix.where("fold = -1"))
    got = {r["Index"]: r["prediction"] for r in fit.model().transform(matrix).collect()}
    assert got == pytest.approx({r["Index"]: r["prediction"] for r in tree.transform(matrix).collect()})


def test_no_validation_rows(matrix):
    fit = Boosting(matrix.where("fold = -1"), PARAMS)
    assert boost(fit, 3, patience=1, chunk=2) == 3 and fit.losses == []


def test_halving_finds_what_the_exhaustive_search_finds(spark, matrix):
    base = TreeParams(max_bins=16, min_leaf=5)
    grid = [TreeParams(depth=d, step=s, min_leaf=m, max_bins=16) for d, s, m in
            [(1, 0.05, 5), (3, 0.3, 5), (4, 0.3, 5), (2, 0.01, 200), (1, 0.3, 100), (2, 0.3, 5)]]
    fast = search.successive_halving(matrix, grid, rungs=(2, 6), keep=1 / 2)
    full = search.successive_halving(matrix, grid, rungs=(6,), keep=1.0)
    assert fast.best == full.best
    assert [len([x for x in fast.log if x[0] == r]) for r in (0, 1)] == [6, 3]
    assert {len(f.trees) for f in fast.fits} == {2, 6} and fast.fits[fast.best].losses == pytest.approx(full.fits[full.best].losses)
    table = fast.table(spark).collect()
    assert sum(r["goes_on"] for r in table if r["rung"] == 0) == 3 and [r["trial"] for r in table if r["rung"] == 1 and r["goes_on"]] == [fast.best]
    assert min(full.log, key=lambda x: (x[3], x[1]))[1] == full.best and base.depth == 6


def test_random_trials_stay_in_their_ranges():
    trials = search.random_trials(200, seed=3)
    assert trials == search.random_trials(200, seed=3) and len(set(trials)) == 200
    assert {t.depth for t in trials} == set(range(6, 10)) and all(20 <= t.min_leaf <= 200 for t in trials)
    assert all(0.01 <= t.step <= 0.1 and 0.6 <= t.feature_share <= 1 for t in trials)
    assert sum(t.step < math.sqrt(0.001) for t in trials) == pytest.approx(100, abs=25)


def test_bins_keep_order_and_missing_values_apart(spark):
    data = [(i, None if i % 10 == 0 else float(i)) for i in range(100)]
    got = search.binned(spark.createDataFrame(data, "Index bigint, v double"), ["v"], ["Index"], 8).collect()
    bins = {r["Index"]: r["features"][0] for r in got}
    known = [bins[i] for i in range(100) if i % 10]
    assert known == sorted(known) and len(set(known)) == 7 and {bins[i] for i in range(0, 100, 10)} == {7.0}


def points(spark, data):
    return spark.createDataFrame([(float(a), float(b)) for a, b in data], "lat double, lon double")


def test_all_restarts_at_once_are_as_good_as_one_by_one(spark):
    rng = random.Random(9)
    data = [(c % 4 + rng.gauss(0, 0.05), c // 4 + rng.gauss(0, 0.05)) for c in range(12) for _ in range(40)]
    df = points(spark, data)
    zones = clusters.fit_zones(df, 12)
    vectors = VectorAssembler(inputCols=["lat", "lon"], outputCol="features").transform(df)
    best = min(KMeans(k=12, seed=i).fit(vectors).summary.trainingCost for i in range(10))
    assert zones.cost <= best * (1 + 1e-9) and len(zones.costs) == 10 and zones.cost == min(zones.costs)
    plain = sum(min((a - x) ** 2 + (b - y) ** 2 for x, y in zones.centres) for a, b in data)
    assert zones.cost == pytest.approx(plain)
    assert clusters.fit_zones(df, 12).centres == zones.centres


@pytest.mark.parametrize("data,k,n", [([], 3, 0), ([(1, 2)], 3, 1), ([(1, 2), (1, 2), (3, 4)], 5, 2), ([(i, 0) for i in range(6)], 6, 6)])
def test_few_points(spark, data, k, n):
    zones = clusters.fit_zones(points(spark, data), k, restarts=2)
    assert len(zones.centres) == n and zones.cost == pytest.approx(0, abs=1e-9)


def test_points_are_dealt_over_all_cores(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(clusters, "materialize", lambda df, *by: stored.append(materialize(df, *by)) or stored[-1])
    rng = random.Random(2)
    zones = clusters.fit_zones(points(spark, [(rng.random(), rng.random()) for _ in range(400)]).coalesce(1), 5, restarts=4)
    assert stored[0].count() == 400 and stored[0].rdd.getNumPartitions() >= 4
    assert zones.cost == min(zones.costs) and len(zones.costs) == 4


def test_equal_restarts_cost_the_same(spark):
    rng = random.Random(3)
    data = [(c % 3 * 10 + rng.gauss(0, 0.01), c // 3 * 10 + rng.gauss(0, 0.01)) for c in range(9) for _ in range(30)]
    zones = clusters.fit_zones(points(spark, data), 9)
    assert zones.costs.count(zones.cost) > 1 and zones.centres == clusters.fit_zones(points(spark, data).repartition(7), 9).centres


def test_no_coordinates_are_the_first_zone(spark):
    df = spark.createDataFrame([("a", None, None), ("b", 5.0, 5.0)], "geohash string, lat double, lon double")
    got = clusters.assign_centroid(df, [(1.0, 0.0), (5.0, 4.0)]).collect()
    assert [r["cluster"] for r in got] == [0, 1]


def test_binning_computes_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)
    data = spark.sparkContext.parallelize([(i, float(i)) for i in range(50)], 2).map(lambda r: seen.add(1) or r)
    got = search.binned(spark.createDataFrame(data, "Index bigint, v double"), ["v"], ["Index"], 8)
    assert got.count() == 50 and seen.value == 50


def test_known_keys_are_one_row_each(spark):
    train = spark.createDataFrame([("qp0000",), ("qp0000",), ("a!",)], "geohash string")
    test = spark.createDataFrame([("qp0000",), ("qp0001",)], "geohash string")
    got = {r["geohash"]: (r["seen"], r["lat"] is not None) for r in clusters.known_keys(train, test).collect()}
    assert got == {"qp0000": (True, True), "qp0001": (False, True), "a!": (True, False)}
    assert clusters.known_keys(train, test).count() == 3


def test_the_plan_does_not_grow_with_the_centres(spark):
    df, rng = points(spark, [(1, 1), (2, 2)]), random.Random(5)
    plans = [clusters._nearest_by_run(df, {0: [(rng.random(), rng.random()) for _ in range(n)]})._jdf.queryExecution().optimizedPlan().toString()
             for n in (2, 300)]
    assert len(plans[1]) < len(plans[0]) + 50


def test_nearest_centres_are_those_of_the_table(spark):
    rng = random.Random(6)
    df = points(spark, [(rng.randrange(6), rng.randrange(6)) for _ in range(200)])  # many ties
    centres = [(rng.randrange(6) + 0.5, rng.randrange(6) + 0.5) for _ in range(7)]
    found = {(r["run"], r["lat"], r["lon"]): (r["c"], r["d"]) for r in clusters._nearest_by_run(df, {3: centres, 4: centres[:2]}).collect()}
    assert len(found) == 2 * df.distinct().count()
    for run, some in ((3, centres), (4, centres[:2])):
        for r in clusters.assign_centroid(df, some).collect():
            least = min((r["lat"] - a) ** 2 + (r["lon"] - b) ** 2 for a, b in some)
            assert found[run, r["lat"], r["lon"]] == (r["cluster"], least)


def test_means_are_exact_far_from_the_origin(spark):
    data = [(i * 10.0 ** 8 + s / 4, -i * 10.0 ** 8) for i in range(-3, 4) for s in range(100)]
    whole = clusters._spread_out(points(spark, data))
    centres = [(i * 10.0 ** 8, -i * 10.0 ** 8) for i in range(-3, 4)]
    means = clusters._means(whole, {0: centres, 2: [*centres, (9e9, 9e9)]})
    assert len(means) == 14  # a centre without points has none
    for run in (0, 2):
        assert [means[run, i] for i in range(7)] == [pytest.approx((a + 12.375, b), rel=1e-15) for a, b in centres]


def test_predictions_are_stored_only_for_further_rounds(matrix, monkeypatch):
    from slotcast.operators import boosting

    stored = []
    monkeypatch.setattr(boosting, "materialize", lambda df: stored.append(materialize(df)) or stored[-1])
    fit = Boosting(matrix, PARAMS)
    assert boost(fit, 2, None, 2) == 2 and not stored
    assert boost(fit, 5, None, 2) == 5 and len(stored) == 2 and len(fit.losses) == 5

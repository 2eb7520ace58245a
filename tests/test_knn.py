"""Neighbour search against brute force on point sets that stress the blocking."""

from __future__ import annotations

import random

import pytest

from slotcast.functions.geo import ALPHABET
from slotcast.operators import knn
from slotcast.spec import Spec


def brute(asking, data, k, xw):
    out = {}
    for i, x, y in asking:
        near = sorted((xw * xw * (x - a) ** 2 + (y - b) ** 2, j) for j, a, b in data if j != i)
        out[i] = [(d, j) for d, j in near[:k]]
    return out


def run(spark, asking, data, k, xw, bits, **kw):
    flags = {}
    for p in asking:
        flags[p] = [True, False]
    for p in data:
        flags.setdefault(p, [False, True])[1] = True
    rows = [(i, x, y, a, d) for (i, x, y), (a, d) in flags.items()]
    points = spark.createDataFrame(rows, "id string, x bigint, y bigint, asks boolean, is_data boolean")
    out = {}
    for r in knn.nearest(points, k, bits, xw, **kw).orderBy("id", "rank").collect():
        out.setdefault(r["id"], []).append((r["dist2"], r["neighbor"]))
    return out


def uniform(n, bits, seed, tag):
    rng = random.Random(seed)
    seen = {(rng.randrange(1 << bits), rng.randrange(1 << bits)) for _ in range(n)}
    return [(f"{tag}{i:04d}", x, y) for i, (x, y) in enumerate(sorted(seen))]


def dense(side, x0, y0, tag):
    return [(f"{tag}{i:02d}{j:02d}", x0 + i, y0 + j) for i in range(side) for j in range(side)]


@pytest.mark.parametrize("xw", [1, 2])
def test_uniform_points(spark, xw):
    pts = uniform(250, 10, 1, "u")
    assert run(spark, pts, pts, 5, xw, 10) == brute(pts, pts, 5, xw)


def test_dense_grid_with_ties_and_a_far_point(spark):
    pts = dense(12, 100, 900, "g") + [("far", 65000, 3)]
    assert run(spark, pts, pts, 5, 2, 16) == brute(pts, pts, 5, 2)


def test_cold_cluster_far_from_the_data(spark):
    data, asking = dense(10, 10, 10, "d"), dense(10, 50_000, 60_000, "q")
    assert run(spark, asking, data, 3, 2, 16) == brute(asking, data, 3, 2)


def test_points_around_a_lonely_query(spark):
    ring = [(f"r{i}", 500 + dx, 500 + dy) for i, (dx, dy) in enumerate(
        [(400, 0), (0, 400), (-400, 0), (0, -400), (240, 320), (320, 240), (-240, 320), (240, -320)])]
    assert run(spark, [("q", 500, 500)], ring, 4, 1, 10) == brute([("q", 500, 500)], ring, 4, 1)


def test_fewer_points_than_k(spark):
    pts = [("a", 1, 1), ("b", 900, 3), ("c", 5, 700)]
    assert run(spark, pts, pts, 5, 1, 10) == brute(pts, pts, 5, 1)


@pytest.mark.parametrize("step,leaf", [(1, 1), (2, 3), (5, 2)])
def test_level_layout_does_not_matter(spark, step, leaf):
    pts = uniform(60, 9, 7, "s") + dense(5, 40, 40, "t")
    assert run(spark, pts, pts, 4, 2, 9, step=step, leaf_shift=leaf) == brute(pts, pts, 4, 2)


def decode(key):
    """(lon, lat) of the cell centre, by bisection."""
    lo, hi = [-180.0, -90.0], [180.0, 90.0]
    bit = 0
    for c in key:
        for b in range(4, -1, -1):
            axis = bit % 2
            mid = (lo[axis] + hi[axis]) / 2
            (lo if (ALPHABET.index(c) >> b) & 1 else hi)[axis] = mid
            bit += 1
    return (lo[0] + hi[0]) / 2, (lo[1] + hi[1]) / 2


def test_keys_of_mixed_length(spark):
    rng = random.Random(3)
    keys = sorted({"qp" + "".join(rng.choice(ALPHABET) for _ in range(rng.choice([1, 2, 3, 4]))) for _ in range(80)})
    sp = Spec(k_warm=3)
    got = {}
    for r in knn.warm_neighbors(spark.createDataFrame([(k,) for k in keys], "geohash string"), sp).collect():
        got.setdefault(r["geohash"], {})[r["rank"]] = (r["neighbor"], r["dist"])
    at = {k: decode(k) for k in keys}
    for k in keys:
        near = sorted((round(((at[k][0] - at[o][0]) ** 2 + (at[k][1] - at[o][1]) ** 2) ** 0.5, 9), o) for o in keys if o != k)
        assert [round(got[k][i + 1][1], 9) for i in range(3)] == [d for d, _ in near[:3]]


def test_decode_matches_bisection(spark):
    from slotcast.functions.geo import decode as decode_keys

    rng = random.Random(5)
    keys = sorted({"".join(rng.choice(ALPHABET) for _ in range(n)) for n in range(1, 13) for _ in range(4)})
    for r in decode_keys(spark.createDataFrame([(k,) for k in keys], "geohash string")).collect():
        lon, lat = decode(r["geohash"])
        assert (r["lat"], r["lon"]) == pytest.approx((lat, lon), abs=1e-9)


def test_invalid_keys(spark):
    from slotcast.functions.geo import decode as decode_keys

    rows = {r["geohash"]: r for r in decode_keys(spark.createDataFrame([("EZS42",), ("a!",), ("",)], "geohash string")).collect()}
    assert rows["EZS42"]["lat"] == pytest.approx(42.60498046875)
    assert rows["a!"]["lat"] is None and not rows["a!"]["valid"] and not rows[""]["valid"]

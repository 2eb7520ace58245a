"""Spatial zones: k-means over the distinct key coordinates, all restarts at once."""

from __future__ import annotations

import random
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.functions.geo import with_lat_lon
from slotcast.operators.profile import grouped
from slotcast.session import materialize
from slotcast.spec import DEFAULT, Spec

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

SEED_ROUNDS = 5
MAX_ROUNDS = 100
UNIT = 1e-9

Point = tuple[float, float]


@dataclass(frozen=True)
class Zones:
    """Centres of the best restart, its cost (sum of squared distances) and the costs of all restarts."""

    centres: list[Point]
    cost: float
    costs: list[float]


def fit_zones(coordinates: DataFrame, k: int, restarts: int = 10, seed: int = 42) -> Zones:
    """The best of ``restarts`` k-means fits by cost; input has lat and lon.

    Seeding passes gather some 2 * k * SEED_ROUNDS candidates with the number of points nearest
    to each; every restart picks its first centres from them. After that one aggregate per
    iteration moves the centres of all restarts that still change: the points are read once
    per iteration however many restarts there are, and k sums per restart come back. A
    centre without points stays. With fewer distinct points than k there are fewer centres.
    The points are few bytes but many distances: they are stored once, in a part per core, and
    the distances are taken in Arrow batches. As SQL text every iteration, having other centres,
    would be planned and compiled anew.
    """
    points = _spread_out(coordinates)
    candidates = _candidates(points, k, seed)
    if not candidates:
        return Zones([], 0.0, [])
    weights = {r["c"]: r["n"] for r in grouped(_nearest_by_run(points, {0: candidates}), ["c"], n="count(*)").collect()}
    runs = [_spread(candidates, weights, k, random.Random(seed + i)) for i in range(restarts)]
    judged, moving = list(runs), list(range(restarts))
    for _ in range(MAX_ROUNDS):
        means = _means(points, {i: runs[i] for i in moving})
        still = []
        for i in moving:
            judged[i] = runs[i]
            runs[i] = [means.get((i, c), centre) for c, centre in enumerate(judged[i])]
            if runs[i] != judged[i]:
                still.append(i)
        moving = still
        if not moving:
            break
    costs = _costs(points, judged)
    best = min(range(restarts), key=lambda i: (costs[i], i))
    return Zones(runs[best], costs[best], costs)


def _spread_out(coordinates: DataFrame) -> DataFrame:
    """The points with whole coordinates x, y in units of ``UNIT``, stored in as many parts as there are cores."""
    points = coordinates.where("lat is not null and lon is not null").selectExpr(
        "lat", "lon", f"cast(round(lat / {UNIT}) as bigint) as x", f"cast(round(lon / {UNIT}) as bigint) as y")
    return materialize(points.repartition(points.sparkSession.sparkContext.defaultParallelism, "lat", "lon"))


def _nearest(lat: np.ndarray, lon: np.ndarray, centres: Sequence[Point]) -> tuple[np.ndarray, np.ndarray]:
    """Per point the index of the nearest centre (the smaller one on ties) and its squared distance."""
    at, least = np.zeros(len(lat), np.int64), np.full(len(lat), np.inf)
    for i, (a, b) in enumerate(centres):
        d = (lat - a) * (lat - a) + (lon - b) * (lon - b)
        closer = d < least
        at[closer], least[closer] = i, d[closer]
    return at, least


def _nearest_by_run(points: DataFrame, runs: dict[int, list[Point]]) -> DataFrame:
    """A row per point and run: ``run``, the nearest centre ``c``, its squared distance ``d``, lat and lon."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lat, lon = (batch.column(x).to_numpy() for x in ("lat", "lon"))
            for run, centres in runs.items():
                c, d = _nearest(lat, lon, centres)
                yield pa.RecordBatch.from_pydict(
                    {"run": np.full(len(c), run, np.int32), "c": c.astype(np.int32), "d": d, "lat": lat, "lon": lon})

    return points.select("lat", "lon").mapInArrow(nearest, "run int, c int, d double, lat double, lon double")


def _means(points: DataFrame, runs: dict[int, list[Point]]) -> dict[tuple[int, int], Point]:
    """(run, centre) -> mean lat and lon of the points nearest to it."""
    # Whole multiples of a tiny unit add up to the same sum in any order, so a settled run is seen to be settled.
    found = grouped(points.select("lat", "lon", "x", "y").mapInArrow(
        lambda batches: _sums(batches, runs), "run int, c int, n bigint, x decimal(38, 0), y decimal(38, 0)",
    ), ["run", "c"], n="sum(n)", lat="sum(x)", lon="sum(y)")
    return {(r["run"], r["c"]): (float(r["lat"]) * UNIT / r["n"], float(r["lon"]) * UNIT / r["n"]) for r in found.collect()}


def _sums(batches: Iterator[pa.RecordBatch], runs: dict[int, list[Point]]) -> Iterator[pa.RecordBatch]:
    """Per run and centre the number of a partition's points nearest to it and their sums of x and y."""
    # upper and lower half of x and of y: neither sum leaves 64 bits below two billion points
    sums = {run: np.zeros((5, len(centres)), np.int64) for run, centres in runs.items()}
    for batch in batches:
        lat, lon, x, y = (batch.column(name).to_numpy() for name in ("lat", "lon", "x", "y"))
        parts = [np.ones(len(x), np.int64), x >> 32, x & 0xFFFFFFFF, y >> 32, y & 0xFFFFFFFF]
        for run, centres in runs.items():
            c, _ = _nearest(lat, lon, centres)
            for total, part in zip(sums[run], parts):
                np.add.at(total, c, part)
    found = [(run, c, *map(int, sums[run][:, c])) for run in runs for c in range(len(runs[run])) if sums[run][0, c]]
    run, c, n, x, low_x, y, low_y = zip(*found) if found else [()] * 7
    whole = [pa.array([Decimal((a << 32) + b) for a, b in zip(*halves)], pa.decimal128(38, 0)) for halves in ((x, low_x), (y, low_y))]
    yield pa.RecordBatch.from_arrays(
        [pa.array(run, pa.int32()), pa.array(c, pa.int32()), pa.array(n, pa.int64()), *whole], ["run", "c", "n", "x", "y"])


def _costs(points: DataFrame, runs: list[list[Point]]) -> list[float]:
    """Sum of squared distances of every run; runs with the same centres cost the same however the points are dealt."""
    found = grouped(_nearest_by_run(points, dict(enumerate(runs))), ["run"], d="sum(cast(d as decimal(28, 18)))")
    costs = {r["run"]: float(r["d"]) for r in found.collect()}
    return [costs[i] for i in range(len(runs))]


def _candidates(points: DataFrame, k: int, seed: int) -> list[Point]:
    """Points far from each other: every round takes each point with a chance proportional to its squared distance from those so far."""
    first = points.orderBy(F.xxhash64(F.lit(seed), "lat", "lon"), "lat", "lon").limit(1).collect()
    chosen = [(r["lat"], r["lon"]) for r in first]
    for i in range(4 * SEED_ROUNDS) if chosen else ():
        far = _nearest_by_run(points, {0: chosen})
        total = grouped(far, [], t="sum(d)").first()["t"]
        if not total or (i >= SEED_ROUNDS and len(chosen) >= k):
            break
        chance = f"(xxhash64({seed}, {i}, lat, lon) & 9007199254740991) / 9007199254740992D"
        taken = far.where(f"{chance} < {2 * k / total!r}D * d").select("lat", "lon").distinct()
        chosen += sorted((r["lat"], r["lon"]) for r in taken.collect())
    return chosen


def _spread(candidates: list[Point], weights: dict[int, int], k: int, rng: random.Random) -> list[Point]:
    """First centres of one restart: candidates drawn by weight times squared distance from those drawn before."""
    mass = [weights.get(i, 0) for i in range(len(candidates))]
    distance, centres = [1.0] * len(candidates), []
    while len(centres) < k and any(m * d > 0 for m, d in zip(mass, distance)):
        new = candidates[rng.choices(range(len(candidates)), [m * d for m, d in zip(mass, distance)])[0]]
        squares = [(a - new[0]) ** 2 + (b - new[1]) ** 2 for a, b in candidates]
        distance = squares if not centres else list(map(min, distance, squares))
        centres.append(new)
    return centres


def known_keys(train: DataFrame, test: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """One stored row per key of either frame with lat and lon (NULL where malformed); ``seen`` are those of training rows."""
    both = train.selectExpr(sp.key, "true as seen").unionByName(test.selectExpr(sp.key, "false as seen"))
    return materialize(with_lat_lon(grouped(both, [sp.key], seen="max(seen)"), sp.key))


def spatial_clusters(
    train: DataFrame, test: DataFrame, sp: Spec = DEFAULT, k: int | None = None, restarts: int = 10, seed: int = 42
) -> DataFrame:
    """key -> geohash_cluster (string): zones fitted on training keys, other keys go to the nearest centre."""
    every = known_keys(train, test, sp).where("lat is not null")
    zones = fit_zones(every.where("seen"), k or sp.n_clusters, restarts, seed)
    return assign_centroid(every, zones.centres).selectExpr(
        sp.key, "lat", "lon", "cast(cluster as string) as geohash_cluster"
    )


def _distances(centres: Sequence[Point]) -> str:
    """SQL for the array of squared distances to the centres."""
    return f"array({', '.join(f'(lat - ({lat!r}D)) * (lat - ({lat!r}D)) + (lon - ({lon!r}D)) * (lon - ({lon!r}D))' for lat, lon in centres)})"


def _position(distances: str, least: str) -> str:
    """SQL for the index of the smallest entry (the smaller index on ties; 0 without coordinates)."""
    return f"cast(coalesce(array_position({distances}, {least}), 1) - 1 as int)"


def assign_centroid(coordinates: DataFrame, centroids: Sequence[Point]) -> DataFrame:
    """Adds ``cluster``, the index of the nearest centroid (the smaller one on ties)."""
    if not centroids:
        return coordinates.selectExpr("*", "cast(null as int) as cluster")
    return coordinates.selectExpr("*", f"{_distances(centroids)} as _d").selectExpr("*", f"{_position('_d', 'array_min(_d)')} as cluster").drop("_d")


def assign_centroid_table(coordinates: DataFrame, centroids: DataFrame) -> DataFrame:
    """The same with the centres in a table of (cluster, lat, lon); all of them go into one array."""
    packed = centroids.selectExpr("sort_array(collect_list(struct(cluster, lat, lon))) as c").scalar()
    d = "(lat - x.lat) * (lat - x.lat) + (lon - x.lon) * (lon - x.lon)"
    return coordinates.withColumn("_c", packed).selectExpr(
        "*", f"array_min(transform(_c, x -> struct({d} as d, x.cluster as cluster))).cluster as cluster").drop("_c")


def unseen_keys(keys: DataFrame, known: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """Distinct keys without a zone yet."""
    return keys.select(sp.key).distinct().join(known.select(sp.key).distinct(), sp.key, "left_anti")

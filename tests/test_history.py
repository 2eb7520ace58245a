"""Fallback rules on small tables, computed row by row in plain Python."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest

from slotcast.plans import history as H
from slotcast.plans import target_day
from slotcast.plans.feature_matrix import build_features, feature_matrix
from slotcast.session import materialize

EPS = 1e-9


def mean(xs):
    return sum(xs) / len(xs)


class Naive:
    """The rules for one table: (key, day, slot, value) training rows and (key, day, slot) rows to predict."""

    def __init__(self, train, test, neighbors):
        self.h = [r for r in train if r[1] == 48]
        cells, slots, keys, hours = (defaultdict(list) for _ in range(4))
        for k, _, s, v in self.h:
            cells[k, s].append(v)
            slots[s].append(v)
            keys[k].append(v)
            hours[k, s // 60].append(v)
        self.prof = {c: mean(v) for c, v in cells.items()}
        self.slot = {s: mean(v) for s, v in slots.items()}
        self.key = {k: mean(v) for k, v in keys.items()}
        self.hours = hours
        self.all = mean([r[3] for r in self.h])
        self.cold = {r[0] for r in test} - {r[0] for r in train}
        self.neighbors = neighbors

    def slot_mean(self, s):
        return self.slot.get(s, self.all)

    def nb(self, k, s):
        found = [self.prof[n, s] for n in self.neighbors.get(k, []) if (n, s) in self.prof]
        return mean(found) if found else None

    def genuine(self, k, s):
        if (k, s) in self.prof:
            return self.prof[k, s]
        if k in self.cold and self.nb(k, s) is not None:
            return self.nb(k, s)
        return self.slot_mean(s)

    def proxy(self, k, s):
        around = [self.prof[k, t] for t in (s - 15, s + 15) if (k, t) in self.prof]
        return mean(around) if around else self.key.get(k, self.slot_mean(s))

    def nearby(self, k, s):
        left = self.all if s < 15 else self.genuine(k, s - 15)
        return (left + self.genuine(k, s + 15)) / 2

    def lag(self, k, s, minutes):
        return self.key.get(k, self.all) if s + minutes < 0 else self.genuine(k, s + minutes)

    def spatial(self, k, s):
        found = self.nb(k, s)
        return self.slot_mean(s) if found is None else found

    def hour(self, k, s, own=None):
        values = self.hours.get((k, s // 60), [])
        fallback = self.key.get(k, self.all)
        if own is None:
            return mean(values) if values else fallback
        return (sum(values) - own) / (len(values) - 1) if len(values) > 1 else fallback


def check(spark, observed, train, test):
    train_df = observed(train)
    test_df = observed([(*r, None) for r in test], value=False).selectExpr("Index + 100000 as Index", *[
        c for c in observed([(*test[0], None)], value=False).columns if c != "Index"])
    got = {r["Index"]: r for r in H.history_features(train_df, test_df).collect()}
    assert len(got) == len(train) + len(test)
    keys = H.key_classes(H.stack_rows(train_df, test_df))
    neighbors = defaultdict(list)
    for e in H.neighbor_edges(keys).orderBy("geohash", "rank").collect():
        neighbors[e["geohash"]].append(e["neighbor"])
    n = Naive(train, test, neighbors)
    rows = [(i, *r) for i, r in enumerate(train)] + [(100000 + i, *r, None) for i, r in enumerate(test)]
    for i, k, day, s, v in rows:
        own = v is not None and day == 48
        want = {
            "demand_d48_same_slot": n.proxy(k, s) if own else n.genuine(k, s),
            "demand_d48_nearby_slots": n.nearby(k, s),
            "demand_d48_slot_m60": n.lag(k, s, -60), "demand_d48_slot_m30": n.lag(k, s, -30),
            "demand_d48_slot_p30": n.lag(k, s, 30), "demand_d48_slot_p60": n.lag(k, s, 60),
            "demand_d48_spatial_neighbor_slot": n.spatial(k, s),
            "demand_d48_geohash_mean": n.key.get(k, n.slot_mean(s)),
            "demand_d48_gh_hour_mean": n.hour(k, s, v if own else None),
            "slot_shape": n.slot[s] / (n.all + EPS) if s in n.slot else 1.0,
        }
        want["log_demand_d48_same_slot"] = math.log(max(want["demand_d48_same_slot"], EPS))
        for c, x in want.items():
            assert got[i][c] == pytest.approx(x, rel=1e-9), (k, day, s, c)
    return got, n


CLASSES = [("qp0000", 48, s, 0.1 + s / 10000) for s in (0, 15, 30, 60, 1410, 1425)] + [
    ("qp0001", 48, 0, 0.5), ("qp0002", 48, 720, 0.7), ("qp0003", 48, 15, 0.2), ("qp0009", 49, 0, 0.4)]


def test_key_classes_and_day_edges(spark, observed):
    test = [(k, 49, s) for k in ("qp0000", "qp0009", "qp000z") for s in (0, 15, 30, 45, 700, 1410, 1425)]
    got, n = check(spark, observed, CLASSES, test)
    assert {r["key_class"] for r in got.values()} == {"warm", "target_only", "cold"}
    # the key with one row: no spread, rank 1, no differences
    one = got[6]
    assert one["demand_d48_geohash_std"] == 0 and one["demand_d48_rank_in_day"] == 1.0
    assert one["demand_d48_velocity"] == 0 and one["demand_d48_acceleration"] == 0


def test_random_table_with_repeated_rows_in_a_hot_key(spark, observed):
    rng = random.Random(11)
    keys = [f"qp{a}{b}00" for a in "0123" for b in "019"]
    train = [(rng.choice(keys[:9]), rng.choice([48, 48, 48, 49]), rng.randrange(0, 1440, 15), round(rng.random(), 6) + 0.01)
             for _ in range(250)]
    # a third of all rows in one key, many of them in the same slots
    train += [(keys[0], 48, rng.choice([0, 15, 45, 600]), round(rng.random(), 6) + 0.01) for _ in range(150)]
    test = [(rng.choice(keys), 49, rng.randrange(0, 1440, 15)) for _ in range(80)]
    check(spark, observed, train, test)


def test_velocity_skips_rows_not_minutes(spark, observed):
    values = [0.1, 0.2, 0.4, 0.8, 0.9, 0.3]
    slots = [0, 15, 60, 75, 600, 615]
    rows = [("qp0000", 48, s, v) for s, v in zip(slots, values)]
    test = [("qp0000", 49, s) for s in slots]
    got = [r for r in H.history_features(
        observed(rows), observed([(*t, None) for t in test], value=False)).where("is_test").orderBy("Index").collect()]
    vel = [0, 0] + [values[i] - values[i - 2] for i in range(2, 6)]
    acc = [0, 0, 0, 0] + [vel[i] - vel[i - 2] for i in range(4, 6)]
    assert [r["demand_d48_velocity"] for r in got] == pytest.approx(vel)
    assert [r["demand_d48_acceleration"] for r in got] == pytest.approx(acc)


def test_rank_averages_ties(spark, observed):
    rows = [("qp0000", 48, 15 * i, v) for i, v in enumerate([0.3, 0.1, 0.3, 0.5])]
    got = H.history_features(observed(rows), observed([("qp0000", 49, 0, None)], value=False)).where("not is_test")
    assert [r["demand_d48_rank_in_day"] for r in got.orderBy("Index").collect()] == [2.5 / 4, 1 / 4, 2.5 / 4, 1.0]


def test_no_target_day(spark, observed):
    rows = [("qp0000", 48, 0, 0.3), ("qp0001", 48, 15, 0.2)]
    test = observed([("qp0000", 49, 0, None)], value=False)
    out = target_day.target_day_features(observed(rows), test).collect()
    assert {(r["demand_d49_morning_mean"], r["demand_d49_last_known"]) for r in out} == {(0.0, 0.0)}


def test_target_day_rules(spark, observed):
    rows = [("a", 49, 0, 0.2), ("a", 49, 30, 0.6), ("b", 49, 15, 0.4), ("c", 48, 0, 0.9)]
    test = observed([("a", 49, 300, None), ("z", 49, 300, None)], value=False).selectExpr(
        "Index + 100 as Index", *[c for c in observed(rows, value=False).columns if c != "Index"])
    out = {r["Index"]: (r["demand_d49_morning_mean"], r["demand_d49_last_known"])
           for r in target_day.target_day_features(observed(rows), test).collect()}
    overall = (0.2 + 0.6 + 0.4) / 3
    assert out[0] == pytest.approx((0.6, 0.6)) and out[1] == pytest.approx((0.2, 0.6))
    assert out[2] == pytest.approx((overall, 0.4)) and out[3] == pytest.approx((overall, overall))
    assert out[100] == pytest.approx((0.4, 0.6)) and out[101] == pytest.approx((overall, overall))


def test_temperature_levels_and_no_nulls(spark, observed):
    rows = [("qp0000", 48, 0, 0.1), ("qp0000", 48, 15, 0.2), ("qp0000", 48, 30, 0.2), ("qp0000", 48, 600, 0.3),
            ("qp0001", 48, 0, 0.4), ("qp0000", 49, 0, 0.2)]
    train = observed(rows, temperature=[10.0, 20.0, None, None, None, 14.0])
    test = observed([("qp000z", 49, 0, None)], value=False)
    built = build_features(train, test)
    got = [r["Temperature"] for r in built.where("not is_test").orderBy("Index").collect()]
    assert got == [10.0, 20.0, 14.0, 14.0, 14.0, 14.0]
    matrix = feature_matrix(built)
    assert matrix.dropna(subset=[c for c in matrix.columns if c != "fold"]).count() == 7
    assert "demand" not in matrix.columns


def test_the_overall_row_is_not_carried_through_the_explode(observed):
    rows = observed([("qp0000", 48, 0, 0.1), ("qp0000", 48, 15, 0.3), ("qp0001", 48, 15, 0.2), ("qp0001", 49, 30, 0.2)])
    grid = H.observation_grid(H.stack_rows(rows, rows.where("false").drop("demand")))
    prof = H.profile_of(grid)
    wide = materialize(H.entities(rows.where("day = 48"), prof, H.key_classes(grid), H.needs_of(["profile_or_slot"])))
    cell = H.cells(wide, prof, ["profile_or_slot"])
    plan = cell.where("minute_of_day is not null")._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" not in plan[plan.index("Generate explode"):]
    got = {(r["geohash"], r["minute_of_day"]): r["profile_or_slot"] for r in cell.collect()}
    assert got == {("qp0000", 0): pytest.approx(0.1), ("qp0000", 15): pytest.approx(0.3), ("qp0001", 15): pytest.approx(0.2),
                   ("qp0001", 30): pytest.approx(0.2)}

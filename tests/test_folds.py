"""Group folds against a packing by hand, and their balance."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from slotcast.operators import encoding, folds


def frame(spark, counts):
    rows = [(k, i) for k, n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, "geohash string, i int").repartition(5)


def packed(counts, n_folds):
    loads, out = [0] * n_folds, {}
    for k, n in sorted(counts.items(), key=lambda c: (-c[1], c[0] is not None, c[0])):
        fold = loads.index(min(loads))
        loads[fold] += n
        out[k] = fold
    return out


@pytest.mark.parametrize("n_folds", [1, 2, 5])
def test_large_keys_are_packed_one_by_one(spark, n_folds):
    rng = random.Random(n_folds)
    counts = {f"k{i:02}": rng.randint(1, 30) for i in range(40)} | {"hot": 300, None: 12}
    got = {r["geohash"]: (r["n"], r["fold"]) for r in folds.balanced_folds(frame(spark, counts), "geohash", n_folds).collect()}
    assert got == {k: (counts[k], f) for k, f in packed(counts, n_folds).items()}


@pytest.mark.parametrize("counts", [
    {f"k{i}": 1 + i % 3 for i in range(500)}, {"hot": 400, **{f"k{i}": 1 + i % 3 for i in range(300)}},
    {"a": 90, "b": 60, **{f"k{i}": 1 for i in range(200)}}])
def test_small_keys_fill_the_folds(spark, counts):
    rows = folds.balanced_folds(frame(spark, counts), "geohash", 5, one_by_one=4).collect()
    assert {r["geohash"]: r["n"] for r in rows} == counts and len(rows) == len(counts)
    sizes, total = Counter(), sum(counts.values())
    for r in rows:
        sizes[r["fold"]] += r["n"]
    small = total / 20
    assert max(sizes.values()) <= max(total / 5, max(counts.values())) + small
    others = [sizes[f] for f in range(5) if sizes[f] <= total / 5 + small]
    assert max(others) - min(others) <= 2 * small


def test_levels():
    assert folds.fill_levels([0, 0, 0], 7) == [3, 5, 7]
    assert folds.fill_levels([10, 0, 4], 3) == [0, 3, 3]
    assert folds.fill_levels([10, 0, 4], 10) == [0, 7, 10]
    assert folds.fill_levels([1, 5, 2], 9) == [5, 6, 9] and folds.fill_levels([3], 2) == [2]


def test_no_rows_and_joined_folds(spark):
    assert folds.balanced_folds(frame(spark, {}), "geohash").collect() == []
    rows = frame(spark, {"a": 4, "b": 3, None: 2})
    joined = folds.with_folds(rows, folds.balanced_folds(rows, "geohash", 2), "geohash").collect()
    assert len(joined) == 9 and len({(r["geohash"], r["fold"]) for r in joined}) == 3


def test_encodings_of_a_group_fold_do_not_see_its_keys(spark):
    rows = spark.createDataFrame([(f"k{i % 6}", "p", float(i % 6)) for i in range(60)], "geohash string, px string, y double")
    rows = folds.with_folds(rows, folds.balanced_folds(rows, "geohash", 3), "geohash")
    got = encoding.foldsafe_te(rows, rows, ["px"], "y", 3, 0.0).select("geohash", "fold", "te").distinct().collect()
    for r in got:
        other = [float(k[1:]) for k in {x["geohash"] for x in got if x["fold"] != r["fold"]}]
        assert r["te"] == pytest.approx(sum(other) / len(other))

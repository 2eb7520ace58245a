"""Mode imputation: ties, levels, groups without a value, one very frequent group."""

from __future__ import annotations

from collections import Counter

from slotcast.operators import impute

SCHEMA = "Index bigint, geohash string, day int, Weather string"


def plain(train, rows, levels):
    def mode(found):
        counts = Counter(r[3] for r in found if r[3] is not None)
        return min(counts, key=lambda v: (-counts[v], v)) if counts else None

    out = {}
    for r in rows:
        value = r[3]
        for by in levels:
            if value is None:
                value = mode([t for t in train if all(t[i] == r[i] for i in by)])
        out[r[0]] = value
    return out


def test_modes_level_by_level(spark):
    train = [(i, f"k{i % 5}", 48 + i % 2, ["Sunny", "Rainy", None, "Foggy"][(i * 7 + i // 5) % 4]) for i in range(200)]
    train += [(1000 + i, "hot", 48, "Snowy" if i % 2 else "Rainy") for i in range(500)]
    train += [(2000 + i, "bare", 49, None) for i in range(3)]
    rows = train + [(3000, "k1", 50, None), (3001, "new", 48, None), (3002, "new", 48, "Kept"), (3003, "hot", 49, None), (3004, "bare", 48, None)]
    df, every = spark.createDataFrame(train, SCHEMA), spark.createDataFrame(rows, SCHEMA)
    got = impute.impute_mode(df, every, "Weather", [["geohash", "day"], ["geohash"], []])
    assert got.columns == every.columns
    assert {r["Index"]: r["Weather"] for r in got.collect()} == plain(train, rows, [(1, 2), (1,), ()])
    by_key = impute.impute_mode(df, every, "Weather", [["geohash"]])
    assert {r["Index"]: r["Weather"] for r in by_key.collect()} == plain(train, rows, [(1,)])


def test_no_known_value_and_no_rows(spark):
    none = spark.createDataFrame([(1, "a", 48, None)], SCHEMA)
    levels = [["geohash", "day"], ["geohash"], []]
    assert impute.impute_mode(none, none, "Weather", levels).first()["Weather"] is None
    assert impute.impute_mode(none, none.where("false"), "Weather", levels).count() == 0
    null_key = spark.createDataFrame([(1, None, 48, None), (2, None, 48, "x"), (3, "a", 48, "y"), (4, "a", 48, "y")], SCHEMA)
    assert impute.impute_mode(null_key, null_key, "Weather", levels).where("Index = 1").first()["Weather"] == "y"

"""Nearest neighbours against a comparison of every query with every row."""

from __future__ import annotations

import numpy as np
import pytest

from slotcast.llm import cross_polytope as C
from slotcast.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, id string, score int"  # extra columns with clashing names
NAN, INF = float("nan"), float("inf")


def plain(rows, k=5, asks=lambda i: i % 50 == 0):
    """(query, rank, id, score) by comparing everything; rows are (id, vector)."""
    best = {}
    for i, v in rows:
        if i is None or not v or any(c is None or not np.isfinite(c) for c in v) or not any(v):
            continue
        best[i] = min(best.get(i, v), v)
    out = []
    for q, v in best.items():
        if not asks(q):
            continue
        v, near = np.array(v, float), []
        for i, w in best.items():
            w = np.array(w, float)
            if i != q and len(w) == len(v):
                near.append((-(v @ w) / np.sqrt((v @ v) * (w @ w)), i))
        near.sort(key=lambda p: (round(p[0], 12), p[1]))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(near[:k])]
    return out


def compare(found, wanted):
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in found)
    assert got == sorted(w[:3] for w in wanted)
    scores = {w[:2]: w[3] for w in wanted}
    assert all(abs(r["score"] - scores[r["query_id"], r["rank"]]) < 1e-12 for r in found)


def test_awkward_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=3).astype(np.float32).tolist()) for i in range(60)]
    rows += [(0, rows[0][1])] * 3 + [(7, [9.0, 9.0, 9.0]), (100, rows[3][1]), (150, rows[3][1]), (61, [1e30, 2e30, -1e30])]
    rows += [(None, [1.0, 2.0, 3.0]), (200, None), (201, []), (202, [0.0, 0.0, 0.0]), (203, [1.0, None, 2.0]), (250, [NAN, 1.0, 2.0]),
             (251, [INF, 1.0, 2.0]), (300, [1.0, 2.0]), (301, [2.0, 1.0]), (350, [5.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    compare(C.nearest(df, "id % 50 = 0", recall=1.0, sample=100).collect(), plain(rows))


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 0.0])], [(1, [1.0, 0.0]), (2, [0.0, 1.0])], [(0, [1.0, 0.0]), (3, [-1.0, 0.0]), (2, [0.5, 0.5])]])
def test_few_rows(spark, rows):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = C.nearest(df, "id % 50 = 0")
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    compare(found.collect(), plain(rows))


def test_copies_and_split_cells(spark, monkeypatch):
    """One vector is a third of all rows, cells are split, codes have two hashes, lists are filled up by a second search."""
    monkeypatch.setattr(C, "CELL_VALUES", 64)
    monkeypatch.setattr(C, "CODE_ROWS", 4)
    rng = np.random.default_rng(6)
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 3 == 0 else rng.normal(size=4).astype(np.float32).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    index = C.build(df, "id % 50 = 0", recall=1.0)
    assert index.hashes == 3
    compare(C.search(index, "id % 50 = 0").collect(), plain(rows))
    few = C.Index(index.rows, index.hashes, index.width, index.tables, index.seed, 1)
    again = C.search(few, "id % 50 = 0").collect()
    assert len(again) == 60 and all(r["rank"] <= 5 for r in again)


def test_recall_of_the_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    wanted = {w[:2]: w[2:] for w in plain(rows)}
    found = QUERIES["op12_nearest"](spark, folder).collect()
    true = {(q, i) for (q, _), (i, _) in wanted.items()}
    assert len(found) == len(true)
    assert sum((r["query_id"], r["vec_id"]) in true for r in found) / len(true) >= 0.9
    assert all(r["score"] <= wanted[r["query_id"], r["rank"]][1] + 1e-12 for r in found)


def test_rotation_and_probing_order():
    x = np.random.default_rng(7).normal(size=(50, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = C.rotated(x, 3, 0, 0)
    assert np.allclose(y @ y.T, x @ x.T)
    h = C.hadamard(np.eye(64))
    assert (abs(h) == 1).all() and np.allclose(h @ h.T, 64 * np.eye(64))
    for hashes in (1, 2):
        order = C.probing_order(x, 1, 500, (hashes, 2, 3))
        assert (order[:, 0] == C.codes(x, (hashes, 2, 3))[:, 1]).all()
        assert all(len(set(o)) == len(o) for o in order.tolist())

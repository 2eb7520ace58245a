"""Benchmark windows against a plain scan of every position."""

from __future__ import annotations

import re

import pytest

from slotcast.llm import decontaminate as dc

SCHEMA = "doc_id bigint, text string, item_id int, pos int, words string, id int"  # extra columns with clashing names
W = "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ITEMS = [(1, "The quick brown fox jumps over the lazy dog again and again."), (2, "short item here"), (3, None), (4, "..."),
         (5, "Éa b2 c-d\ne f g h i j k"), (10, "the QUICK brown fox jumps over the lazy dog again"), (None, "lonely"), (2, "other text of two")]
DOCS = [(1, "x THE quick, brown fox jumps over the lazy dog again y"), (2, "short Item; here short item here"), (3, None), (4, ""),
        (5, "éa B2"), (5, "Éa b2 c d e f g h i j k l"), (None, "short item here"), (None, "short item here"), (6, "nothing at all"),
        (7, "the quick brown fox jumps over the lazy dog again and again " * 400), (8, "lonely lonely"), (9, "word " * 40_000 + "short item here")]


def low(text):
    return re.findall(W, (text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain(text, items):
    words, hit, found = low(text), set(), set()
    for item, body in items:
        w = low(body)
        n = min(10, len(w))
        windows = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i:i + n]) in windows:
                hit.update(range(i, i + n))
                found.add("" if item is None else str(item))
    return len(words), hit, sorted(found)


@pytest.fixture(scope="module")
def tables(spark):
    return (spark.createDataFrame([(i, t, 0, 1, "w", 2) for i, t in DOCS], SCHEMA),
            spark.createDataFrame(ITEMS, "item_id int, text string"))


@pytest.mark.parametrize("limit", [dc.BROADCAST_BYTES, 0])
def test_equals_plain_scan(tables, limit, monkeypatch):
    monkeypatch.setattr(dc.window_hits, "__defaults__", (*dc.window_hits.__defaults__[:-1], limit))
    got = [tuple(r) for r in dc.contamination(*tables).collect()]
    want = []
    for i, text in DOCS:
        n, hit, found = plain(text, ITEMS)
        want.append((i, n, len(hit), len(found), found, bool(hit)))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_remove(tables):
    docs, items = tables
    kept = dc.remove_documents(docs, items)
    assert kept.schema == docs.schema
    want = [(i, t) for i, t in DOCS if not plain(t, ITEMS)[1]]
    assert sorted([(r[0], r[1]) for r in kept.collect()], key=repr) == sorted(want, key=repr)
    cut = dc.remove_spans(docs, items)
    assert cut.columns == docs.columns and cut.count() == len(DOCS)
    by_text = {(i, t): t for i, t in DOCS}
    for r in cut.collect():
        assert not any(set(low(t)) and low(t) == low(r["text"]) for t in ("short item here", "lonely"))
    texts = [r["text"] for r in cut.collect()]
    assert "x  ,         y" in texts and "nothing at all" in texts and len(by_text) == 11


def test_empty_tables(tables):
    docs, items = tables
    assert {(r["n_hit"], r["contaminated"]) for r in dc.contamination(docs, items.where("false")).collect()} == {(0, False)}
    assert dc.contamination(docs.where("false"), items).count() == 0
    assert dc.remove_documents(docs, items.where("false")).count() == len(DOCS)


def test_beyond_the_size_a_merge_join_carries_single_windows(spark, tables):
    docs, items = tables
    hits = dc.window_hits(docs, items, broadcast_bytes=0)
    hits.count()
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    exchanges = [line for line in plan.split("\n") if "Project" in line and "here#" in line]
    assert exchanges and not any("words#" in line.split("[", 1)[1].split("AS here")[0].split("slice(")[0] for line in exchanges[:1])


def test_marks_follow_the_benchmark(spark):
    few = dc.item_windows(spark.createDataFrame([(1, "a b c")], "item_id int, text string"))
    many = dc.item_windows(spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(300))) for i in range(70)], "item_id int, text string"))
    assert dc._marks(few)[1] == dc.MARK_BITS and sum(dc._marks(few)[0]) == 1
    marks, bits = dc._marks(many)
    assert bits == 19 and len(marks) == 1 << 19 and sum(marks) > 19_000

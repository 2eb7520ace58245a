"""Near-duplicate join against all pairs compared plainly."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from slotcast.llm import components, ngram_join

SCHEMA = "doc_id bigint, text string, class_id string, node int, id int"  # extra columns with clashing names


def plain(rows, n=5, threshold=(8, 10)):
    """(class id, links) per row, in order."""
    sets = []
    for _, text in rows:
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        sets.append({tuple(words[i:i + n]) for i in range(max(len(words) - n + 1, 1))} if words else set())
    linked = [[j for j, b in enumerate(sets) if i != j and a and threshold[1] * len(a & b) >= threshold[0] * len(a | b)]
              for i, a in enumerate(sets)]
    out = []
    for i in range(len(rows)):
        seen, stack = {i}, [i]
        while stack:
            for j in linked[stack.pop()]:
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((min(ids, default=None), len(linked[i])))
    return out


def build(spark, rows):
    return spark.createDataFrame([(i, t, "c", 1, 2) for i, t in rows], SCHEMA)


def compare(spark, rows, **options):
    got = ngram_join.near_duplicates(build(spark, rows), **options).collect()
    want = plain(rows)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted([(r["doc_id"], r["class_id"], r["n_links"]) for r in got], key=key) == sorted(
        [(i, *w) for (i, _), w in zip(rows, want)], key=key)
    return want


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10 ** 9)}"
    return " ".join(words)


def make_rows():
    rng = random.Random(4)
    rows = [(0, None), (1, ""), (2, " .,!"), (3, "One two"), (4, "one  TWO!"), (5, "one two three"), (None, "one two"),
            (6, "a b c d e"), (7, "A, b; c d e."), (8, "a b c d e f"), (None, None), (8, "é É x y z"), (9, "é É x y z")]
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    rows += [(100 + i, edited(rng, base, rng.randrange(5))) for i in range(60)]
    rows += [(300 + i, " ".join(base)) for i in range(5)] + [(300, " ".join(base))]
    other = [f"v{rng.randrange(5000)}" for _ in range(40)]
    rows += [(400 + i, " ".join(other) + " " + " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(60))) for i in range(40)]
    rows.append((500, "w " * 50_000))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("options", [{}, {"block_nodes": 4}, {"block_grams": 300}])
def test_equals_all_pairs(spark, options):
    compare(spark, make_rows(), **options)


def test_given_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert max(n for _, n in compare(spark, rows)) > 0


def test_keep_one(spark):
    rows = make_rows()
    docs = build(spark, rows)
    kept = ngram_join.keep_one(docs)
    assert kept.schema == docs.schema
    got = sorted((r["doc_id"] is not None, r["doc_id"], r["text"]) for r in kept.where("text IS NOT NULL").collect())
    classes = {}
    for (i, text), (c, _) in zip(rows, plain(rows)):
        if text and re.search("[0-9A-Za-z\x80-\U0010FFFF]", text):
            classes.setdefault(c, []).append((i, text))
    stay = [x for x in got if re.search("[0-9A-Za-z\x80-\U0010FFFF]", x[2])]
    # One row per class; id 8 names two unlike texts, one of which shares a class with id 9.
    assert len(stay) == len({(c, members[0][1][:1] == "é") for c, members in classes.items()}) + sum(
        len({t[:1] == "é" for _, t in members}) - 1 for members in classes.values())
    assert all((x[1] if x[0] else None) in classes for x in stay)
    assert kept.where("text IS NULL").count() == 2 and kept.where("text = ''").count() == 1
    assert ngram_join.keep_one(docs.where("false")).count() == 0


def test_bands_reach_the_recall():
    bands = ngram_join.bands_for(0.8, 0.9999, 6)
    assert 1 - (1 - 0.8 ** 6) ** bands >= 0.9999 > 1 - (1 - 0.8 ** 6) ** (bands - 1)


def test_minhash_agreement_follows_the_similarity():
    rng = np.random.default_rng(0)
    from slotcast.llm import textops as T

    agree, pairs = [], 200
    for _ in range(pairs):
        union = T.mix(rng.integers(0, 1 << 62, 100).astype(T.U64))
        a, b = union[:90], union[10:]
        grams = np.concatenate([a, b])
        found = ngram_join._band_hashes(grams, np.array([0, 90, 180]), np.array([0, 1]), 60, 1)
        agree.append((found[0] == found[1]).mean())
    assert abs(np.mean(agree) - 0.8) < 0.02


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)],
                                   [(5, 3), (3, 5), (9, 8), (8, 3), (20, 21)]])
def test_components(spark, edges):
    found = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert found == label

"""Packing: tokens against the tokenizer, covers, padding, awkward rows."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from slotcast.llm import packing, tokens

SCHEMA = "doc_id bigint, text string, sequence_id string, length int"  # extra columns with clashing names

AWKWARD = [None, "", " ", "a  b", "\n\nfoo", "foo \n", "it's we'll 'sun x'd I've 's \n'sx '' ''s !'s", "  'll", "x\x1cy\x1f z",
           "日本語 テキスト 123", "½ ² 1२३", "<|endoftext|> a", "😀😀 a", "᠎​ x", "éa", "'", "don'", "'re 've a'S",
           "ሀ ᏸ Ꭰ 𞤀", "  \t\n  x", "word " * 30_000]


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokens.default_path())


def encoded(encoder, texts):
    return [ids[b[r]:b[r + 1]].tolist() for first, past, ids, b in encoder.encode(pa.array(texts, pa.string()))
            for r in range(past - first)]


def plain(encoder, texts):
    return [e.ids for e in encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_ids_equal_tokenizer(encoder, spark, sf_dir):
    texts = AWKWARD + [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    assert encoded(encoder, texts) == plain(encoder, texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'stremvld  \n\t1²é!日  "), max_size=12), max_size=4))
def test_ids_equal_tokenizer_on_any_text(encoder, texts):
    assert encoded(encoder, texts) == plain(encoder, texts)


def test_ids_equal_the_file_as_given(encoder):
    from tokenizers import Tokenizer

    end = "<|endoftext|>"
    texts = [f"ab {end} cd", end, end * 3, f"{end}\n", "ab <|endoftext| > cd", "a <|endof", "text|> b", None, f"é{end}日本", "plain", f"don't{end}'s"]
    fresh = Tokenizer.from_file(tokens.default_path())
    want = [fresh.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert want[0] == [397, 220, 50256, 22927]
    assert encoded(encoder, texts) == want and [encoded(encoder, [t])[0] for t in texts] == want


def test_best_pattern_is_the_knapsack_optimum():
    rng = np.random.default_rng(0)
    for _ in range(20):
        value = rng.uniform(-1, 1, 12)
        best = [0.0] * 13
        for room in range(1, 13):
            best[room] = max(best[room - 1], *(value[k] + best[room - k - 1] for k in range(room)))
        worth, pattern = packing.best_pattern(value, 12)
        assert abs(worth - best[12]) < 1e-9 and abs(pattern @ value - worth) < 1e-9
        assert pattern @ np.arange(1, 13) <= 12


@pytest.mark.parametrize("seed", [1, 2])
def test_patterns_cover_every_piece_and_come_close_to_the_bound(seed):
    rng = np.random.default_rng(seed)
    demand = np.rint(4000 * np.exp(-np.arange(64) / 30) * rng.uniform(0.5, 1, 64)).astype(int) * (rng.random(64) < 0.8)
    patterns = packing.whole_patterns(demand)
    assert (sum(p * n for p, n in patterns) == demand).all()
    assert all(p @ np.arange(1, 65) <= 64 for p, _ in patterns)
    volume = demand @ np.arange(1, 65) / 64
    assert sum(n for _, n in patterns) <= 1.005 * volume + 20
    assert packing.whole_patterns(np.zeros(8, int)) == []


def check(rows, texts, encoder):
    ids = {}
    for (i, _), t in zip(texts, plain(encoder, [t for _, t in texts])):
        ids.setdefault(i, []).append(t + [packing.END])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids)
    for i, found in by_doc.items():
        want = Counter()
        for whole in ids[i]:
            for s in range(0, len(whole), 2048):
                part = whole[s:s + 2048]
                want[s, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(whole)] += 1
        assert Counter((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in found) == want
    for found in by_sequence.values():
        at = 0
        for r in sorted(found, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    return sum(r["length"] for r in rows) / (2048 * len(by_sequence))


def test_pack_documents(spark, encoder, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = packing.pack_documents(docs).collect()
    assert check(rows, [tuple(r) for r in docs.collect()], encoder) > 0.97


def test_awkward_rows(spark, encoder):
    data = [(i, t) for i, t in enumerate(AWKWARD)] + [(None, "a"), (None, None), (3, "a  b"), (3, "other")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in data], SCHEMA)
    check(packing.pack_documents(docs).collect(), data, encoder)
    assert packing.pack_documents(docs.where("false")).count() == 0


def test_short_pieces_are_not_padded(spark, encoder):
    null = spark.createDataFrame([(i, None, "x", 1) for i in range(3000)], SCHEMA)
    rows = packing.pack_documents(null).collect()
    assert check(rows, [(i, None) for i in range(3000)], encoder) > 0.7 and len({r["sequence_id"] for r in rows}) == 2
    rng = np.random.default_rng(1)
    texts = [(i, " ".join(["word"] * int(n))) for i, n in enumerate(rng.integers(0, 40, 4000))]
    mixed = spark.createDataFrame([(*t, "x", 1) for t in texts], SCHEMA)
    assert check(packing.pack_documents(mixed).collect(), texts, encoder) > 0.97


def test_bundles():
    assert packing.bundles({3: 10, 129: 4}, 512, 8) == [(3, 8, 1, 3, 1), (129, 3, 1, 49, 17)]
    assert packing.bundles({1: 1000, 200: 5, 256: 1}, 512, 8) == [(1, 8, 125, 1, 0), (200, 1, 5, 25, 0), (256, 1, 1, 32, 0)]


def test_a_class_is_ranked_in_parts(spark, encoder, monkeypatch):
    monkeypatch.setattr(packing, "PART_ROWS", 7)
    texts = [(i, ["same text", "some other text of nine words, more or less", None][i % 3]) for i in range(400)]
    docs = spark.createDataFrame([(*t, "x", 1) for t in texts], SCHEMA)
    assert check(packing.pack_documents(docs, bundle=64).collect(), texts, encoder) > 0.7

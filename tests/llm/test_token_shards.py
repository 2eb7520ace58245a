"""Training order: the permutation, round trips through the shards, resuming, awkward rows."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from slotcast.llm import token_shards, tokens

SCHEMA = "doc_id bigint, text string, slot int, ids string"


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 1 << 40))
def test_permutation(n, key):
    order = token_shards.Permutation(n, key)
    slots = order.slot(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert (order.index(slots) == np.arange(n)).all()


def test_keys_give_unlike_orders():
    a, b = (token_shards.Permutation(5000, k).slot(np.arange(5000)) for k in (1, 2))
    assert (a == b).mean() < 0.01 and (np.diff(a) == 1).mean() < 0.01


def joined(spark, docs, tmp_path, stride, per_shard):
    made = token_shards.write(docs, str(tmp_path / "out"), key=3, stride=stride, per_shard=per_shard)
    rows = {r["slot"]: r for r in token_shards.index(spark, made).collect()}
    ids = {r["slot"]: np.frombuffer(r["ids"], made["dtype"]).astype(int).tolist() for r in token_shards.read(spark, made).collect()}
    assert sorted(rows) == sorted(ids) == list(range(made["sequences"]))
    assert all(r["shard"] == s // per_shard and r["offset"] == s % per_shard * stride * 2 for s, r in rows.items())
    ordered = sorted(rows.values(), key=lambda r: r["index"])
    assert [r["index"] for r in ordered] == list(range(len(rows)))
    return made, rows, ids, [i for r in ordered for i in ids[r["slot"]][:r["n_tokens"]]]


def plain(texts):
    encoder = tokens.Encoder(tokens.default_path())
    return [e.ids + [1] for e in encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("stride,per_shard", [(64, 100), (2048, 7)])
def test_round_trip(spark, tmp_path, sf_dir, stride, per_shard):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    made, rows, ids, stream = joined(spark, docs, tmp_path, stride, per_shard)
    lists = plain([r["text"] for r in docs.select("text").collect()])
    assert stream == [i for one in lists for i in one]  # one input partition: the documents in a row
    at = 0
    owner = []
    for r, one in zip(docs.select("doc_id").collect(), lists):
        owner += [r["doc_id"]] * len(one)
    for r in sorted(rows.values(), key=lambda r: r["index"]):
        assert r["doc_ids"] == list(dict.fromkeys(owner[at:at + r["n_tokens"]]))
        at += r["n_tokens"]
    part = {r["slot"]: np.frombuffer(r["ids"], made["dtype"]).astype(int).tolist()
            for r in token_shards.read(spark, made, start=5, stop=made["sequences"] - 2).collect()}
    assert part == {s: ids[s] for s in range(5, made["sequences"] - 2)}


def test_awkward_rows(spark, tmp_path):
    data = [(1, None), (2, ""), (None, "a b"), (1, "a b"), (1, "a b"), (3, "word " * 9000)]
    docs = spark.createDataFrame([(i, t, 0, "") for i, t in data], SCHEMA).repartition(5)
    _, rows, _, stream = joined(spark, docs, tmp_path, 16, 50)
    assert sorted(stream) == sorted(i for one in plain([t for _, t in data]) for i in one)
    empty = token_shards.write(docs.where("false"), str(tmp_path / "none"), key=1)
    assert empty["sequences"] == 0 and token_shards.read(spark, empty).count() == token_shards.index(spark, empty).count() == 0

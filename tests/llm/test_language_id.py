"""Language codes: distances, decoding against a plain loop, held-out accuracy, awkward rows."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest

from slotcast.llm import language_id
from slotcast.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, lang string, id string, body string, lang_pred int"


@pytest.mark.parametrize("languages", [2, 3, 4, 5, 6, 12, 40])
def test_codewords(languages):
    code = language_id.codewords(languages)
    apart = [(a != b).sum() for i, a in enumerate(code) for b in code[:i]]
    assert min(apart) >= (1 if languages < 3 else 2 ** (languages - 2) if languages <= 5 else code.shape[1] // 4)
    splits = {tuple(c) if c[0] else tuple(1 - c) for c in code.T}
    assert len(splits) == code.shape[1] and all(0 < sum(c) < languages for c in code.T)


def test_decoding_is_the_least_weighted_loss():
    rng = np.random.default_rng(0)
    code = language_id.codewords(6)
    weight = rng.uniform(0.1, 1, code.shape[1])
    model = {"code": code, "weight": weight / weight.sum()}
    margins = rng.normal(0, 3, (50, code.shape[1]))
    best, second, score, gap = language_id.decode(model, margins)
    for r, m in enumerate(margins):
        loss = [sum(w * math.log1p(math.exp(-z if bit else z)) for w, z, bit in zip(model["weight"], m, word)) for word in code]
        order = sorted(range(6), key=loss.__getitem__)
        assert (best[r], second[r]) == tuple(order[:2]) and abs(gap[r] - (loss[order[1]] - loss[order[0]])) < 1e-9
        assert 1 / 6 <= score[r] <= 1
    flipped = 2.0 * code - 1
    flipped[:, 0] *= -1  # one wrong bit does not change the decision
    assert (language_id.decode(model | {"weight": np.full(code.shape[1], 1 / code.shape[1])}, 4 * flipped)[0] == np.arange(6)).all()


def test_held_out_accuracy(spark):
    rows = QUERIES["op3_language_id"](spark, "/root/testdata/sf0.01").collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    right = [r["lang_pred"] == truth[r["doc_id"]] for r in held]
    assert len(held) > 250 and sum(right) / len(right) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_awkward_rows(spark):
    texts = [None, "", "12 34 !?", "a", "the the of", "x" * 300_000, "ß", "日本語"]
    docs = spark.createDataFrame([(i, t, "en", "x", "y", 1) for i, t in enumerate(texts)] + [(None, "the of", None, "", "", 0)] * 2, SCHEMA)
    none = language_id.train(docs.where("false"))
    assert {(r["lang_pred"], r["score"]) for r in language_id.identify(docs, none).collect()} == {("und", 0.0)}
    one = language_id.identify(docs, language_id.train(docs)).collect()
    assert [r["lang_pred"] for r in one if r["doc_id"] in (0, 1, 2)] == ["und"] * 3
    assert {(r["lang_pred"], r["score"]) for r in one if r["doc_id"] not in (0, 1, 2)} == {("en", 1.0)} and len(one) == 10
    labelled = spark.createDataFrame([(i, t, y, "", "", 0) for i, (t, y) in enumerate([("the of and", "en"), ("der die und", "de")] * 6)], SCHEMA)
    model = language_id.train(labelled)
    assert [r["lang_pred"] for r in language_id.identify(labelled, model).orderBy("doc_id").collect()] == ["en", "de"] * 6
    assert language_id.identify(docs.where("false"), model).count() == 0

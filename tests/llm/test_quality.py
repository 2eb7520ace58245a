"""Quality rules against a plain reading of the definitions, and against held-out labels."""

from __future__ import annotations

import re
from collections import Counter

import pytest

from slotcast.llm import quality

SCHEMA = "doc_id bigint, text string, n_words string, kept int"  # extra columns with clashing names


def plain(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


AWKWARD = [None, "", " \n\t ", "one", "a b\na b\n\na b\n", "é ü x ## <b>|&", "x y\u0085z 𝄞𝄞",
           "\n", "w " * 500, "a b c d e f g h " * 3, "a b c d e f g h i " + "a b c d e f g h", "q" * 300_000,
           " ".join(f"w{i % 700}" for i in range(60_000)), "l1\nl1 \nl1\n", "\x00 \x1f\x1c ok"]


def test_base_counts_equal_plain_reading(spark, sf_dir):
    texts = AWKWARD + [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    rows = [(i % 40, t, "x", 1) for i, t in enumerate(texts)] + [(None, "a b", None, None)] * 2
    got = quality.rate(spark.createDataFrame(rows, SCHEMA), None).collect()
    assert Counter((r["doc_id"], *tuple(r)[1:6]) for r in got) == Counter((i, *plain(t)) for i, t, *_ in rows)
    for r in got:
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed) and r["p_good"] is None


def test_empty_table_and_missing_labels(spark):
    docs = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 7)], "doc_id bigint, quality int")
    assert quality.train(docs, labels) is None
    assert quality.rate(docs, None).count() == 0
    assert quality.keep_good(docs, None).columns == docs.columns


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.train(docs, labels.where("doc_id % 2 = 0"))
    rated = quality.rate(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    right = [r["kept"] == bool(r["quality"]) for r in rated]
    kept_good = [r["kept"] for r in rated if r["quality"] == 1 and not r["base_failed"]]
    assert len(right) > 100 and sum(right) / len(right) > 0.95 and sum(kept_good) / len(kept_good) > 0.98
    assert all(0 <= r["p_good"] <= 1 for r in rated)


@pytest.mark.parametrize("text", ["word " * 19, "word " * 40])
def test_base_rules_hold_whatever_the_model_says(spark, text):
    import numpy as np

    sure = {"weights": np.zeros(2 * quality.BUCKETS), "intercept": 9.0, "slope": 1.0, "shift": 0.0}
    row = quality.rate(spark.createDataFrame([(1, text, "", 0)], SCHEMA), sure).first()
    assert row["base_failed"] and not row["kept"] and row["p_good"] > 0.99

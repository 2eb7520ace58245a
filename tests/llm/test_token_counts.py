"""Signed batches against a dictionary that is simply updated."""

from __future__ import annotations

import random
from collections import Counter

from slotcast.llm import token_counts as tc, tokens
from slotcast.llm.queries import QUERIES

SCHEMA = "doc_id string, source string, lang string, version string, op string, n_tokens bigint, seq int, sign int"


def totals(spark, store):
    return {(r["source"], r["lang"], r["version"]): (r["n_docs"], r["n_tokens"]) for r in tc.totals(spark, store).collect()}


def test_batches(spark, tmp_path):
    rng, state, nameless = random.Random(1), {}, Counter()
    store = tc.create(spark, str(tmp_path / "store"))
    assert totals(spark, store) == {}
    for batch in ("a", "b/2024-01-01", "3", "c%c"):
        rows = [(rng.choice([None, *map(str, range(12))]), rng.choice(["s", "t", None]), rng.choice(["en", None]),
                 rng.choice(["v1", "v2", None]), rng.choice(["insert", "delete", "revise"]), rng.choice([None, 0, 5, 70]), seq, 9)
                for seq in range(40)]
        rng.shuffle(rows)
        changes = spark.createDataFrame(rows, SCHEMA)
        assert tc.apply_batch(spark, store, batch, changes) and not tc.apply_batch(spark, store, batch, changes)
        for d, s, l, v, op, n, *_ in sorted(rows, key=lambda r: r[6]):
            if d is None:
                nameless[s, l, v, n or 0] += op == "insert"
            elif op == "delete":
                state.pop((d, v), None)
            else:
                state[d, v] = (s, l, n or 0)
        want = Counter()
        for (d, v), (s, l, n) in state.items():
            want[(s, l, v), "d"] += 1
            want[(s, l, v), "n"] += n
        for (s, l, v, n), k in nameless.items():
            want[(s, l, v), "d"] += k
            want[(s, l, v), "n"] += k * n
        assert totals(spark, store) == {k: (want[k, "d"], want[k, "n"]) for k, x in want if x == "d" and (want[k, "d"] or want[k, "n"])}


def test_broken_batch_is_written_anew(spark, tmp_path):
    store = tc.create(spark, str(tmp_path / "store"))
    row = spark.createDataFrame([("1", "s", "en", "v", "insert", 5, 0, 0)], SCHEMA)
    # What a batch leaves that broke off before its commit:
    row.selectExpr("doc_id", "source", "lang", "version", "99L AS n_tokens", "1 AS sign").write.parquet(f"{store}/ledger/batch=x")
    assert totals(spark, store) == {}
    assert tc.apply_batch(spark, store, "y", row) and tc.apply_batch(spark, store, "x", row.withColumn("op", row.op).limit(0))
    assert totals(spark, store) == {("s", "en", "v"): (1, 5)}


def brute(docs):
    """What the query's three batches leave: per version the counts of trimmed texts, one document for each text."""
    encoder, first, want = tokens.Encoder(tokens.default_path()), {}, Counter()
    for r in sorted(docs, key=lambda r: r["doc_id"]):
        if r["text"] is not None and first.setdefault(r["text"], r["doc_id"]) != r["doc_id"]:
            continue
        body = (r["text"] or "").strip(" \t\n\r")
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in body)
        for version, text in (("byte_bpe_50k/1", body), ("byte_bpe_50k-uncased/1", lowered)):
            want[r["source"], r["lang"], version, "d"] += 1
            want[r["source"], r["lang"], version, "n"] += len(encoder.tokenizer.encode(text, add_special_tokens=False).ids)
    return {(s, l, v): (want[s, l, v, "d"], want[s, l, v, "n"]) for s, l, v, x in want if x == "d"}


def counted(spark, sf_dir):
    return {(r["source"], r["lang"], r["version"]): (r["n_docs"], r["n_tokens"]) for r in QUERIES["op10_token_counts"](spark, sf_dir).collect()}


def test_query_counts_each_text_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang").collect()
    assert counted(spark, sf_dir) == brute(docs)


def test_query_with_a_very_common_text_and_outer_blanks(spark, tmp_path):
    texts = ["the Same text ", "the Same text", " \t", "", None, "\n own words A B\r\n", "own words A B", "\x0b kept"]
    rows = [(i, texts[0] if i % 3 else texts[i // 3 % len(texts)], "st"[i % 2], None if i % 5 == 0 else "en") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert counted(spark, str(tmp_path)) == brute(docs.collect())
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert counted(spark, f"{tmp_path}/none") == {}

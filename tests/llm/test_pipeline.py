"""The pipeline's stages on planted rows, and the registration of all queries."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from slotcast.llm import ngram_join, quality
from slotcast.llm.queries import ORACLES, QUERIES
from slotcast.session import materialize

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_registration():
    names = set(entry.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in names and set(ORACLES) <= set(entry.oracle_sql()) and set(QUERIES) <= names


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    import compare

    assert compare.differences(QUERIES[name](spark, sf_dir).toPandas(), duck.execute(ORACLES[name]).df()) is None


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean rows of the given documents with planted cases: junk, copies, near copies, benchmark passages, mail addresses."""
    base, source = tmp_path_factory.mktemp("corpus"), "/root/testdata/sf0.01"
    rng = random.Random(2)
    rows = [tuple(r) for r in spark.read.parquet(f"{source}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    passage = spark.read.parquet(f"{source}/benchmark.parquet").orderBy("item_id").first()["text"]
    fresh = [" ".join(f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnr')}{rng.choice('aeiou')}" for _ in range(60)) for _ in range(8)]
    near = fresh[0].split()
    near[30] = "changed"
    plant = {5000: fresh[0], 5001: fresh[0], 5002: " ".join(near), 5003: fresh[1], 5004: fresh[2] + " " + passage, 5005: fresh[3] + " write to jo.doe@corp.com",
             5006: fresh[4], 5007: None, 5008: "", 5009: "few words", 5010: "%%% $$$ ### " * 40}
    rows += [(i, t, "en", "planted", None if t is None else len(t)) for i, t in plant.items()]
    spark.createDataFrame(rows + [(None, fresh[5], None, None, None)], COLUMNS).repartition(3).write.parquet(f"{base}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{source}/{name}.parquet").write.parquet(f"{base}/{name}.parquet")
    return str(base)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept, rows = {}, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = rows
        rows = materialize(stage(spark, rows, folder))
        assert rows.schema == docs.schema, name
        kept[name] = {r["doc_id"]: r for r in rows.collect()}
        if name == "quality rules":
            verdicts = quality.rate(before, quality.train(before, spark.read.parquet(f"{folder}/labels.parquet"))).where("kept").count()
            assert verdicts == rows.count()
        if name == "near duplicates":
            classes = ngram_join.near_duplicates(before).where("node is not null").select("class_node").distinct().count()
            assert rows.count() == classes and ngram_join.near_duplicates(rows).where("n_links > 0").count() == 0
    ids = {name: set(found) for name, found in kept.items()}
    assert {5007, 5008, 5009, 5010}.isdisjoint(ids["quality rules"]) and {5000, 5001, 5002, 5003, 5004, 5005, 5006, None} <= ids["quality rules"]
    assert ids["near duplicates"] & {5000, 5001, 5002} == {5000} and {5003, 5004, 5005, 5006, None} <= ids["near duplicates"]
    assert 5004 not in ids["benchmark passages"] and {5003, 5005, 5006, None} <= ids["benchmark passages"]
    text = kept["personal data"][5005]["text"]
    assert "jo.doe" not in text and text.startswith(kept["benchmark passages"][5005]["text"][:200]) and kept["personal data"][5005]["n_chars"] == len(text)
    assert kept["personal data"][5003] == kept["benchmark passages"][5003]

    lengths = defaultdict(int)
    for r in corpus_pipeline.run(spark, folder).collect():
        lengths[r["doc_id"]] += r["length"]
        assert r["offset"] + r["length"] <= 2048
    assert set(lengths) == ids["personal data"] and all(n > 0 for n in lengths.values())


def test_empty_input(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        rows = materialize(stage(spark, rows, folder))
        assert rows.count() == 0

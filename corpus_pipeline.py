"""Training-corpus pipeline: quality rules, near duplicates, benchmark passages, personal data, packing.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and is
written as Parquet before the next one reads it. All but the last return the columns of
documents; the last returns packed pieces.

Defined results: a null, empty or very short text fails the quality rules and goes in the first
stage. Of documents with the same or nearly the same words the one with the smallest id stays,
of equal ids one row. Any word window of a benchmark item removes a document. Very long texts
go through every stage whole. Columns besides those of documents pass unchanged up to packing.
An empty table gives no pieces. The surrogate key is that of the session (see llm.pii).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slotcast.llm import decontaminate, ngram_join, packing, pii, quality
from slotcast.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(docs, count="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("benchmark passages", benchmark_passages),
    ("personal data", personal_data),
    ("packing", pack),
]

# A trained classifier and a tokenizer are not SQL; tests/llm/test_pipeline.py checks every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        rows = materialize(stage(spark, rows, sf_dir))
    return STAGES[-1][1](spark, rows, sf_dir)

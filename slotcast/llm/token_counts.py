"""Token totals by source, language and tokenizer version, kept up to date by signed batches.

A store holds three tables: ``ledger`` (signed rows per document), ``rollups`` (signed totals
per batch) and ``commits`` (one row per batch, written last). A batch of inserts, deletes and
revised counts takes back what the ledger last counted for its documents and adds what the
batch says, so its totals simply add up with all others. A batch id that is already committed
changes nothing; one that broke off before its commit is written anew over its own files.
Readers see committed batches only. One batch is applied at a time.

Defined results: of several changes to a document and version in one batch the last by ``seq``
(then by the other columns) holds. Deleting what is not there changes nothing; revising it
inserts it; inserting what is there replaces it. Rows without document id cannot be found
again: inserts among them all count, deletes and revisions of them change nothing. Null
source, language and version are values of their own; null counts are 0. Texts of any length
are counted whole. An empty batch is committed and changes nothing.
"""

from __future__ import annotations

from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from slotcast.llm import tokens
from slotcast.session import materialize

LEDGER = "doc_id string, source string, lang string, version string, n_tokens bigint, sign int"
ROLLUP = "source string, lang string, version string, n_docs bigint, n_tokens bigint"
COMMIT = "batch string, n_changes bigint"
CHANGE = ("doc_id", "source", "lang", "version", "op", "n_tokens", "seq")


def count_tokens(docs: DataFrame, version: str, tokenizer: str | None = None, doc_id: str = "doc_id", text: str = "text",
                 source: str = "source", lang: str = "lang") -> DataFrame:
    """``doc_id, source, lang, version, n_tokens`` of every row; a null or empty text has none."""
    path = tokenizer or tokens.default_path()

    def count(batches):
        encoder = tokens.encoder(path)
        for batch in batches:
            size = [np.diff(bounds) for _, _, _, bounds in encoder.encode(batch.column(3))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array(np.concatenate(size) if size else np.zeros(0, np.int64), pa.int64())],
                names=["doc_id", "source", "lang", "n_tokens"])

    given = docs.select(*[F.col(c).cast("string").alias(n) for c, n in
                          ((doc_id, "doc_id"), (source, "source"), (lang, "lang"))], F.col(text).alias("body"))
    counted = given.mapInArrow(count, "doc_id string, source string, lang string, n_tokens bigint")
    return counted.withColumn("version", F.lit(version)).select("doc_id", "source", "lang", "version", "n_tokens")


def create(spark: SparkSession, path: str) -> str:
    """A new, empty store."""
    for name, schema in (("ledger", LEDGER), ("rollups", ROLLUP)):
        spark.createDataFrame([], f"{schema}, batch string").write.partitionBy("batch").parquet(f"{path}/{name}")
    spark.createDataFrame([], COMMIT).write.parquet(f"{path}/commits")
    return path


def committed(spark: SparkSession, path: str) -> list[str]:
    return [r["batch"] for r in spark.read.schema(COMMIT).parquet(f"{path}/commits").select("batch").distinct().collect()]


def _table(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """Rows of the committed batches; other batches' folders are pruned."""
    return spark.read.schema(f"{schema}, batch string").parquet(f"{path}/{name}").where(
        F.col("batch").isin(committed(spark, path)))


def apply_batch(spark: SparkSession, path: str, batch: str, changes: DataFrame) -> bool:
    """Commits a batch of (doc_id, source, lang, version, op, n_tokens, seq); False if it was there.

    ``op`` is insert, delete or revise. For deletes only document id and version matter.
    """
    if batch in committed(spark, path):
        return False
    folder = quote(batch, safe="")
    # stored: the counts behind the changes are dear, and three parts of the plan read them
    rows = materialize(changes.select(*[F.col(c).cast({"n_tokens": "bigint", "seq": "bigint"}.get(c, "string")).alias(c) for c in CHANGE]))
    named = rows.where("doc_id IS NOT NULL")
    last = named.groupBy("doc_id", "version").agg(F.max(F.struct("seq", "op", "source", "lang", "n_tokens")).alias("c"))
    last = last.selectExpr("doc_id", "version", "c.op", "c.source", "c.lang", "coalesce(c.n_tokens, 0) AS n_tokens")

    # What the ledger holds for the changed documents: rows whose signs do not cancel.
    keys = last.selectExpr("doc_id AS k_doc", "version AS k_version")
    now = (_table(spark, path, "ledger", LEDGER).where("doc_id IS NOT NULL")
           .join(keys, F.expr("doc_id = k_doc AND version <=> k_version"), "left_semi")
           .groupBy("doc_id", "source", "lang", "version", "n_tokens").agg(F.sum("sign").alias("sign")).where("sign <> 0"))
    order = ["doc_id", "source", "lang", "version", "n_tokens", "sign"]
    added = last.where("op IN ('insert', 'revise')").withColumn("sign", F.lit(1))
    nameless = rows.where("doc_id IS NULL AND op = 'insert'").withColumn("n_tokens", F.expr("coalesce(n_tokens, 0)")).withColumn("sign", F.lit(1))
    signed = now.withColumn("sign", -F.col("sign")).select(*order).unionAll(added.select(*order)).unionAll(nameless.select(*order))
    signed.withColumn("sign", F.col("sign").cast("int")).write.mode("overwrite").parquet(f"{path}/ledger/batch={folder}")

    stored = spark.read.schema(LEDGER).parquet(f"{path}/ledger/batch={folder}")
    _sum(stored, "sign", "sign * n_tokens").write.mode("overwrite").parquet(f"{path}/rollups/batch={folder}")
    spark.createDataFrame([(batch, stored.count())], COMMIT).coalesce(1).write.mode("append").parquet(f"{path}/commits")
    return True


def _sum(rows: DataFrame, docs: str, count: str) -> DataFrame:
    return rows.groupBy("source", "lang", "version").agg(
        F.expr(f"CAST(sum({docs}) AS BIGINT)").alias("n_docs"), F.expr(f"CAST(sum({count}) AS BIGINT)").alias("n_tokens"))


def totals(spark: SparkSession, path: str) -> DataFrame:
    """``source, lang, version, n_docs, n_tokens`` over all committed batches; groups that fell to none are left out."""
    return _sum(_table(spark, path, "rollups", ROLLUP), "n_docs", "n_tokens").where("n_docs <> 0 OR n_tokens <> 0")

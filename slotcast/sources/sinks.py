"""Writers of predictions, metrics and run records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.spec import DEFAULT, Spec


def write_predictions(df: DataFrame, path: str, sp: Spec = DEFAULT, prediction: str = "demand") -> None:
    df.select(sp.row_id, F.col(prediction).alias("demand")).write.mode("overwrite").csv(path, header=True)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_run_record(record: DataFrame, path: str) -> None:
    """Adds the records as JSON lines; earlier lines stay."""
    record.write.mode("append").json(path)


def write_oof(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column with its null count, from a single aggregate."""
    names = df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    pairs: list[Column] = [F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in names]
    return (
        counts.select(F.explode(F.array(*pairs)).alias("p"))
        .select("p.column", "p.n_null", F.lit(len(names)).cast("bigint").alias("n_columns"))
    )

"""Ordinal codes of low-cardinality category columns."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame


def fit_codes(train: DataFrame, columns: list[str]) -> StringIndexerModel:
    """Codes 0, 1, ... in alphabetical order, fitted once and reused for every frame.

    The model holds the list of categories; columns that grow with the data, such as location
    keys, are encoded by their target instead.
    """
    indexer = StringIndexer(
        inputCols=columns, outputCols=[f"{c}_code" for c in columns],
        stringOrderType="alphabetAsc", handleInvalid="keep",
    )
    return indexer.fit(train)


def ordinal_encode(train: DataFrame, rows: DataFrame, columns: list[str]) -> DataFrame:
    """Adds <column>_code; categories not seen in training share one extra code."""
    return fit_codes(train, columns).transform(rows)

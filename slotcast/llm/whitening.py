"""Embedding whitening: principal directions of all vectors, from triangular factors of row blocks.

Every task centres its rows and reduces them to one triangular factor by QR; factors are
combined in a tree, so no task holds more than a few of them, and the covariance matrix,
whose condition is the square, is never formed. The one factor left, of the size of the
vectors' dimension, is bidiagonalised; see ``bidiagonal``.

With ``scale`` the entries are first made whole numbers, floor(scale * c) + shift, whose sums
are exact at any number of rows.

Defined results. Rows whose vector is null, empty or holds a null or non-finite entry take
no part; nor do vectors of another length than the most frequent one (the longer of equally
frequent ones). Whole numbers end at 2**40 either way. Repeated rows count as often as they
stand; a null id is kept. Directions whose variance is at rounding level (few or equal
rows) are left out, so there may be fewer than asked for, or none. A deviation beyond the
long range is null. An empty table gives an empty result; extra columns are kept by
``Whitening.apply``, whose own columns take the place of equally named ones.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from slotcast.llm.bidiagonal import right_singular
from slotcast.llm.cross_polytope import matrix
from slotcast.session import materialize

FAN_IN = 16  # triangular factors that one task combines
LARGEST = float(1 << 40)


@dataclass(frozen=True)
class Whitening:
    """Mean and directions of the fit rows; eigenvalues fall."""

    n: int
    whole: np.ndarray  # integer part of the mean per dimension
    rest: np.ndarray  # its rest, as a double
    exact: list[Fraction]
    eigenvalues: np.ndarray  # of the covariance, all of them
    directions: np.ndarray  # dimension x components
    scale: float | None
    shift: int

    @property
    def components(self) -> int:
        return self.directions.shape[1]

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues[:self.components] / self.eigenvalues.sum()

    def centred(self, x):
        """Prepared rows (see ``prepared``) minus the mean, as doubles."""
        return (x - self.whole).astype(np.float64) - self.rest

    def whitened(self, x):
        return self.centred(x) @ self.directions / np.sqrt(self.eigenvalues[:self.components])

    def apply(self, df: DataFrame, vector: str = "embedding", out: str = "whitened") -> DataFrame:
        """All columns and rows of ``df`` with an array column of whitened values; null where a vector takes no part."""
        whitened, scale, shift, dims = self.whitened, self.scale, self.shift, len(self.whole)
        schema = ", ".join(f"`{c}` {t}" for c, t in df.dtypes if c != out)

        def work(batches):
            for batch in batches:
                values = [None] * batch.num_rows
                usable = np.asarray(batch.column("_usable"))
                at = np.flatnonzero(usable)
                for part, x in matrix(batch.column(vector).take(pa.array(at))):
                    for i, row in zip(at[part], whitened(prepared(x, scale, shift))):
                        values[i] = row
                kept = [c for c in batch.schema.names if c not in (out, "_usable")]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in kept), pa.array(values, pa.list_(pa.float64()))], [*kept, out])

        flagged = df.withColumn("_usable", F.coalesce(F.expr(f"{_whole(vector)} AND size(`{vector}`) = {dims}"), F.lit(False)))
        return flagged.mapInArrow(work, f"{schema}{', ' if schema else ''}`{out}` array<double>")


def _whole(vector: str) -> str:
    v = f"`{vector}`"
    return f"{v} IS NOT NULL AND size({v}) > 0 AND forall({v}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"


def prepared(x, scale: float | None, shift: int):
    """Rows as whole numbers (longs), or as they are without ``scale``."""
    if scale is None:
        return x
    return np.clip(np.floor(scale * x), -LARGEST, LARGEST).astype(np.int64) + shift


def usable(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows that take part, of the most frequent length."""
    rows = df.where(_whole(vector))
    sizes = rows.groupBy(F.size(f"`{vector}`").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size(f"`{vector}`") == (sizes["d"] if sizes else 0))


def fit(rows: DataFrame, vector: str = "embedding", components: int = 32, scale: float | None = None, shift: int = 0) -> Whitening | None:
    """Whitening of all ``rows`` (those of ``usable``); None where there are none.

    The driver sees one sum per dimension and one triangular factor.
    """
    vectors = rows.select(F.col(f"`{vector}`").alias("v"))

    def sums(batches):
        total, n = None, 0
        for batch in batches:
            for _, x in matrix(batch.column("v")):
                x = prepared(x, scale, shift)
                part = x.sum(0)
                if scale is not None:  # longs do not round; Python's integers do not overflow
                    part = part.astype(object)
                total, n = part if total is None else total + part, n + len(x)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total)),
                 pa.array([int(t) for t in total] if scale is not None else [0] * len(total), pa.decimal128(38, 0)),
                 pa.array([0.0] * len(total) if scale is not None else total)], ["d", "n", "whole", "real"])

    found = vectors.mapInArrow(sums, "d int, n bigint, whole decimal(38,0), real double").groupBy("d").agg(
        F.sum("n").alias("n"), F.sum("whole").alias("whole"), F.sum("real").alias("real")).orderBy("d").collect()
    if not found:
        return None
    n = found[0]["n"]
    if scale is None:
        exact = [Fraction(r["real"]) / n for r in found]
        whole, rest = np.array([r["real"] / n for r in found]), np.zeros(len(found))
    else:
        exact = [Fraction(int(r["whole"]), n) for r in found]
        whole = np.array([f.numerator // f.denominator for f in exact], np.int64)
        rest = np.array([float(f - int(w)) for f, w in zip(exact, whole)])
    mean = Whitening(n, whole, rest, exact, np.zeros(0), np.zeros((len(found), 0)), scale, shift)
    values, directions = right_singular(_triangular(vectors, mean))
    return Whitening(n, whole, rest, exact, values / n, directions[:, :components], scale, shift)


def _reduced(blocks):
    """Triangular factor of all rows of the blocks, one block at a time."""
    r = None
    for x in blocks:
        r = np.linalg.qr(x if r is None else np.concatenate([r, x]), mode="r")
    return r


def _triangular(vectors: DataFrame, mean: Whitening):
    """The triangular factor of all centred rows: one per task, then FAN_IN at a time."""
    centred, scale, shift, dims = mean.centred, mean.scale, mean.shift, len(mean.whole)

    def first(batches):
        r = _reduced(centred(prepared(x, scale, shift)) for batch in batches for _, x in matrix(batch.column("v")))
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([r.ravel()], pa.list_(pa.float64()))], ["r"])

    def combine(table):
        r = _reduced(x.as_py() and np.array(x.as_py()).reshape(-1, dims) for x in table.column("r"))
        return pa.table({"r": pa.array([r.ravel()], pa.list_(pa.float64()))})

    factors = materialize(vectors.mapInArrow(first, "r array<double>").withColumn("k", F.spark_partition_id()))
    while (parts := factors.agg(F.max("k").alias("k")).first()["k"]) > 0:
        group = factors.withColumn("g", F.expr(f"k DIV {FAN_IN}")).groupBy("g").applyInArrow(
            lambda key, table: combine(table).append_column("k", pa.array([key[0].as_py()], pa.int32())), "r array<double>, k int")
        factors = materialize(group)
        if parts < FAN_IN:
            break
    r = np.array(factors.first()["r"]).reshape(-1, dims)
    return np.concatenate([r, np.zeros((dims - len(r), dims))])


def identity_error(rows: DataFrame, model: Whitening, vector: str = "embedding") -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the identity; null without components.

    Blocks are centred before they are multiplied; their means are put together exactly as
    their counts say.
    """
    if not model.components:
        return None
    whitened, scale, shift, c = model.whitened, model.scale, model.shift, model.components

    def moments(batches):
        n, mean, second = 0, np.zeros(c), np.zeros((c, c))
        for batch in batches:
            for _, x in matrix(batch.column("v")):
                w = whitened(prepared(x, scale, shift))
                m = w.mean(0)
                d, both = m - mean, n + len(w)
                second += (w - m).T @ (w - m) + np.outer(d, d) * (n * len(w) / both)
                mean, n = mean + d * (len(w) / both), both
        if n:
            i, j = (a.ravel() for a in np.indices((c, c)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a) for a in (i, j, np.full(c * c, n), mean[i], mean[j], second.ravel())], ["i", "j", "n", "a", "b", "s"])

    parts = rows.select(F.col(f"`{vector}`").alias("v")).mapInArrow(
        moments, "i bigint, j bigint, n bigint, a double, b double, s double")
    entry = parts.groupBy("i", "j").agg(F.expr(
        "sum(s + n * a * b) / sum(n) - sum(n * a) / sum(n) * (sum(n * b) / sum(n)) - max(IF(i = j, 1D, 0D))").alias("e"))
    return entry.agg(F.max(F.abs("e")).alias("e")).first()["e"]


def deviation(x, model: Whitening):
    """Sum over the dimensions of (n * x - S)**2 for rows of whole numbers, exact; None beyond the long range."""
    n, rest = model.n, [int((f - int(w)) * model.n) for f, w in zip(model.exact, model.whole)]
    apart = x - model.whole
    largest = n * max(int(np.abs(apart).max(initial=0)), 1) + n
    if largest ** 2 * x.shape[1] < 1 << 63:
        return ((n * apart - np.array(rest, np.int64)) ** 2).sum(1).tolist()
    sums = ((n * apart.astype(object) - np.array(rest, object)) ** 2).sum(1)
    return [v if v < 1 << 63 else None for v in sums]


def long_form(rows: DataFrame, model: Whitening | None, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id, component, n, deviation, whitened, explained``: a row for each of ``rows`` and component."""
    schema = f"{id} bigint, component int, n bigint, deviation bigint, whitened double, explained double"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    c = model.components

    def work(batches):
        for batch in batches:
            ids = batch.column("id")
            for at, x in matrix(batch.column("v")):
                for a in range(0, len(x), 1024):
                    part = prepared(x[a:a + 1024], model.scale, model.shift)
                    k = len(part)
                    far = pa.array(deviation(part, model) if model.scale is not None else [None] * k, pa.int64())
                    row = pa.array(np.repeat(np.arange(k), c))
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(at[a:a + 1024])).take(row), pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), k)),
                         pa.array(np.full(k * c, model.n)), far.take(row), pa.array(model.whitened(part).ravel()),
                         pa.array(np.tile(model.explained, k))],
                        [id, "component", "n", "deviation", "whitened", "explained"])

    return rows.select(F.col(f"`{id}`").cast("bigint").alias("id"), F.col(f"`{vector}`").alias("v")).mapInArrow(work, schema)

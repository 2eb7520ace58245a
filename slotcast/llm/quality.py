"""Quality rules: base counts, and a calibrated n-gram classifier learned from labelled rows.

Features are hashed word 1- and 2-grams and byte 3-grams, case kept, as shares of the
text's n-grams. A logistic regression is fitted on at most ``train_rows`` labelled rows
(those with the smallest hash), its margin is turned into a probability on a fifth of them
held out (Platt), and every whole text is scored in Arrow batches against fixed thresholds.
Only the weights (``2 * BUCKETS`` numbers) travel to the tasks.

Defined results: a null or empty text has zero counts and fails the base rules. Labels that
are null or not 0/1 teach nothing; with fewer than two classes there is no model, the
probability is null and the base rules alone decide. Repeated rows each get a row; labels of
a repeated id all count. A probability equal to the threshold is kept. Texts of any length are
read whole, a slice at a time; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from slotcast.llm import linear, textops as T

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
THRESHOLD = 0.5
TRAIN_ROWS = 2000
BUCKETS = 1 << 13
WINDOW = 8
SYMBOLS = T.byte_class(lambda b: chr(b) in "#*$%&|<>")

BASE_SCHEMA = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def _repeats(hashes, rows):
    """Mask of entries whose (row, hash) occurs more than once, and of those after the first."""
    with np.errstate(over="ignore"):
        key = T.mix(hashes + rows.astype(T.U64) * T.U64(T.BASE))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again, twice = np.zeros(len(key), bool), np.zeros(len(key), bool)
    again[order[1:][same]] = True
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice, again


def measure(data, offsets):
    """The five base counts of every text of a slice, and the parts the features are made of."""
    n = len(offsets) - 1
    starts, ends, rows = T.words(data, offsets, T.INK_BYTES)
    bounds = T.starts_of(rows, n)
    prefix = T.Prefix(data, T.byte_values(False))
    hashes = prefix.hashes(starts, ends)

    lead = np.concatenate([[0], np.cumsum(((data & 0xC0) != 0x80) & T.INK_BYTES[data])])
    symbols = np.concatenate([[0], np.cumsum(SYMBOLS[data])])

    breaks = np.flatnonzero(data == 0x0A)
    line_starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    line_rows = np.sort(np.concatenate([np.arange(n), T.rows_of(breaks, offsets)]))
    # Sorted starts and sorted rows belong together: a row's lines lie between its limits.
    line_ends = np.sort(np.concatenate([breaks, offsets[1:]]))
    inked = np.searchsorted(starts, line_starts) < np.searchsorted(starts, line_ends)
    _, again = _repeats(prefix.hashes(line_starts[inked], line_ends[inked]), line_rows[inked])
    dup_lines = np.bincount(line_rows[inked][again], minlength=n)

    window, first = T.grams(hashes, rows, WINDOW)
    twice, _ = _repeats(window, rows[first])
    change = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(change, first[twice], 1)
    np.add.at(change, first[twice] + WINDOW, -1)
    covered = np.cumsum(change)[:-1] > 0
    counts = (np.diff(bounds), lead[offsets[1:]] - lead[offsets[:-1]], symbols[offsets[1:]] - symbols[offsets[:-1]],
              dup_lines, np.bincount(rows[covered], minlength=n))
    return counts, hashes, rows


def _features(data, offsets, hashes, rows):
    """(bucket, row) of every word 1- and 2-gram, and of every byte 3-gram."""
    pairs, first = T.grams(hashes, rows, 2)
    word = np.concatenate([hashes, pairs]) % T.U64(BUCKETS)
    word_rows = np.concatenate([rows, rows[first]])
    if len(data) < 3:
        return word.astype(np.int64), word_rows, np.zeros(0, np.int64), np.zeros(0, np.int64)
    triple = (data[:-2].astype(np.uint32) << 16) | (data[1:-1].astype(np.uint32) << 8) | data[2:]
    triple = ((triple * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64)
    lengths = np.maximum(np.diff(offsets) - 2, 0)
    inside = np.ones(len(triple), bool)
    for back in (1, 2):
        cut = offsets[1:-1] - back
        inside[cut[(cut >= 0) & (cut < len(triple))]] = False
    triple_rows = np.repeat(np.arange(len(lengths)), lengths)
    return word.astype(np.int64), word_rows, triple[inside], triple_rows


def _shares(buckets, rows, n):
    """Dense (rows, buckets) shares of the n-grams of each row."""
    x = np.bincount(rows * BUCKETS + buckets, minlength=n * BUCKETS).reshape(n, BUCKETS).astype(np.float32)
    return x / np.maximum(x.sum(1, keepdims=True), 1)


def _mean_weight(weights, buckets, rows, n):
    total = np.bincount(rows, weights=weights[buckets], minlength=n)
    return total / np.maximum(np.bincount(rows, minlength=n), 1)


SCALE = 30.0  # shares are small; brings them near one for the optimizer


def _margins(model, data, offsets, hashes, rows):
    n = len(offsets) - 1
    word, word_rows, triple, triple_rows = _features(data, offsets, hashes, rows)
    weights = model["weights"]
    return SCALE * (_mean_weight(weights[:BUCKETS], word, word_rows, n)
                    + _mean_weight(weights[BUCKETS:], triple, triple_rows, n)) + model["intercept"]


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label_id: str = "doc_id",
          label: str = "quality", train_rows: int = TRAIN_ROWS) -> dict | None:
    """Weights and calibration learned from labelled rows; None without rows of both classes."""
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(label_id).alias("l_id"), F.col(label).cast("int").alias("y"))
    # Both classes get half of the bound; a fixed hash decides which rows teach.
    size = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        return None
    spread = F.pmod(F.xxhash64(F.col("l_id"), F.lit(17)), F.lit(1 << 30))
    quota = {y: min(1.0, 1.5 * train_rows / 2 / n) for y, n in size.items()}
    picked = known.where(spread < F.when(F.col("y") == 1, quota[1] * (1 << 30)).otherwise(quota[0] * (1 << 30)))
    sample = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(
        picked, F.col("id") == F.col("l_id")).select(
        "y", "text", F.xxhash64("id", "text").alias("h"))
    parts = [sample.where(f"y = {y}").orderBy("h").limit(train_rows // 2) for y in (0, 1)]

    def learn(batches):
        table = pa.Table.from_batches(list(batches))
        if not len(table):
            return
        y = table.column("y").to_numpy()
        held = (table.column("h").to_numpy().astype(np.int64) % 5) == 0
        x = np.empty((len(y), 2 * BUCKETS), np.float32)  # the one large array: train_rows * 64 KB
        for first, past, data, offsets in T.slices(table.column("text"), rows=64):
            _, hashes, rows = measure(data, offsets)
            word, word_rows, triple, triple_rows = _features(data, offsets, hashes, rows)
            n = past - first
            x[first:past, :BUCKETS] = SCALE * _shares(word, word_rows, n)
            x[first:past, BUCKETS:] = SCALE * _shares(triple, triple_rows, n)
        fitted = ~held
        if len(set(y[fitted])) < 2:
            fitted = np.ones(len(y), bool)
        if len(set(y[fitted])) < 2:
            return
        share = np.where(y == 1, 0.5 / max(1, (y[fitted] == 1).sum()), 0.5 / max(1, (y[fitted] == 0).sum()))
        w, b = linear.fit(x, y[:, None], np.where(fitted, share, 0.0)[:, None])
        margin = x @ w[:, 0] + b[0]
        judged = held if len(set(y[held])) == 2 else np.ones(len(y), bool)
        slope, shift = linear.platt(margin[judged], y[judged])
        yield pa.RecordBatch.from_pydict({"weights": [w[:, 0].astype("<f4").tobytes()], "intercept": [float(b[0])],
                                          "slope": [float(slope)], "shift": [float(shift)]})

    found = (parts[0].unionAll(parts[1]).coalesce(1)
             .mapInArrow(learn, "weights binary, intercept double, slope double, shift double").collect())
    if not found:
        return None
    return {"weights": np.frombuffer(found[0]["weights"], "<f4").astype(np.float64), "intercept": found[0]["intercept"],
            "slope": found[0]["slope"], "shift": found[0]["shift"]}


def rate(docs: DataFrame, model: dict | None, doc_id: str = "doc_id", text: str = "text", keep: bool = False,
         threshold: float = THRESHOLD, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """Per input row: id (or with ``keep`` the row as struct ``row``), base counts, verdicts and probability."""
    at = docs.columns.index(text) if keep else 1

    def score(batches):
        for batch in batches:
            body = batch.column(0).field(at) if keep else batch.column(1)
            for first, past, data, offsets in T.slices(body):
                counts, hashes, rows = measure(data, offsets)
                words, repeated = counts[0], counts[4]
                failed = (words < min_words) | (100 * repeated > max_repeat_percent * words)
                p = None if model is None else linear.sigmoid(
                    model["slope"] * _margins(model, data, offsets, hashes, rows) + model["shift"])
                good = ~failed if p is None else ~failed & (p >= threshold)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, past - first), *(pa.array(c, pa.int64()) for c in counts), pa.array(failed),
                     pa.array(good), pa.nulls(past - first, pa.float64()) if p is None else pa.array(p)],
                    names=["key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                           "kept", "p_good"])

    key = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if keep else F.col(doc_id)
    given = docs.select(key.alias("key"), *([] if keep else [F.col(text).alias("body")]))
    kind = given.schema["key"].dataType.simpleString()
    rated = given.mapInArrow(score, f"key {kind}, {BASE_SCHEMA}, base_failed boolean, kept boolean, p_good double")
    return rated.withColumnRenamed("key", "row" if keep else doc_id)


def keep_good(docs: DataFrame, model: dict | None, text: str = "text", **rules) -> DataFrame:
    """The rows of ``docs``, all columns, that pass base rules and classifier."""
    return rate(docs, model, text=text, keep=True, **rules).where("kept").select(
        *[F.col(f"row.`{c}`").alias(c) for c in docs.columns])

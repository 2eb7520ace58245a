"""Sequence packing as a cutting-stock problem solved by column generation.

1. Tokens of each document, with the end id, are cut at multiples of ``capacity``; what is
   left over is one piece. Short pieces of one length are bundled, and a bundle is packed like
   one piece. Pieces and bundles are counted by length class (``width`` tokens); a bundle has
   so many pieces, up to ``bundle`` tokens, that rounding up to a class costs least. The driver
   sees counts only: one per short length and per class.
2. A linear program over patterns (how many pieces of each class share a sequence) minimises
   the sequences. New patterns come from an unbounded knapsack on the duals, by dynamic
   programming over the capacity.
3. Patterns are rounded down; the few pieces per class beyond them are packed best-first into
   extra patterns, so every piece has a place.
4. Pieces are ranked within their class (in parts, so that no task holds a large class) and
   take the places the patterns give to that rank.

Defined results: a null or empty text is its end id alone. Texts of any length are read
whole. Repeated rows are packed one by one. Without rows there are no sequences. Extra
columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from slotcast.llm import tokens
from slotcast.session import materialize

CAPACITY = 2048
WIDTH = 8
BUNDLE = 512  # pieces of up to half of it are bundled
END = 1
PART_ROWS, MOST_PARTS = 2048, 4096  # pieces of a class that are ranked together, and parts of a class


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, end: int = END,
           capacity: int = CAPACITY) -> DataFrame:
    """``id, start, length, ids_crc32, doc_tokens`` of every piece of every document."""
    path = tokenizer or tokens.default_path()

    def cut(batches):
        encoder = tokens.encoder(path)
        for batch in batches:
            for first, past, ids, bounds in encoder.encode(batch.column(1)):
                ids, bounds = tokens.with_end(ids, bounds, end)
                size = np.diff(bounds)
                count = -(-size // capacity)
                row = np.repeat(np.arange(past - first), count)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * capacity
                length = np.minimum(capacity, size[row] - start)
                raw = memoryview(ids.astype("<u4").tobytes())
                at = ((bounds[row] + start) * 4).tolist()
                crc = [zlib.crc32(raw[a:a + 4 * n]) for a, n in zip(at, length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, past - first).take(pa.array(row)), pa.array(start), pa.array(length),
                     pa.array(crc, pa.int64()), pa.array(size[row])],
                    names=["id", "start", "length", "ids_crc32", "doc_tokens"])

    given = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body"))
    kind = given.schema["id"].dataType.simpleString()
    return given.mapInArrow(cut, f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


def best_pattern(value, capacity: int):
    """Pattern with the greatest total value and sizes 1, 2, ... within the capacity."""
    best, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        gain = value[:room] + best[room - 1::-1][:room]
        k = int(gain.argmax())
        best[room], choice[room] = (gain[k], k + 1) if gain[k] > best[room - 1] else (best[room - 1], 0)
    pattern, room = np.zeros(len(value), np.int64), capacity
    while room > 0:
        if choice[room]:
            pattern[choice[room] - 1] += 1
            room -= choice[room]
        else:
            room -= 1
    return best[capacity], pattern


def solve_patterns(demand, rounds_per_class: int = 20, gap: float = 1e-3):
    """Basic solution of the pattern program: (patterns as columns, how often each).

    ``demand[k]`` pieces have size k + 1 and the capacity is ``len(demand)``. The optimum is at
    least the present amount divided by the best pattern's worth, so rounds end once it is
    within ``gap``, or after a number of rounds in proportion to the classes; any stop leaves
    an exact cover of the demand. Rounding errors of the updated inverse can cost a little of
    the optimum, never the cover: whole_patterns takes no more than there is.
    """
    capacity = len(demand)
    have = np.flatnonzero(demand)
    if not len(have):
        return np.zeros((capacity, 0), np.int64), np.zeros(0)
    fit = capacity // (have + 1)
    columns = np.diag(fit).astype(float)
    inverse = np.diag(1.0 / fit)
    amount = demand[have] / fit
    for _ in range(rounds_per_class * len(have)):
        value = np.full(capacity, -1.0)
        value[have] = inverse.sum(0)
        worth, pattern = best_pattern(value, capacity)
        if worth <= 1 + gap:
            break
        entering = pattern[have].astype(float)
        change = inverse @ entering
        ratio = np.full(len(have), np.inf)
        ratio[change > 1e-9] = amount[change > 1e-9] / change[change > 1e-9]
        leave = int(ratio.argmin())
        if not np.isfinite(ratio[leave]):
            break
        columns[:, leave] = entering
        row = inverse[leave] / change[leave]
        inverse -= np.outer(change, row)
        inverse[leave] = row
        amount = np.maximum(amount - ratio[leave] * change, 0)
        amount[leave] = ratio[leave]
    patterns = np.zeros((capacity, len(have)), np.int64)
    patterns[have] = np.rint(columns).astype(np.int64)
    return patterns, amount


def whole_patterns(demand):
    """(pattern, how often) with whole numbers that use every piece exactly once."""
    left = np.asarray(demand, np.int64).copy()
    patterns, amount = solve_patterns(left)
    out = []
    for k in np.argsort(-amount, kind="stable"):
        pattern = patterns[:, k]
        used = np.flatnonzero(pattern)
        times = min(int(np.floor(amount[k] + 1e-6)), int((left[used] // pattern[used]).min()))
        if times > 0:
            left -= times * pattern
            out.append((pattern, times))
    # What rounding leaves: the largest piece, then the best fill of the rest of its sequence.
    while left.any():
        pattern, room = np.zeros(len(left), np.int64), len(left)
        while room:
            size = np.flatnonzero(left[:room] > pattern[:room])
            if not len(size):
                break
            pattern[size[-1]] += 1
            room -= int(size[-1]) + 1
        used = np.flatnonzero(pattern)
        times = int((left[used] // pattern[used]).min())
        left -= times * pattern
        out.append((pattern, times))
    return out


def places(patterns) -> list[tuple[int, int, int, int, int]]:
    """(class, first rank, past-the-end rank, pieces per sequence, first sequence) for every use of a class."""
    rank, sequence, out = {}, 0, []
    for pattern, times in patterns:
        for k in np.flatnonzero(pattern).tolist():
            count = int(pattern[k])
            first = rank.get(k, 0)
            rank[k] = first + times * count
            out.append((k + 1, first, rank[k], count, sequence))
        sequence += times
    return out


def bundles(counts: dict[int, int], bundle: int, width: int):
    """For pieces of each short length: (length, pieces per bundle, whole bundles, class, class of the last one).

    ``counts`` says how many pieces of each length there are; the last bundle may hold fewer.
    """
    out = []
    for length, n in sorted(counts.items()):
        per = min(range(1, bundle // length + 1), key=lambda p: (-(length * p) % width / (length * p), p))
        whole, rest = divmod(n, per)
        out.append((length, per, whole, -(-length * per // width), -(-length * rest // width)))
    return out


def pack(cut: DataFrame, capacity: int = CAPACITY, width: int = WIDTH, bundle: int = BUNDLE) -> DataFrame:
    """The stored pieces with ``sequence_id`` and ``offset``; ``length`` is at most ``capacity``."""
    bundle = min(bundle, capacity)
    # Short pieces are ranked by their length, written as a negative class, the others by their class.
    classed = cut.withColumn("class", F.expr(f"CAST(IF(length <= {bundle // 2}, -length, ceil(length / {width})) AS INT)"))
    counted = {r["class"]: r["n"] for r in classed.groupBy("class").agg(F.count("*").alias("n")).collect()}
    demand = np.zeros(-(-capacity // width), np.int64)
    lists = []  # class of a piece, ranks to a bundle, whole bundles, class and first rank of those, the same of the last one
    for k, n in counted.items():
        if k > 0:
            demand[k - 1] = n
            lists.append((k, 1, n, k, 0, k, 0))
    for length, per, whole, k, last in bundles({-k: n for k, n in counted.items() if k < 0}, bundle, width):
        first = int(demand[k - 1])
        demand[k - 1] += whole
        lists.append((-length, per, whole, k, first, last, int(demand[last - 1]) if last else 0))
        if last:
            demand[last - 1] += 1
    parts = [min(MOST_PARTS, -(-counted[row[0]] // PART_ROWS)) for row in lists]
    spark = cut.sparkSession
    known = spark.createDataFrame(
        [(*row, n) for row, n in zip(lists, parts)],
        "k_class int, per bigint, whole bigint, item_class int, item_first bigint, last_class int, last_first bigint, parts int")
    slots = spark.createDataFrame(places(whole_patterns(demand)),
                                  "p_class int, first bigint, past bigint, per_sequence bigint, first_sequence bigint")

    # Both tables follow the number of classes and of patterns, not the data.
    salted = classed.join(F.broadcast(known), F.expr("class = k_class")).withColumn(
        "salt", F.expr("pmod(xxhash64(id, start, ids_crc32), parts)"))
    group, order = ["class", "salt"], ["id", "start", "ids_crc32"]
    ranked = salted.withColumn("place", F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1)
    sizes = salted.groupBy(*group).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("class").orderBy("salt").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(F.col("class").alias("s_class"), F.col("salt").alias("s_salt"), before.alias("before"))
    ranked = ranked.join(sizes, F.expr("class = s_class AND salt = s_salt")).withColumn("rank", F.expr("place + before"))
    items = ranked.withColumn("b", F.expr("rank DIV per")).withColumns({
        "item_class": F.expr("IF(b < whole, item_class, last_class)"),
        "item": F.expr("IF(b < whole, item_first + b, last_first)")})
    placed = items.join(F.broadcast(slots), F.expr("item_class = p_class AND item >= first AND item < past")).withColumn(
        "sequence_id", F.expr("first_sequence + (item - first) DIV per_sequence"))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("item_class"), "item", "rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("bigint")).select(
        *cut.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
                   end: int = END, capacity: int = CAPACITY, width: int = WIDTH, bundle: int = BUNDLE) -> DataFrame:
    """Per piece: id, ``start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    cut = materialize(pieces(docs, doc_id, text, tokenizer, end, capacity))
    return pack(cut, capacity, width, bundle).withColumnRenamed("id", doc_id)

"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables.

A unit vector, padded with zeros to a power of two, goes through three rounds of random
signs and a fast Hadamard transform; its hash is the signed axis nearest to the result. A
code is one such hash, or several for larger tables, and every table has rotations of its
own. Every row is in every table. A query probes the codes whose axes are nearest to it,
and all rows of these codes are compared with it in double precision.

How many codes a query probes is measured: the exact neighbours of a bounded sample of
queries, found by comparing it with all rows, show how far down the probing order a wanted
share of them lies. A query that finds fewer rows than it asks for probes every code.

The unit of work is a cell: a few neighbouring codes of one table, split by a hash of the
id where they hold many rows. A task keeps the rows of one cell, of bounded number, and
streams the queries past them; only the best few per query and cell leave it.

Defined results. Rows whose vector is null, empty, zero or holds a null or non-finite
entry, and rows without id, take no part. Of several rows with one id the one with the
smallest vector (in array order) counts, so repeated rows count once. Vectors of different
lengths are never compared. Equal scores go to the smaller id. A table with no query or no
row gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from slotcast.session import materialize

TABLES = 2
RECALL = 0.96
SAMPLE = 128  # queries whose exact neighbours set the number of probes
CODE_ROWS = 4096  # rows a code should hold on average, at most
CELL_VALUES = 1 << 20  # vector entries of a cell that is not split
PIECE_VALUES = 1 << 20  # vector entries worked on at a time
ROUNDS = 3
TIE = 1e-12  # scores this close are settled by the exact sum


@dataclass(frozen=True)
class Index:
    """How vectors of every length are hashed; the rows themselves are in ``rows``."""

    rows: DataFrame  # id, vec, dims, codes (one per table)
    hashes: int  # hash functions in a code
    width: int  # codes in a cell
    tables: int
    seed: int
    probes: int


def matrix(column):
    """(row numbers, vectors as doubles) of an Arrow list column, in pieces of one length and bounded size."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values, lengths = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    for n in np.unique(lengths):
        same = np.flatnonzero(lengths == n)
        step = max(1, PIECE_VALUES // max(int(n), 1))
        for a in range(0, len(same), step):
            at = same[a:a + step]
            yield at, values[starts[at][:, None] + np.arange(n)].astype(np.float64)


def scaled(x):
    """Vectors times a power of two each, so that squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])


def norms(x):
    """Lengths, summed entry by entry in order."""
    return np.sqrt(ordered_dot(x, x))


def ordered_dot(x, y):
    """Row by row dot product, summed entry by entry in order: the same for a pair wherever it is computed."""
    total = np.zeros(len(x))
    for d in range(x.shape[1]):
        total += x[:, d] * y[:, d]
    return total


def hadamard(x):
    """Fast Walsh-Hadamard transform of every row; the number of columns is a power of two."""
    n, step = x.shape[1], 1
    while step < n:
        pairs = x.reshape(len(x), n // (2 * step), 2, step)
        x = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(len(x), n)
        step *= 2
    return x


def rotated(x, seed: int, table: int, number: int):
    """One pseudo-random rotation of unit vectors: signs and Hadamard transform, three times."""
    n = 1 << max(x.shape[1] - 1, 0).bit_length()
    y = np.zeros((len(x), n))
    y[:, :x.shape[1]] = x
    signs = np.random.default_rng([seed, table, number, n]).choice([-1.0, 1.0], (ROUNDS, n))
    for s in signs:
        y = hadamard(y * s) / np.sqrt(n)
    return y


def signed(y):
    """The coordinate towards every signed axis: +1, -1, +2, -2, ..."""
    return np.stack([y, -y], 2).reshape(len(y), -1)


def codes(x, index_of: tuple[int, int, int]):
    """Code of every unit vector in every table; ``index_of`` is (hashes, tables, seed)."""
    hashes, tables, seed = index_of
    out = np.zeros((len(x), tables), np.int64)
    for t in range(tables):
        for j in range(hashes):
            y = rotated(x, seed, t, j)
            axis = np.abs(y).argmax(1)
            out[:, t] = out[:, t] * (2 * y.shape[1]) + 2 * axis + (y[np.arange(len(y)), axis] < 0)
    return out


def probing_order(x, table: int, probes: int, index_of: tuple[int, int, int]):
    """The ``probes`` codes of one table to look at first, per unit vector.

    The cost of a code is the sum, over its hashes, of the squared distance by which its axis
    is behind the nearest one; equal costs go to the smaller code. The best codes of the first
    hashes are extended by every axis of the next, so no more than probes x axes are looked at.
    """
    hashes, _, seed = index_of
    best = np.zeros((len(x), 1), np.int64)
    cost = np.zeros((len(x), 1))
    for j in range(hashes):
        toward = signed(rotated(x, seed, table, j))
        behind = (toward.max(1, keepdims=True) - toward) ** 2
        axes = behind.shape[1]
        cost = (cost[:, :, None] + behind[:, None, :]).reshape(len(x), -1)
        best = (best[:, :, None] * axes + np.arange(axes)).reshape(len(x), -1)
        order = np.lexsort((best, cost))[:, :probes]
        cost, best = np.take_along_axis(cost, order, 1), np.take_along_axis(best, order, 1)
    return best


def best_of(q, q_norm, x, x_norm, ids, k: int):
    """(query numbers, row numbers, scores): the k best rows per query, ties to the smaller id.

    A matrix product finds the rows that can be among them, an ordered sum settles the scores.
    """
    scores = (q / q_norm[:, None]) @ (x / x_norm[:, None]).T
    if scores.shape[1] > k:
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
        qi, ri = np.nonzero(scores >= least[:, None] - TIE)
    else:
        qi, ri = (a.ravel() for a in np.indices(scores.shape))
    exact = np.empty(len(qi))
    for a in range(0, len(qi), 65536):
        i, j = qi[a:a + 65536], ri[a:a + 65536]
        exact[a:a + 65536] = ordered_dot(q[i], x[j]) / (q_norm[i] * x_norm[j])
    order = np.lexsort((ids[ri], -exact, qi))
    order = order[_rank(qi[order]) < k]
    return qi[order], ri[order], exact[order]


def _rank(sorted_groups):
    return np.arange(len(sorted_groups)) - np.searchsorted(sorted_groups, sorted_groups)


def usable(df: DataFrame, id: str, vector: str) -> DataFrame:
    """``id, vec``: one row per id, without vectors that have no direction."""
    v = f"`{vector}`"
    whole = f"forall({v}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists({v}, x -> x <> 0)"
    rows = df.where(f"`{id}` IS NOT NULL AND {v} IS NOT NULL AND {whole}").selectExpr(f"CAST(`{id}` AS BIGINT) AS id", f"{v} AS vec")
    return rows.groupBy("id").agg(F.min("vec").alias("vec"))


def build(
    df: DataFrame, queries: str, id: str = "vec_id", vector: str = "embedding", neighbours: int = 5, tables: int = TABLES,
    recall: float = RECALL, sample: int = SAMPLE, seed: int = 7,
) -> Index:
    """Hashes every usable row and measures how many codes to probe for the wanted recall.

    ``queries`` is the SQL condition on ``id`` that tells the queries; at most ``sample`` of
    them, those with the smallest hash of the id, are compared with all rows for that.
    """
    rows = materialize(usable(df, id, vector))
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("d")).first()
    axes = 2 << max((size["d"] or 1) - 1, 0).bit_length()
    hashes = 1
    while size["n"] > CODE_ROWS * axes ** hashes:
        hashes += 1
    width = int(min(max(CODE_ROWS * axes ** hashes // max(size["n"], 1), 1), 8, axes))
    index_of = (hashes, tables, seed)

    def hashed(batches):
        for batch in batches:
            found = np.zeros((batch.num_rows, tables), np.int64)
            for at, x in matrix(batch.column("vec")):
                x = scaled(x)
                found[at] = codes(x / norms(x)[:, None], index_of)
            lists = pa.ListArray.from_arrays(np.arange(0, len(found) * tables + 1, tables, dtype=np.int32), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vec"), lists], ["id", "vec", "codes"])

    kind = rows.schema["vec"].dataType.simpleString()
    coded = rows.mapInArrow(hashed, f"id bigint, vec {kind}, codes array<bigint>").withColumn("dims", F.size("vec"))
    index = Index(coded, hashes, width, tables, seed, axes ** hashes)
    probes = _probes(index, rows, queries, neighbours, recall, sample, axes)
    return Index(coded, hashes, width, tables, seed, probes)


def _probes(index: Index, rows: DataFrame, queries: str, k: int, recall: float, sample: int, axes: int) -> int:
    """Codes to probe in each table so that the sample finds the wanted share of its neighbours."""
    asked = rows.where(queries).orderBy(F.xxhash64("id"), "id").limit(sample).toArrow()
    if not asked.num_rows:
        return 1
    asked_ids = asked.column("id").to_numpy()
    groups = {}
    for at, x in matrix(asked.column("vec")):
        before = groups.get(x.shape[1], (asked_ids[:0], x[:0]))
        groups[x.shape[1]] = (np.r_[before[0], asked_ids[at]], np.concatenate([before[1], scaled(x)]))

    def nearest(batches):
        for batch in batches:
            ids = batch.column("id").to_numpy()
            for at, x in matrix(batch.column("vec")):
                if x.shape[1] in groups:
                    (q_ids, q), x = groups[x.shape[1]], scaled(x)
                    qi, ri, score = best_of(q, norms(q), x, norms(x), ids[at], k + 1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(q_ids[qi]), pa.array(ids[at][ri]), pa.array(score), batch.column("codes").take(pa.array(at[ri]))],
                        ["query", "id", "score", "codes"])

    found = index.rows.drop("dims").mapInArrow(nearest, "query bigint, id bigint, score double, codes array<bigint>")
    first = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    true = found.where("query <> id").withColumn("r", F.row_number().over(first)).where(F.col("r") <= k).collect()
    needed = []
    for q_ids, q in groups.values():
        unit = q / norms(q)[:, None]
        for n, query in enumerate(q_ids):
            wanted = [r["codes"] for r in true if r["query"] == query]
            if wanted:
                depth = np.full(len(wanted), np.iinfo(np.int64).max)
                for t in range(index.tables):
                    place = _place(unit[n:n + 1], t, index, [w[t] for w in wanted])
                    depth = np.minimum(depth, place)
                needed += depth.tolist()
    if not needed:
        return 1
    return int(np.sort(needed)[int(np.ceil(recall * len(needed))) - 1]) + 1


def _place(unit, table: int, index: Index, wanted: list[int]):
    """Where in the probing order of one table given codes stand: doubles its look until all are seen."""
    axes = 2 << max(unit.shape[1] - 1, 0).bit_length()
    probes, every = 256, axes ** index.hashes
    while True:
        order = probing_order(unit, table, min(probes, every), (index.hashes, index.tables, index.seed))[0]
        place = {int(c): i for i, c in enumerate(order)}
        if probes >= every or all(c in place for c in wanted):
            return np.array([place.get(c, every) for c in wanted])
        probes *= 4


def search(index: Index, queries: str, neighbours: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest rows of every query, without its own."""
    asked = index.rows.where(queries).select("id", "vec", "dims", F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2"))
    asked = materialize(asked)
    texts = asked.groupBy("h1", "h2").agg(F.min("id").alias("qid"), F.first("vec").alias("vec"), F.first("dims").alias("dims"))
    texts = materialize(texts)  # queries with one vector are searched once
    found = materialize(_candidates(index, texts, index.probes, neighbours + 1))
    sizes = index.rows.groupBy("dims").agg(F.count("*").alias("n"))
    want = F.least(F.col("n"), F.lit(neighbours + 1))
    short = (texts.join(found.groupBy("qid").agg(F.count("*").alias("got")), "qid", "left").join(sizes, "dims")
             .where(F.coalesce("got", F.lit(0)) < want).drop("got", "n"))
    short = materialize(short)
    if not short.isEmpty():
        again = materialize(_candidates(index, short, None, neighbours + 1))
        found = found.join(short.select("qid"), "qid", "left_anti").unionByName(again)
    lists = found.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "id", "score"))).alias("best"))
    own = asked.select("id", "h1", "h2").join(texts.select("h1", "h2", "qid"), ["h1", "h2"]).join(lists, "qid")
    return own.selectExpr(
        "id AS query_id", f"posexplode(slice(filter(best, x -> x.id <> id), 1, {neighbours})) AS (at, hit)"
    ).selectExpr("query_id", "at + 1 AS rank", "hit.id AS vec_id", "hit.score AS score")


def _candidates(index: Index, texts: DataFrame, probes: int | None, k: int) -> DataFrame:
    """``qid, id, score``: the k best rows of all probed codes, per distinct query vector."""
    width, kind = index.width, index.rows.schema["vec"].dataType.simpleString()
    index_of, tables = (index.hashes, index.tables, index.seed), index.tables if probes else 1  # every code: one table has all rows

    def probed(batches):
        for batch in batches:
            for at, x in matrix(batch.column("vec")):
                x = scaled(x)
                unit, ids, dims = x / norms(x)[:, None], batch.column("qid").take(pa.array(at)), x.shape[1]
                every = (2 << max(dims - 1, 0).bit_length()) ** index_of[0]
                step = max(1, (1 << 22) // (min(probes or every, every) * 256))
                for t in range(tables):
                    for a in range(0, len(x), step):
                        part = unit[a:a + step]
                        if probes:
                            order = probing_order(part, t, min(probes, every), index_of)
                        else:
                            order = np.broadcast_to(np.arange(every), (len(part), every))
                        row = np.repeat(np.arange(len(part)), order.shape[1])
                        group, bit = (order // width).ravel(), np.int64(1) << (order % width).ravel()
                        by = np.lexsort((group, row))
                        row, group, bit = row[by], group[by], bit[by]
                        new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (group[1:] != group[:-1])])
                        mask = np.bitwise_or.reduceat(bit, new)
                        for b in range(0, len(new), 8192):
                            who = pa.array(a + row[new[b:b + 8192]])
                            n = len(who)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(n, t, np.int32)), pa.array(np.full(n, dims, np.int32)), pa.array(group[new[b:b + 8192]]),
                                 pa.array(mask[b:b + 8192]), ids.take(who), batch.column("vec").take(pa.array(at)).take(who)],
                                ["t", "dims", "g", "code", "id", "vec"])

    shape = f"t int, dims int, g bigint, code bigint, id bigint, vec {kind}"
    asked = texts.select("qid", "vec").mapInArrow(probed, shape)
    held = index.rows.selectExpr("id", "vec", "dims", f"posexplode(slice(codes, 1, {tables})) AS (t, code)").selectExpr(
        "t", "dims", f"code DIV {width} AS g", f"code % {width} AS code", "id", "vec")
    cell = ["t", "dims", "g"]
    parts = held.groupBy(*cell).agg(F.ceil(F.count("*") * F.col("dims") / CELL_VALUES).cast("int").alias("parts")).where("parts > 1")
    parts = materialize(parts)  # only cells that are to be split
    held = held.join(parts, cell, "left").withColumn(
        "s", F.coalesce(F.pmod(F.xxhash64("id"), F.col("parts")), F.lit(0)).cast("int"))
    asked = asked.join(parts, cell, "left").withColumn("s", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts") - 1, F.lit(0)))))
    both = held.selectExpr(*cell, "s", "0 AS asks", "code", "id", "vec").unionByName(
        asked.selectExpr(*cell, "s", "1 AS asks", "code", "id", "vec"))
    dealt = both.repartition(*cell, "s").sortWithinPartitions(*cell, "s", "asks")

    def compared(batches):
        now, kept = None, []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in [*cell, "s", "asks"]], 1)
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)]) if len(keys) else []
            for a, z in zip(starts, [*starts[1:], len(keys)]):
                here = tuple(keys[a, :4])
                if here != now:
                    now, kept, ready = here, [], None
                part = batch.slice(a, z - a)
                ids, code = part.column("id").to_numpy(), part.column("code").to_numpy()
                for at, x in matrix(part.column("vec")):
                    if not keys[a, 4]:
                        kept.append((ids[at], code[at], scaled(x)))
                        continue
                    if ready is None and kept:
                        ready = [np.concatenate(c) for c in zip(*kept)]
                        ready.append(norms(ready[2]))
                    if ready is not None:
                        yield _cell(ids[at], code[at], scaled(x), *ready, k)

    pairs = dealt.mapInArrow(compared, "qid bigint, id bigint, score double")
    once = pairs.groupBy("qid", "id").agg(F.max("score").alias("score"))  # several tables may find a row
    first = Window.partitionBy("qid").orderBy(F.desc("score"), "id")
    return once.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k).drop("r")


def _cell(q_ids, masks, q, ids, code, x, x_norm, k: int):
    """The k best rows of a cell for each of some queries, each compared with its own codes only."""
    q_norm, found = norms(q), []
    for c in np.unique(code):
        at, who = np.flatnonzero(code == c), np.flatnonzero(masks >> c & 1)
        for a in range(0, len(who), 256):
            w = who[a:a + 256]
            qi, ri, score = best_of(q[w], q_norm[w], x[at], x_norm[at], ids[at], k)
            found.append((w[qi], ids[at][ri], score))
    qi, ri, score = (np.concatenate(c) for c in zip(*found)) if found else (q_ids[:0], q_ids[:0], q_norm[:0])
    order = np.lexsort((ri, -score, qi))
    order = order[_rank(qi[order]) < k]
    return pa.RecordBatch.from_arrays([pa.array(q_ids[qi[order]]), pa.array(ri[order]), pa.array(score[order])], ["qid", "id", "score"])


def nearest(df: DataFrame, queries: str, id: str = "vec_id", vector: str = "embedding", neighbours: int = 5, **how) -> DataFrame:
    """Builds the index over all rows and searches it for the rows that ``queries`` (SQL on ``id``) names."""
    return search(build(df, queries, id, vector, neighbours, **how), queries, neighbours)

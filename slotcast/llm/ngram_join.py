"""Near-duplicate join: documents whose word n-gram sets have a Jaccard similarity of at least t.

1. A text's words (shared rule, A-Z lower-cased) give its n-gram hashes, a key of the whole
   word sequence and MinHash values in ``bands`` of ``rows``; the number of bands follows
   from the wished recall at exactly t. Texts with the same words are one node from here on.
2. Nodes are shuffled on (band, hash). Buckets with the same members are kept once.
3. The members of a bucket are dealt into blocks of bounded nodes and n-grams; each pair of
   blocks is one task group, which compares full n-gram sets and returns, per node, its links
   and a local label. No pair of nodes leaves a group, a member is sent once per block, and a
   pair that shares several buckets counts in the first band that holds it.
4. Labels are joined into connected components: the class.

Defined results: a text of fewer than n words, but at least one, has one gram, its words; it
links to equal texts only. Null and wordless texts link to nothing and are their own class.
Rows with equal words are copies and link to each other. The class id is the smallest id of
the class (null only if it has no other id). Rows with the same id are separate rows. Texts
of any length are compared by all their n-grams. An empty table gives no rows. Extra columns
are not read.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from slotcast.llm import textops as T
from slotcast.llm.components import connected_components
from slotcast.session import materialize

N = 5
THRESHOLD = 0.8
RECALL = 0.9999
ROWS = 6
BLOCK_NODES = 1024
BLOCK_GRAMS = 1 << 20


def bands_for(threshold: float, recall: float, rows: int) -> int:
    """Fewest bands of ``rows`` values that find a pair at the threshold with this probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))


def _grams_of(data, offsets, n: int):
    """Per slice: word counts, node key, and (hash, row) of every n-gram, sorted by row."""
    count = len(offsets) - 1
    starts, ends, rows = T.words(data, offsets, T.WORD_BYTES)
    hashes = T.Prefix(data, T.byte_values(True)).hashes(starts, ends)
    bounds = T.starts_of(rows, count)
    words = np.diff(bounds)
    # The key of a word sequence: words times powers of an odd number by their place.
    place = np.arange(len(rows)) - bounds[rows]
    with np.errstate(over="ignore"):
        power = np.multiply.accumulate(np.full(max(int(words.max(initial=0)), 1), T.U64(0xC2B2AE3D27D4EB4F)))
        key = T.mix(T.sums(hashes * power[place], bounds).astype(T.U64) + words.astype(T.U64))
    grams, first = T.grams(hashes, rows, n)
    gram_rows = rows[first]
    short = np.flatnonzero((words > 0) & (words < n))
    if len(short):
        grams, gram_rows = np.concatenate([grams, key[short]]), np.concatenate([gram_rows, short])
        order = np.argsort(gram_rows, kind="stable")
        grams, gram_rows = grams[order], gram_rows[order]
    return words, key, grams, gram_rows


def _band_hashes(grams, bounds, full, bands: int, rows: int):
    """(texts, bands) hashes of the MinHash values of the rows in ``full``, which all have grams."""
    low = (grams >> T.U64(32)).astype(np.uint32)
    factors = (T.numbers(bands * rows, 1) >> T.U64(32)).astype(np.uint32) | np.uint32(1)
    offsets = (T.numbers(bands * rows, 2) >> T.U64(32)).astype(np.uint32)
    out = np.empty((len(full), bands), T.U64)
    at = bounds[:-1][full]
    with np.errstate(over="ignore"):
        for band in range(bands):
            total = np.full(len(full), T.U64(band + 1) * T.U64(T.BASE))
            for k in range(band * rows, (band + 1) * rows):
                total = T.mix(total + np.minimum.reduceat(low * factors[k] + offsets[k], at))
            out[:, band] = total
    return out


def _list(values, width_or_offsets, kind):
    offsets = width_or_offsets
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """``id, text_hash, node, n_grams, bands`` of every row of (id, body, text_hash); node is null without words."""
    def sign(batches):
        for batch in batches:
            for first, past, data, offsets in T.slices(batch.column(1)):
                words, key, grams, gram_rows = _grams_of(data, offsets, n)
                bounds = T.starts_of(gram_rows, past - first)
                full = np.flatnonzero(words > 0)
                lists = np.zeros(past - first + 1, np.int64)
                lists[1:] = np.cumsum(np.where(words > 0, bands, 0))
                found = _band_hashes(grams, bounds, full, bands, rows) if len(full) else np.zeros((0, bands), T.U64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, past - first), batch.column(2).slice(first, past - first),
                     pa.array(key.astype(np.int64), mask=words == 0),
                     pa.array(np.diff(bounds)), _list(found.reshape(-1).astype(np.int64), lists, pa.int64())],
                    names=["id", "text_hash", "node", "n_grams", "bands"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(sign, f"id {kind}, text_hash bigint, node bigint, n_grams bigint, bands array<bigint>")


def gram_sets(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """``node, bands, grams`` (distinct, sorted) of every row of (id, body) with words."""
    def collect(batches):
        for batch in batches:
            for first, past, data, offsets in T.slices(batch.column(1)):
                words, key, grams, gram_rows = _grams_of(data, offsets, n)
                full = np.flatnonzero(words > 0)
                if not len(full):
                    continue
                bounds = T.starts_of(gram_rows, past - first)
                found = _band_hashes(grams, bounds, full, bands, rows)
                sets = [np.unique(grams[bounds[r]:bounds[r + 1]]) for r in full]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[full].astype(np.int64)),
                     _list(found.reshape(-1).astype(np.int64), np.arange(len(full) + 1) * bands, pa.int64()),
                     _list(np.concatenate(sets).astype(np.int64), np.concatenate([[0], np.cumsum([len(s) for s in sets])]),
                           pa.int64())],
                    names=["node", "bands", "grams"])

    return docs.mapInArrow(collect, "node bigint, bands array<bigint>, grams array<bigint>")


def _intersections(values, lengths):
    """Shared values of every pair of sets, as a matrix; built over bounded runs of columns."""
    n = len(lengths)
    owner = np.repeat(np.arange(n), lengths)
    _, column, count = np.unique(values, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    column, owner = column[shared], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total = np.zeros((n, n), np.float32)
    if not len(column):
        return total
    dense = np.concatenate([[0], np.cumsum(np.diff(column) != 0)])
    width = min(int(dense[-1]) + 1, max(256, (1 << 22) // n))
    for left in range(0, int(dense[-1]) + 1, width):
        lo, hi = np.searchsorted(dense, [left, left + width])
        part = np.zeros((n, width), np.float32)
        part[owner[lo:hi], dense[lo:hi] - left] = 1
        total += part @ part.T
    return total


def _linker(threshold: float):
    ratio = Fraction(str(threshold))

    def link(key, table):
        """Links of one pair of blocks of a bucket, per node: partners (with copies) and a label."""
        band, p, q = key[1].as_py(), key[2].as_py(), key[3].as_py()
        nodes = table.column("node").to_numpy()
        copies = table.column("copies").to_numpy()
        block = table.column("block").to_numpy()
        bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(nodes), -1)
        grams = table.column("grams").combine_chunks()
        lengths = np.diff(grams.offsets.to_numpy())
        open_pairs = np.triu(np.ones((len(nodes), len(nodes)), bool), 1) if p == q else block[:, None] < block[None, :]
        for k in range(band):
            open_pairs &= bands[:, k][:, None] != bands[:, k][None, :]
        found = np.zeros(len(nodes), bool)
        if open_pairs.any():
            shared = _intersections(grams.flatten().to_numpy(), lengths).astype(np.int64)
            union = lengths[:, None] + lengths[None, :] - shared
            linked = open_pairs & (shared * ratio.denominator >= union * ratio.numerator)
            linked |= linked.T
            found = linked.any(1)
        if not found.any():
            return pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "label": pa.array([], pa.int64())})
        linked, nodes, copies = linked[found][:, found], nodes[found], copies[found]
        label = np.arange(len(nodes))
        while True:
            least = np.minimum(label, np.where(linked, label[None, :], len(nodes)).min(1))
            least = least[least]
            if (least == label).all():
                break
            label = least
        return pa.table({"node": nodes, "links": linked @ copies, "label": nodes[label]})

    return link


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = N, threshold: float = THRESHOLD,
                    recall: float = RECALL, rows: int = ROWS, block_nodes: int = BLOCK_NODES,
                    block_grams: int = BLOCK_GRAMS) -> DataFrame:
    """Per input row: ``doc_id, class_id, n_links, node, class_node, text_hash``.

    ``n_links`` is the number of other rows with similarity of at least ``threshold``, copies
    included; ``node`` identifies the word sequence, ``class_node`` the class.
    """
    bands = bands_for(threshold, recall, rows)
    given = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body"), F.xxhash64(text).alias("text_hash"))
    signed = materialize(signatures(given, n, bands, rows))
    nodes = materialize(signed.where("node IS NOT NULL").groupBy("node").agg(
        F.min("id").alias("first_id"), F.count("*").alias("copies"), F.max("n_grams").alias("n_grams")))

    # One row per (node, band), then buckets of two or more; those with equal members once.
    spread = (signed.where("node IS NOT NULL").select("node", "n_grams", F.posexplode("bands").alias("band", "hash"))
              .dropDuplicates(["node", "band"]))
    buckets = spread.groupBy("band", "hash").agg(
        F.count("*").alias("n"), F.sum("n_grams").alias("grams"), F.bit_xor(F.xxhash64("node")).alias("x"),
        F.sum(F.pmod(F.xxhash64("node", F.lit(3)), F.lit(1 << 40))).alias("s")).where("n > 1")
    buckets = materialize(buckets.groupBy("n", "x", "s").agg(F.min(F.struct("band", "hash", "grams")).alias("b")).selectExpr(
        "b.band", "b.hash", f"CAST(greatest(ceil(n / {block_nodes}), ceil(b.grams / {block_grams})) AS INT) AS blocks"))
    members = materialize(spread.join(buckets, ["band", "hash"]).select("band", "hash", "blocks", "node"))

    wanted = members.select("node").distinct()
    chosen = wanted.join(nodes, "node").select(F.col("first_id").alias("w_id")).distinct()
    bodies = given.join(chosen, F.col("id").eqNullSafe(F.col("w_id")), "left_semi")
    sets = gram_sets(bodies, n, bands, rows).join(wanted, "node", "left_semi").dropDuplicates(["node"])

    units = members.join(nodes.select("node", "copies"), "node").withColumn(
        "block", F.expr("CAST(pmod(xxhash64(node, band), blocks) AS INT)")).withColumn(
        "other", F.explode(F.expr("sequence(0, blocks - 1)"))).selectExpr(
        "hash", "band", "least(block, other) AS p", "greatest(block, other) AS q", "block", "node", "copies")
    linked = materialize(units.join(sets, "node").groupBy("hash", "band", "p", "q").applyInArrow(
        _linker(threshold), "node bigint, links bigint, label bigint"))

    roots = connected_components(linked.select(F.col("node").alias("a"), F.col("label").alias("b")))
    links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    found = nodes.join(links, "node", "left").join(roots, "node", "left").select(
        "node", "first_id", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root"))
    classes = found.groupBy("root").agg(F.min("first_id").alias("class_id"))
    found = materialize(found.join(classes, "root").selectExpr("node AS f_node", "root", "class_id", "copies - 1 + links AS n_links"))
    joined = signed.select("id", "text_hash", "node").join(found, F.col("node") == F.col("f_node"), "left")
    return joined.select(
        F.col("id").alias(doc_id), F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), "node", F.col("root").alias("class_node"), "text_hash")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, one per class: that with the class id (of equal ids, one).

    Rows without words are no copies of each other; all of them stay.
    """
    found = near_duplicates(docs, doc_id, text, **options).where("node IS NOT NULL")
    keep = found.where(F.col(doc_id).eqNullSafe(F.col("class_id"))).groupBy("class_node").agg(
        F.min(doc_id).alias("k_id"), F.min("text_hash").alias("k_hash"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(doc_id).alias("id"),
                       F.xxhash64(text).alias("hash"))
    worded = F.coalesce(F.col(f"row.`{text}`").rlike(r"[0-9A-Za-z\x{80}-\x{10FFFF}]"), F.lit(False))
    stay = rows.where(worded).join(keep, F.expr("id <=> k_id AND hash = k_hash"), "left_semi").dropDuplicates(["id", "hash"])
    return stay.unionAll(rows.where(~worded)).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])

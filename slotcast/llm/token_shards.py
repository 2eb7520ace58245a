"""Token ids in training order: fixed-stride binary shards in a keyed random permutation.

1. Texts' ids, each with the end id, are laid end to end within an input partition and cut
   into sequences of ``stride`` ids. A first pass only counts the sequences of each partition,
   which numbers them 0 .. N-1 over all partitions.
2. A keyed Feistel network over the next power of four, walked until the value is below N, is
   a permutation of 0 .. N-1: the sequence's slot, computed without any table.
3. A second pass sends every sequence to the shard ``slot // per_shard``. A shard is written in
   slot order, so the sequence in a slot starts at byte ``(slot % per_shard) * stride * 2`` or
   ``* 4``: training reads files from any slot on, one after the other.

Ids below 2**16 are stored as unsigned 16-bit, others as 32-bit little-endian numbers. Both
passes must see the same partitions: each compares a checksum of its ids with the first pass,
and if Spark cut the input anew in between (another number of executors), both are repeated.
Files appear under their names only when whole, so lost or repeated tasks leave no trace.

Defined results: a null or empty text is its end id. The last sequence of a partition is
filled with the end id; the index has its true length. No rows give no shards. Repeated rows
are written as often as they occur. A text of any length is cut into as many sequences as it
fills. Extra columns are not read.
"""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from slotcast.llm import files, textops as T, tokens

STRIDE = 2048
PER_SHARD = 8192
END = 1
ROUNDS = 6
TRIES = 3


class Permutation:
    """Keyed bijection of 0 .. n-1."""

    def __init__(self, n: int, key: int):
        self.n, self.half = n, T.U64(max(1, -(-(max(n, 2) - 1).bit_length() // 2)))
        self.mask = (T.U64(1) << self.half) - T.U64(1)
        self.keys = T.numbers(ROUNDS, key)

    def _pass(self, x, keys, back: bool):
        left, right = x >> self.half, x & self.mask
        with np.errstate(over="ignore"):
            for key in keys:
                if back:
                    left, right = right ^ (T.mix(left + key) & self.mask), left
                else:
                    left, right = right, left ^ (T.mix(right + key) & self.mask)
        return (left << self.half) | right

    def _walk(self, x, keys, back):
        x = self._pass(np.asarray(x, T.U64), keys, back)
        while (out := x >= T.U64(self.n)).any():
            x[out] = self._pass(x[out], keys, back)
        return x.astype(np.int64)

    def slot(self, index):
        return self._walk(index, self.keys, False)

    def index(self, slot):
        return self._walk(slot, self.keys[::-1], True)


def _sequences(batches, encoder, stride: int, end: int):
    """(ids, true length, ids of the documents in it, checksum so far) of every sequence of a partition."""
    rest, owners, crc = np.zeros(0, np.uint32), [], 0
    for batch in batches:
        for first, past, ids, bounds in encoder.encode(batch.column(1)):
            ids, bounds = tokens.with_end(ids, bounds, end)
            crc = zlib.crc32(ids.tobytes(), crc)
            names = batch.column(0).slice(first, past - first).to_pylist()
            owners += [(len(rest) + int(b), n) for b, n in zip(bounds[1:], names)]
            rest = np.concatenate([rest, ids])
            whole, at = len(rest) // stride * stride, 0
            for start in range(0, whole, stride):
                inside = []
                while at < len(owners):
                    inside.append(owners[at][1])
                    if owners[at][0] > start + stride:
                        break
                    at += 1
                    if owners[at - 1][0] == start + stride:
                        break
                yield rest[start:start + stride], stride, inside, crc
            rest, owners = rest[whole:], [(b - whole, n) for b, n in owners[at:]]
    if len(rest):
        yield np.concatenate([rest, np.full(stride - len(rest), end, np.uint32)]), len(rest), [n for _, n in owners], crc


def _given(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body"))


def _width(path: str) -> str:
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def write(docs: DataFrame, out: str, key: int, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
          stride: int = STRIDE, per_shard: int = PER_SHARD, end: int = END) -> dict:
    """Writes shards and index of all documents below ``out``; returns what a reader needs to know."""
    spark, path = docs.sparkSession, tokenizer or tokens.default_path()
    out, kind, given = files.qualified(spark, out), _width(path), _given(docs, doc_id, text)
    for attempt in range(TRIES):
        try:
            return _write(spark, given, f"{out}/try-{attempt}", key, path, kind, stride, per_shard, end)
        except Exception as error:
            if "partitions have changed" not in str(error) or attempt + 1 == TRIES:
                raise
    raise AssertionError


def _write(spark: SparkSession, given: DataFrame, out: str, key: int, path: str, kind: str, stride: int, per_shard: int,
           end: int) -> dict:
    def count(batches):
        n = crc = 0
        for _, _, _, crc in _sequences(batches, tokens.encoder(path), stride, end):
            n += 1
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([n]), pa.array([crc])],
                                         names=["part", "n", "crc"])

    # One row per input partition: the only thing that passes the driver.
    parts = {r["part"]: (r["n"], r["crc"]) for r in given.mapInArrow(count, "part int, n bigint, crc bigint").collect()}
    size = max(parts, default=-1) + 1
    counts = np.array([parts.get(p, (0, 0))[0] for p in range(size)], np.int64)
    checks = np.array([parts.get(p, (0, 0))[1] for p in range(size)], np.int64)
    base, total = np.cumsum(counts) - counts, int(counts.sum())
    shards = -(-total // per_shard)
    order = Permutation(total, key)
    name = given.schema["id"].dataType.simpleString()

    def place(batches):
        part = TaskContext.get().partitionId()
        if part >= size:
            if any(batch.num_rows for batch in batches):
                raise RuntimeError("partitions have changed")
            return
        n, crc, held = 0, 0, []

        def flush():
            index = base[part] + np.arange(n - len(held), n)
            return pa.RecordBatch.from_arrays(
                [pa.array(order.slot(index)), pa.array(index), pa.array([h[1] for h in held], pa.int32()),
                 pa.array([h[2] for h in held], pa.list_(id_type)),
                 pa.array([h[0] for h in held], pa.binary())], names=["slot", "index", "n_tokens", "doc_ids", "ids"])

        first = next(batches, None)
        id_type = pa.null() if first is None else first.schema.field(0).type
        given_batches = itertools.chain(() if first is None else (first,), batches)
        for ids, length, owners, crc in _sequences(given_batches, tokens.encoder(path), stride, end):
            n += 1
            if n > counts[part]:
                raise RuntimeError("partitions have changed")
            held.append((pa.compress(ids.astype(kind).tobytes(), codec="zstd", asbytes=True), length, owners))
            if len(held) == 256:
                yield flush()
                held = []
        if held:
            yield flush()
        if n != counts[part] or crc != checks[part]:
            raise RuntimeError("partitions have changed")

    raw = stride * np.dtype(kind).itemsize

    def store(batches):
        output = shard = None
        for batch in batches:
            slots = batch.column("slot").to_numpy()
            offsets, crcs = [], []
            for slot, packed in zip(slots.tolist(), batch.column("ids")):
                if slot // per_shard != shard:
                    if output is not None:
                        output.publish()
                    shard = slot // per_shard
                    output = files.Output(f"{out}/shards", f"shard-{shard:06d}.bin")
                data = pa.decompress(packed.as_buffer(), decompressed_size=raw, codec="zstd", asbytes=True)
                offsets.append(output.write(data))
                crcs.append(zlib.crc32(data))
            yield pa.RecordBatch.from_arrays(
                [batch.column("slot"), pa.array(slots // per_shard), pa.array(offsets, pa.int64()), batch.column("index"),
                 batch.column("n_tokens"), pa.array(crcs, pa.int64()), batch.column("doc_ids")],
                names=["slot", "shard", "offset", "index", "n_tokens", "crc32", "doc_ids"])
        if output is not None:
            output.publish()

    placed = given.mapInArrow(place, f"slot bigint, index bigint, n_tokens int, doc_ids array<{name}>, ids binary")
    # Slots in order, a shard to a partition: a range partitioning whose bounds are known, so nothing is sampled.
    dealt = placed.repartitionById(max(1, shards), F.expr(f"CAST(slot DIV {per_shard} AS INT)")).sortWithinPartitions("slot")
    schema = f"slot bigint, shard bigint, offset bigint, index bigint, n_tokens int, crc32 bigint, doc_ids array<{name}>"
    dealt.mapInArrow(store, schema).write.parquet(f"{out}/index")
    return {"path": out, "sequences": total, "stride": stride, "per_shard": per_shard, "dtype": kind, "key": key, "end": end}


def index(spark: SparkSession, made: dict) -> DataFrame:
    """``slot, shard, offset, index, n_tokens, crc32, doc_ids`` of every sequence."""
    return spark.read.parquet(f"{made['path']}/index")


def read(spark: SparkSession, made: dict, start: int = 0, stop: int | None = None, block: int = 256) -> DataFrame:
    """``slot, ids`` (bytes) of the slots from ``start`` to before ``stop``, by sequential reads of each shard."""
    stop = made["sequences"] if stop is None else min(stop, made["sequences"])
    path, per_shard, raw = made["path"], made["per_shard"], made["stride"] * np.dtype(made["dtype"]).itemsize
    shards = max(0, -(-stop // per_shard) - start // per_shard) if stop > start else 0

    def fetch(batches):
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                at, past = max(start, shard * per_shard), min(stop, (shard + 1) * per_shard)
                with files.ranges(f"{path}/shards", f"shard-{shard:06d}.bin") as stream:
                    stream.seek((at - shard * per_shard) * raw)
                    while at < past:
                        n = min(block, past - at)
                        data = stream.read(n * raw)
                        if len(data) < n * raw:
                            raise EOFError(f"shard {shard} ends early")
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.arange(at, at + n)), pa.array([data[i * raw:(i + 1) * raw] for i in range(n)], pa.binary())],
                            names=["slot", "ids"])
                        at += n

    return spark.range(start // per_shard, start // per_shard + shards, 1, max(1, shards)).mapInArrow(fetch, "slot bigint, ids binary")

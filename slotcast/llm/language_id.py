"""Language identification with error-correcting output codes.

Every language has a codeword of bits. One binary classifier per bit, a logistic regression
on hashed letter 1- to 3-grams, predicts that bit from the whole text; the language whose
codeword has the least loss against all predicted bits wins, each bit weighted by how
reliable it was on rows held back from its fit. Up to ``FULL_CODE`` languages have all
distinct splits as bits, more have a random code chosen for the distance between codewords.

The classifiers are fitted on at most ``per_language`` rows of each language and
``train_rows`` in all (those with the smallest hash), in one task. Only the weights and the
codewords travel to the scoring tasks. Language, source and id are no inputs of a prediction.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and not
ambiguous; without any labelled row all are. With one learned language every other text gets
it, with score 1. Labels that are null teach nothing. Of languages with equal losses the first in
alphabetical order is predicted. Texts of any length are read whole, a slice at a time. Repeated
rows each get a row; extra columns are not read.
"""

from __future__ import annotations

import itertools
import math
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from slotcast.llm import linear, textops as T
from slotcast.llm.tokens import worker_state

BUCKETS = 1 << 13
PER_LANGUAGE = 250
TRAIN_ROWS = 4000
FULL_CODE = 5
MARGIN = 0.2
UNKNOWN = "und"
ROWS = 256  # texts whose dense counts are held at a time


def codewords(languages: int, seed: int = 5) -> np.ndarray:
    """(languages, bits) of 0/1: rows far apart, no bit constant, no bit twice or inverted."""
    if languages < 2:
        return np.zeros((languages, 0), np.int8)
    if languages <= FULL_CODE:
        splits = [bits for bits in itertools.product((0, 1), repeat=languages) if bits[0] == 1 and not all(bits)]
        return np.array(splits, np.int8).T
    bits, rng, best, distance = math.ceil(10 * math.log2(languages)), np.random.default_rng(seed), None, -1
    for _ in range(50):
        code = np.unique(rng.integers(0, 2, (4 * bits, languages), dtype=np.int8) ^ 0, axis=0)
        code[code[:, 0] == 0] ^= 1
        code = np.unique(code, axis=0)
        code = rng.permutation(code[code.min(1) != code.max(1)])[:bits].T
        apart = (code[:, None, :] != code[None, :, :]).sum(2)
        least = apart[~np.eye(languages, dtype=bool)].min()
        if least > distance:
            best, distance = code, least
    return best


def _tables():
    """Lower-case letter of every code point, 0 for what is no letter; kept by the worker."""
    kept = worker_state()
    if "letters" not in kept:
        table = np.zeros(0x110000, np.uint32)
        for cp in range(0x110000):
            char = chr(cp)
            if unicodedata.category(char)[0] == "L":
                low = char.lower()
                table[cp] = ord(low) if len(low) == 1 else cp
        kept["letters"] = table
    return kept["letters"]


def features(column):
    """(first row, past-the-end row, (rows, buckets) roots of n-gram shares, whether it has a letter)."""
    letters = _tables()
    factors = (T.numbers(6, 21) >> T.U64(32)).astype(np.uint32) | np.uint32(1)
    for first, past, data, byte_offsets in T.slices(column, rows=ROWS):
        n = past - first
        points = letters[np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)]
        leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        rows = np.repeat(np.arange(n), np.diff(leads[byte_offsets]))
        # A run of other signs is one gap.
        keep = points > 0
        keep[1:] |= (points[:-1] > 0) & (rows[1:] == rows[:-1])
        points, rows = points[keep], rows[keep]
        counts = np.zeros(n * BUCKETS)
        with np.errstate(over="ignore"):
            for size in (1, 2, 3):
                if len(points) < size:
                    continue
                h = points[:len(points) - size + 1] * factors[size]
                for k in range(1, size):
                    h = (h ^ (h >> np.uint32(15))) * factors[size + k] + points[k:len(points) - size + 1 + k] * factors[k]
                h = (h ^ (h >> np.uint32(13))) * factors[0]
                whole = rows[:len(rows) - size + 1] == rows[size - 1:]
                if size == 1:
                    whole = points > 0
                at = rows[:len(whole)][whole] * BUCKETS + (h >> np.uint32(32 - BUCKETS.bit_length() + 1))[whole]
                counts += np.bincount(at, minlength=n * BUCKETS)
        counts = counts.reshape(n, BUCKETS)
        total = counts.sum(1, keepdims=True)
        yield first, past, np.sqrt(counts / np.maximum(total, 1)).astype(np.float32), total[:, 0] > 0


def train(docs: DataFrame, text: str = "text", label: str = "lang", doc_id: str = "doc_id",
          per_language: int = PER_LANGUAGE, train_rows: int = TRAIN_ROWS) -> dict:
    """Codewords, weights and bit reliabilities learned from the labelled rows of ``docs``."""
    known = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(label).cast("string").alias("y"), F.col(text).alias("body"), F.xxhash64(doc_id, text).alias("h"))
    size = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}  # one row per language
    if not size:
        return {"languages": []}
    each = max(1, min(per_language, train_rows // len(size)))
    spark = docs.sparkSession
    quota = spark.createDataFrame([(y, int(min(1.0, 2.0 * each / n) * (1 << 30))) for y, n in size.items()], "q_y string, q bigint")
    near = known.join(F.broadcast(quota), F.col("y") == F.col("q_y")).where(F.expr(f"pmod(xxhash64(h, 5), {1 << 30}) < q"))
    rank = F.row_number().over(Window.partitionBy("y").orderBy(F.expr(f"pmod(xxhash64(h, 5), {1 << 30})"), "h"))
    sample = near.withColumn("rank", rank).where(f"rank <= {each}").select("y", "body", "h")

    def learn(batches):
        table = pa.Table.from_batches(list(batches))
        if not len(table):
            return
        names = np.array(table.column("y").to_pylist())
        blocks = [(x, has) for _, _, x, has in features(table.column("body"))]
        x, has = np.vstack([b[0] for b in blocks]), np.concatenate([b[1] for b in blocks])
        x, names, h = x[has], names[has], table.column("h").to_numpy()[has]
        languages = sorted(set(names.tolist()))
        code = codewords(len(languages))
        row = np.searchsorted(languages, names)
        held = (h % 5 == 0) if len(set(row[h % 5 != 0].tolist())) == len(languages) else np.zeros(len(h), bool)
        share = (1.0 / (np.bincount(row[~held], minlength=len(languages)) * len(languages)))[row[~held], None]
        w, b = linear.fit(x[~held], code[row[~held]], share) if code.size else (np.zeros((BUCKETS, 0), "f4"), np.zeros(0, "f4"))
        judged = held if held.any() else np.ones(len(h), bool)
        right = ((x[judged] @ w + b > 0) == code[row[judged]]).mean(0)
        weight = np.maximum(2 * right - 1, 0.01)
        yield pa.RecordBatch.from_pydict({
            "languages": [languages], "w": [w.astype("<f4").tobytes()], "b": [b.astype(float).tolist()],
            "weight": [(weight / max(weight.sum(), 1e-9)).tolist()]}, schema=pa.schema([
                ("languages", pa.list_(pa.string())), ("w", pa.binary()), ("b", pa.list_(pa.float64())), ("weight", pa.list_(pa.float64()))]))

    found = sample.coalesce(1).mapInArrow(learn, "languages array<string>, w binary, b array<double>, weight array<double>").collect()
    if not found:
        return {"languages": []}
    bits = len(found[0]["b"])
    return {"languages": list(found[0]["languages"]), "code": codewords(len(found[0]["languages"])),
            "w": np.frombuffer(found[0]["w"], "<f4").reshape(BUCKETS, bits), "b": np.array(found[0]["b"], np.float32),
            "weight": np.array(found[0]["weight"])}


def decode(model: dict, margins):
    """(best language, second best, score, gap) of every row of bit margins."""
    sign = 2.0 * model["code"] - 1
    loss = np.logaddexp(0, -margins[:, None, :] * sign[None, :, :]) @ model["weight"]
    order = np.argsort(loss, 1, kind="stable")
    rows = np.arange(len(loss))
    best, second = order[:, 0], order[:, min(1, loss.shape[1] - 1)]
    # Losses are means over the bits; scaled by the bits they are log likelihoods.
    likely = np.exp(-(loss - loss.min(1, keepdims=True)) * margins.shape[1])
    gap = loss[rows, second] - loss[rows, best]
    return best, second, 1.0 / likely.sum(1), gap


def identify(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text", margin: float = MARGIN) -> DataFrame:
    """Per input row: id, ``lang_pred, score, runner_up, ambiguous``."""
    languages = np.array(model["languages"], object)

    def predict(batches):
        for batch in batches:
            for first, past, x, has in features(batch.column(1)):
                n = past - first
                if not len(languages):
                    has = np.zeros(n, bool)
                if len(languages) > 1:
                    best, second, score, gap = decode(model, x @ model["w"] + model["b"])
                    name, other, doubt = languages[best], languages[second], has & (gap < margin)
                else:
                    name = np.full(n, languages[0] if len(languages) else UNKNOWN, object)
                    other, score, doubt = np.full(n, None, object), np.ones(n), np.zeros(n, bool)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(np.where(has, name, UNKNOWN), pa.string()),
                     pa.array(np.where(has, score, 0.0), pa.float64()), pa.array(np.where(has, other, None), pa.string()),
                     pa.array(doubt)], names=["id", "lang_pred", "score", "runner_up", "ambiguous"])

    given = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body"))
    kind = given.schema["id"].dataType.simpleString()
    out = given.mapInArrow(predict, f"id {kind}, lang_pred string, score double, runner_up string, ambiguous boolean")
    return out.withColumnRenamed("id", doc_id)

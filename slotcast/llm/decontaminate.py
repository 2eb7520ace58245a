"""Benchmark decontamination: word windows of test items found in training documents.

Test items become windows of ``window`` consecutive words; an item with fewer words, but at
least one, is a single window. The windows' 64-bit hashes form a hash set that is broadcast
when its measured size is within ``broadcast_bytes``; beyond that a merge join shuffles on the
hash. Each document's windows are hashed in the scan; a table of marks, a few per window of the
benchmark and of bounded size, tells most of them apart at once, the others are probed, and
every probe hit is verified by comparing the words themselves. Only hits leave the scan; with
the merge join marked windows do, each with its own words and nothing else of the text.

Defined results: a null or empty text has no words and no hits. Texts of any length are
read whole. Repeated rows each get the
result of their text. Rows are matched by (id, hash of the text), so a repeated or null id
is no key. An empty benchmark leaves all documents clean. A null item id counts as ''.
Extra columns, whatever their names, are neither read nor changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from slotcast.llm.words import RAW_WORD, raw_words, word_array
from slotcast.session import materialize

WINDOW = 10
BROADCAST_BYTES = 64 << 20


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct (item, b_len, b_hash, b_words) of all windows of the items."""
    words = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
                         F.explode(F.expr(f"array({word_array(f'`{text}`')})")).alias("words")).where("size(words) > 0")
    length = f"least({window}, size(words))"
    return (words
            .selectExpr("item", f"explode(transform(sequence(1, size(words) - {length} + 1), "
                                f"i -> slice(words, i, {length}))) AS b_words")
            .distinct()
            .selectExpr("item", "size(b_words) AS b_len", "transform(b_words, w -> xxhash64(w)) AS h", "b_words")
            .selectExpr("item", "b_len", f"CASE b_len {' '.join(f'WHEN {n} THEN {_window_hash(n)}' for n in range(1, window + 1))} "
                        "END AS b_hash", "b_words"))


def _window_hash(length: int, start: str = "0") -> str:
    """SQL for the hash of ``length`` word hashes of the array h, from a place on."""
    return f"xxhash64({', '.join(f'h[{start} + {k}]' for k in range(length))})"


MARK_BITS, MOST_MARK_BITS, MARK = 18, 22, b"\x01"


def _marks(grams: DataFrame) -> tuple[bytearray, int]:
    """One byte per value of the hashes' first bits, set where an item's window has that value; and how many bits.

    There are at least sixteen bytes per window, up to a fixed size; beyond it more windows of
    documents pass on to the hash set itself.
    """
    windows = grams.agg(F.count("*")).first()[0]
    bits = min(max(MARK_BITS, (16 * windows).bit_length()), MOST_MARK_BITS)
    marks = bytearray(1 << bits)
    for r in grams.select(F.shiftrightunsigned("b_hash", 64 - bits).alias("at")).distinct().toLocalIterator():
        marks[r["at"]] = MARK[0]
    return marks, bits


def window_hits(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per contaminated (id, text hash): ``id, th, spans, items``.

    ``spans`` are sorted (first, past-the-end) word positions of verified windows, ``items``
    the sorted ids of the items they belong to.
    """
    grams = materialize(item_windows(items, item_id, item_text, window))
    size = grams.agg(F.sum(F.expr("aggregate(b_words, 96L, (a, w) -> a + octet_length(w) + 16)")).alias("bytes"),
                     F.sort_array(F.collect_set("b_len")).alias("lengths")).first()  # at most `window` lengths
    lengths = size["lengths"] or [window]
    probe = F.broadcast(grams) if (size["bytes"] or 0) <= broadcast_bytes else grams.hint("merge")
    marks, bits = _marks(grams)
    marks = F.lit(marks)

    def marked(n: int):
        """Places of the windows of n words whose hash has a mark."""
        return F.filter(F.sequence(F.lit(0), F.size("h") - n), lambda i: F.substring(
            marks, F.shiftrightunsigned(F.xxhash64(*[F.get("h", i + k) for k in range(n)]), 64 - bits).cast("int") + 1, F.lit(1)) == F.lit(MARK))

    places = F.coalesce(*[F.when(F.col("len") == n, marked(n)) for n in lengths])
    hashes = " ".join(f"WHEN {n} THEN {_window_hash(n, 'pos')}" for n in lengths)
    # Each generator keeps the optimizer from evaluating the word split once per window. The words
    # go along with marked windows only: those of items, and few others.
    scan = (docs
            .select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("th"),
                    F.explode(F.expr(f"array({word_array(f'`{text}`')})")).alias("words"))
            .where(f"size(words) >= {min(lengths)}")
            .selectExpr("*", "explode(array(transform(words, w -> xxhash64(w)))) AS h")
            .selectExpr("*", f"explode(filter(array({', '.join(map(str, lengths))}), l -> l <= size(words))) AS len")
            .select("*", F.explode(places).alias("pos"))
            .selectExpr("id", "th", "len", "pos", "slice(words, pos + 1, len) AS here", f"CASE len {hashes} END AS hash"))
    hits = scan.join(probe, F.expr("hash = b_hash AND len = b_len AND here = b_words"))
    return (hits.selectExpr("id", "th", "struct(pos AS first, pos + len AS past) AS span", "item")
            .groupBy("id", "th")
            .agg(F.sort_array(F.collect_set("span")).alias("spans"), F.sort_array(F.collect_set("item")).alias("items")))


COVERED = ("aggregate(spans, struct(0 AS n, 0 AS past), (a, s) -> struct("
           "a.n + greatest(0, s.past - greatest(a.past, s.first)) AS n, greatest(a.past, s.past) AS past)).n")


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per input row: id, ``n_words, n_hit, n_items, items, contaminated``."""
    hits = window_hits(docs, items, doc_id, text, item_id, item_text, window)
    hits = hits.selectExpr("id AS h_id", "th AS h_th", f"{COVERED} AS covered", "items AS found")
    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("th"),
                       F.expr(f"coalesce(size({raw_words(f'`{text}`')}), 0)").alias("words"))
    joined = rows.join(hits, F.expr("id <=> h_id AND th = h_th"), "left")
    return joined.select(
        F.col("id").alias(doc_id), F.expr("CAST(greatest(words, 0) AS BIGINT)").alias("n_words"),
        F.expr("CAST(coalesce(covered, 0) AS BIGINT)").alias("n_hit"),
        F.expr("CAST(coalesce(size(found), 0) AS BIGINT)").alias("n_items"),
        F.expr("coalesce(found, array())").alias("items"), F.expr("coalesce(covered, 0) > 0").alias("contaminated"))


def remove_documents(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, without those that hold a window of an item."""
    hits = window_hits(docs, items, doc_id, text, item_id, item_text, window).select("id", "th")
    return docs.join(hits, docs[doc_id].eqNullSafe(hits["id"]) & (F.xxhash64(docs[text]) == hits["th"]), "left_anti")


def remove_spans(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, with the words inside hit windows cut out of the text."""
    hits = window_hits(docs, items, doc_id, text, item_id, item_text, window).select("id", "th", "spans")
    joined = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("d_id"), F.xxhash64(text).alias("d_th")).join(
        hits, F.expr("d_id <=> id AND d_th = th"), "left")
    word = RAW_WORD.replace("\\", "\\\\")
    source = f"row.`{text}`"
    # Split at the words gives the separators around them: one more than there are words.
    cut = (f"CASE WHEN spans IS NULL THEN {source} ELSE array_join(zip_with(split({source}, '{word}', -1), "
           f"transform(regexp_extract_all({source}, '{word}', 0), "
           "(w, i) -> IF(exists(spans, s -> s.first <= i AND i < s.past), '', w)), "
           "(gap, w) -> concat(gap, coalesce(w, ''))), '') END")
    return joined.select(*[(F.expr(cut) if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])

"""The operators as queries over a table folder, and their SQL twins where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from slotcast.llm import (
    cross_polytope, decontaminate, language_id, license_scan, ngram_join, packing, pii, prefix_trie, quality, token_counts, token_shards,
    warc, whitening,
)
from slotcast.llm.words import SEPARATOR, UPPER
from slotcast.session import scratch_path

QUERIES, ORACLES = {}, {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op4_license_scan(spark, sf_dir):
    """Best licence per document, with its Dice coefficient and the number of matching segments."""
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("hits")


@query
def op9_decontamination(spark, sf_dir):
    """Words of each document inside windows of benchmark items."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.selectExpr("doc_id", "n_words", "n_hit", "n_items",
                            "sha2(array_join(items, ','), 256) AS items_sha256", "contaminated")


SQL_WORD = SEPARATOR.replace("[", "[^", 1)


def sql_words(text: str) -> str:
    return f"regexp_extract_all(translate({text}, '{UPPER}', '{UPPER.lower()}'), '{SQL_WORD}')"


ORACLES["op9_decontamination"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({sql_words('text')}, []) AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {sql_words('text')} AS w FROM benchmark),
n AS (SELECT DISTINCT item, least({decontaminate.WINDOW}, len(w)) AS l, unnest(list_transform(
      range(1, len(w) - least({decontaminate.WINDOW}, len(w)) + 2),
      lambda i: list_slice(w, i, i + least({decontaminate.WINDOW}, len(w)) - 1))) AS win FROM b WHERE len(w) > 0),
s AS (SELECT r, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM n) WHERE len(w) >= l),
h AS (SELECT s.r, s.i, s.l, n.item FROM s JOIN d ON d.r = s.r JOIN n ON n.l = s.l AND n.win = list_slice(d.w, s.i, s.i + s.l - 1)),
c AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + l)) AS p FROM h) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)"""

ORACLES["op4_license_scan"] = license_scan.oracle(sql_words)


@query
def op5_quality(spark, sf_dir):
    """Base counts of every text and the calibrated classifier's verdict."""
    docs = table(spark, sf_dir, "documents")
    return quality.rate(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@query
def op1_ngram_jaccard(spark, sf_dir):
    """Class and number of links of every document: word 5-gram Jaccard of at least 0.8."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


# All pairs that share a gram, then the classes by repeated spreading of the smallest id.
ORACLES["op1_ngram_jaccard"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, {sql_words('text')} AS w FROM documents),
v AS (SELECT min(doc_id) AS node, count(*) AS copies, w FROM d WHERE len(w) > 0 GROUP BY w),
g AS (SELECT node, unnest(list_distinct(list_transform(range(1, greatest(len(w) - {ngram_join.N - 1}, 1) + 1),
      lambda i: list_slice(w, i, i + {ngram_join.N - 1})))) AS gram FROM v),
n AS (SELECT node, count(*) AS n FROM g GROUP BY node),
p AS (SELECT a.node AS a, b.node AS b, count(*) AS i FROM g a JOIN g b ON a.gram = b.gram AND a.node <> b.node GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.node = a JOIN n y ON y.node = b WHERE 10 * i >= 8 * (x.n + y.n - i)),
r(a, b) AS (SELECT node, node FROM v UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
c AS (SELECT a AS node, min(b) AS class_id FROM r GROUP BY a),
k AS (SELECT l.a AS node, sum(v.copies) AS links FROM l JOIN v ON v.node = l.b GROUP BY l.a)
SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id,
       CAST(coalesce(v.copies - 1, 0) + coalesce(k.links, 0) AS BIGINT) AS n_links
FROM d LEFT JOIN v ON v.w = d.w LEFT JOIN c ON c.node = v.node LEFT JOIN k ON k.node = v.node"""


@query
def op6_packing(spark, sf_dir):
    """Pieces of all documents packed into sequences of at most 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op7_pii_surrogates(spark, sf_dir):
    """Every text with keyed surrogates in place of personal data, and the number of mentions."""
    return pii.replaced(table(spark, sf_dir, "documents")).selectExpr("row.doc_id", "clean AS text", "n_mentions")


HELD_OUT = "coalesce(crc32(CAST(doc_id AS STRING)) % 3 = 1, false)"


@query
def op3_language_id(spark, sf_dir):
    """Predicted language of every text; a third of the documents, by id, teaches nothing."""
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(f"NOT {HELD_OUT}"))
    return language_id.identify(docs, model).selectExpr(
        "doc_id", f"{HELD_OUT} AS held_out", "lang_pred", "score", "runner_up", "ambiguous")


@query
def op8_training_order(spark, sf_dir):
    """Every sequence's place in the shards, with the checksum of what is read back from there."""
    made = token_shards.write(table(spark, sf_dir, "documents"), scratch_path(spark, "shards"), key=20240601)
    back = token_shards.read(spark, made).selectExpr("slot", "crc32(ids) AS ids_crc32")
    # the planner sees a few shards, not the sequences read from them, and would broadcast that side
    return token_shards.index(spark, made).drop("crc32").join(back.hint("merge"), "slot")


# What a document's text becomes before each version of its counts is taken.
COUNTED = {"byte_bpe_50k/1": "text", "byte_bpe_50k-uncased/1": f"translate(text, '{UPPER}', '{UPPER.lower()}')"}
BLANK = r"concat(' ', '\t', '\n', '\r')"
COPY_SALTS = 16


def later_copies(docs: DataFrame) -> DataFrame:
    """``doc_id`` of every document with a text that a smaller id has too; a very common text is dealt over salts."""
    texts = docs.selectExpr("doc_id", "sha2(text, 256) AS h").where("h IS NOT NULL AND doc_id IS NOT NULL")
    first = texts.groupBy("h").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first <> last")
    first = first.selectExpr("h", "first", f"explode(sequence(0, {COPY_SALTS - 1})) AS salt")
    salted = texts.withColumn("salt", F.expr(f"CAST(pmod(xxhash64(doc_id), {COPY_SALTS}) AS INT)"))
    return salted.join(first, ["h", "salt"]).where("doc_id <> first").select("doc_id")


@query
def op10_token_counts(spark, sf_dir):
    """Totals of two versions after three batches: all documents are counted, those that lose outer blanks are
    revised, and later copies of a text are deleted."""
    docs = table(spark, sf_dir, "documents")
    store = token_counts.create(spark, scratch_path(spark, "counts"))

    def counts(rows: DataFrame, op: str) -> DataFrame:
        parts = [token_counts.count_tokens(rows.withColumn("text", F.expr(body)), version) for version, body in COUNTED.items()]
        return parts[0].unionAll(parts[1]).selectExpr("*", f"'{op}' AS op", "0 AS seq")

    inserts = counts(docs, "insert")
    token_counts.apply_batch(spark, store, "load", inserts)
    token_counts.apply_batch(spark, store, "load", inserts)  # a repeated commit changes nothing
    trimmed = docs.withColumn("trimmed", F.expr(f"btrim(text, {BLANK})")).where("trimmed <> text AND doc_id IS NOT NULL")
    token_counts.apply_batch(spark, store, "trimmed", counts(trimmed.drop("text").withColumnRenamed("trimmed", "text"), "revise"))
    versions = ", ".join(f"'{v}'" for v in COUNTED)
    token_counts.apply_batch(spark, store, "copies", later_copies(docs).selectExpr(
        "doc_id", "NULL AS source", "NULL AS lang", f"explode(array({versions})) AS version", "'delete' AS op", "0 AS n_tokens", "0 AS seq"))
    return token_counts.totals(spark, store)


@query
def op2_warc(spark, sf_dir):
    """What the archives of all pages hold, every url looked up in the two levels of their index."""
    pages = table(spark, sf_dir, "pages")
    archive = warc.write(pages, scratch_path(spark, "warc"))
    return warc.lookup(pages, archive, payloads=False, nameless=True).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op2_warc"] = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
o AS (SELECT payload_digest, payload_bytes, max(page_id) AS owner FROM p WHERE payload_bytes >= {warc.MIN_REVISIT} GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN owner IS DISTINCT FROM page_id AND owner IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN owner IS DISTINCT FROM page_id THEN owner END AS refers_to
FROM p LEFT JOIN o USING (payload_digest, payload_bytes)"""


@query
def op11_whitening(spark, sf_dir):
    """Whitened coordinates of every vector along the 32 strongest directions of all vectors."""
    rows = whitening.usable(table(spark, sf_dir, "embeddings"))
    model = whitening.fit(rows, components=32, scale=64, shift=1_000_000)
    error = None if model is None else whitening.identity_error(rows, model)
    return whitening.long_form(rows, model).withColumn("identity_error", F.lit(error).cast("double"))


@query
def op12_nearest(spark, sf_dir):
    """The five nearest vectors by cosine of every fiftieth vector, among all others."""
    return cross_polytope.nearest(table(spark, sf_dir, "embeddings"), "id % 50 = 0", neighbours=5)


@query
def op13_prefix_trie(spark, sf_dir):
    """Nodes of the prefix trie of the rebuilt conversations, with totals over their subtrees."""
    turns = prefix_trie.number_turns(table(spark, sf_dir, "conversations"))
    grafted = prefix_trie.regraft(turns, base="conv - conv % 20", keep="crc32(CAST(conv AS STRING)) % 4")
    return prefix_trie.trie(grafted)


# CRC-32 of the decimal id, bit by bit; its last two bits are inverted at the end.
SQL_CRC = """list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))"""

ORACLES["op13_prefix_trie"] = f"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
      PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT c, c - c % 20 AS b, 3 - {SQL_CRC} % 4 AS h FROM (SELECT DISTINCT c FROM t)),
r AS (SELECT k.c, 0 AS own, n, role, text FROM k JOIN t ON t.c = k.b AND n <= h
      UNION ALL SELECT k.c, 1 AS own, n, role, text FROM k JOIN t ON t.c = k.c AND n > h),
s AS (SELECT k.c, coalesce(list({{'role': role, 'text': text}} ORDER BY own, n) FILTER (WHERE n IS NOT NULL), []) AS turns
      FROM k LEFT JOIN r USING (c) GROUP BY k.c),
p AS (SELECT c, d, turns[1:d] AS node, d = len(turns) AS last FROM (SELECT c, turns, unnest(range(len(turns) + 1)) AS d FROM s)),
m AS (SELECT node, d, min(c) AS m, count(*) AS n, coalesce(string_agg(c, ',' ORDER BY c) FILTER (WHERE last), '') AS ends,
      (count(*) - 1) * len(regexp_extract_all(any_value(node)[-1].text, '[^\x20\x09-\x0D]+')) AS saved FROM p GROUP BY node, d),
x AS (SELECT p.c, p.d, m.m, m.n, m.saved FROM p JOIN m USING (node, d)),
e AS (SELECT a.m, a.d, b.m AS m2, b.d AS d2, any_value(b.saved) AS saved FROM x a JOIN x b ON a.c = b.c AND b.d >= a.d GROUP BY ALL),
f AS (SELECT m, d, sum(CAST(d2 = d + 1 AS BIGINT)) AS children, sum(coalesce(saved, 0)) AS saved FROM e GROUP BY m, d),
l AS (SELECT e.m, e.d, count(*) AS leaves FROM e JOIN f ON f.m = e.m2 AND f.d = e.d2 WHERE f.children = 0 GROUP BY e.m, e.d)
SELECT m.m AS conv_id, m.d AS depth, (SELECT any_value(x.m) FROM x WHERE x.c = m.m AND x.d = m.d - 1) AS parent_conv_id, m.n AS n_convs,
       CAST(f.children AS BIGINT) AS n_children, l.leaves AS n_leaves, CAST(f.saved AS BIGINT) AS saved_tokens, sha256(m.ends) AS ends_sha256
FROM m JOIN f ON f.m = m.m AND f.d = m.d JOIN l ON l.m = m.m AND l.d = m.d"""

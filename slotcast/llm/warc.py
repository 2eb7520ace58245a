"""WARC archives of captured pages, with a two-level index over reversed-host keys.

Writing: captures get a sort key (host labels reversed, then path and query), equal payloads of
at least ``min_revisit`` bytes become one response, that with the largest id, and revisits of
it, and rows are range-partitioned by (key, id). A task writes one archive in key order, one
gzip member per record, next to it the index: capture lines in compressed blocks of
``block_lines``, and a sparse directory with the first and last key and the place of each block.

Reading: a lookup finds the archives by their key ranges, binary-searches the archive's
directory, reads only the blocks in question and then only the records they name. Reading
everything walks the blocks; the records of a block are one range of the archive. Response
payloads are checked against their digest.

Files appear under their names only when whole, and only archives in the stored manifest
count, so lost or repeated tasks leave no trace.

Defined results: a null html is an empty payload, a null url has an empty key and no target.
Rows with a null id belong to no response: of equal payloads they revisit the largest id, and
are all responses if there is none. Rows that repeat the response's id are responses too.
Pages of any length are written and read whole, one record at a time.
Control characters and spaces in a url are written percent-encoded. Extra columns are not read.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from slotcast.llm import files
from slotcast.session import materialize

MIN_REVISIT = 1000
BLOCK_LINES = 500
BROADCAST_BYTES = 32 << 20
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURE = ("page_id bigint, url string, key string, record_type string, refers_to bigint, payload_bytes bigint, "
           "payload_digest string, payload binary, file string, offset bigint, length bigint")
BLOCK = "file string, first_key string, last_key string, offset bigint, length bigint, captures bigint"


def sort_key(url: str) -> str:
    """SQL for the key of a url: reversed host, then the rest, without scheme, user, port and fragment."""
    rest = f"regexp_replace(regexp_replace({url}, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#.*$', '')"
    host = f"lower(regexp_replace(regexp_replace(regexp_extract({rest}, '^[^/?]*', 0), '^.*@', ''), ':[0-9]*$', ''))"
    key = f"concat(array_join(reverse(split({host}, '[.]')), ','), ')', regexp_replace({rest}, '^[^/?]*', ''))"
    return f"CASE WHEN {url} IS NULL THEN '' ELSE regexp_replace({key}, '[\\\\x00-\\\\x20\\\\x7F]', '+') END"


def _target(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(head.encode() + block + b"\r\n\r\n") + squeeze.flush()


def _record(page, url, payload: bytes, digest: str, owner, owner_url, date: str) -> bytes:
    kind = "response" if owner is None else "revisit"
    headers = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", _target(url)))
    headers += [("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
                ("Content-Type", "application/http; msgtype=response")]
    if page is not None:
        headers.append(("X-Page-ID", str(page)))
    if owner is not None:
        headers += [("WARC-Profile", REVISIT), ("WARC-Refers-To-Date", date), ("X-Refers-To-Page-ID", str(owner))]
        if owner_url is not None:
            headers.append(("WARC-Refers-To-Target-URI", _target(owner_url)))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return _member(headers, http + (payload if owner is None else b""))


def _parse(member: bytes) -> dict:
    """Headers of record and message and, for responses, the checked payload."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(warc["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    message = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
    digest = base64.b32decode(warc["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if warc["WARC-Type"] == "response":
        if hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(message["Content-Length"]):
            raise ValueError(f"record {warc['WARC-Record-ID']} does not hold its payload")
    else:
        payload = None
    return {"page_id": int(warc["X-Page-ID"]) if "X-Page-ID" in warc else None, "url": warc.get("WARC-Target-URI"),
            "record_type": warc["WARC-Type"], "payload_digest": digest, "payload_bytes": int(message["Content-Length"]),
            "refers_to": int(warc["X-Refers-To-Page-ID"]) if "X-Refers-To-Page-ID" in warc else None, "payload": payload}


def write(pages: DataFrame, out: str, page_id: str = "page_id", url: str = "url", html: str = "html",
          min_revisit: int = MIN_REVISIT, block_lines: int = BLOCK_LINES, date: str = DATE) -> str:
    """Writes archives, index and manifest below ``out``; returns the folder to read from."""
    out = files.qualified(pages.sparkSession, out)
    rows = pages.select(F.col(page_id).cast("bigint").alias("page"), F.col(url).cast("string").alias("url"),
                        F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    owners = (rows.where(f"size >= {min_revisit}").groupBy("digest", "size")
              .agg(F.count("*").alias("n"), F.max(F.struct("page", "url")).alias("o")).where("n > 1 AND o.page IS NOT NULL")
              .selectExpr("digest AS o_digest", "size AS o_size", "o.page AS owner", "o.url AS owner_url"))
    owners = materialize(owners)
    bytes_ = owners.agg(F.sum(F.expr("100 + coalesce(octet_length(owner_url), 0)"))).first()[0] or 0
    # Repeated payloads are few; where they are not, the same join shuffles on the digest.
    given = rows.join(F.broadcast(owners) if bytes_ <= BROADCAST_BYTES else owners,
                      F.expr("digest = o_digest AND size = o_size"), "left").select(
        "page", "url", "payload", "digest", "owner_url", F.expr("IF(owner IS NULL OR owner <=> page, NULL, owner)").alias("owner"),
        F.expr(sort_key("url")).alias("key"))
    ordered = given.repartitionByRange("key", "page").sortWithinPartitions("key", "page", "digest")

    def store(batches):
        archive = lines = name = None
        found = []

        def close_block():
            data = zlib.compress("".join(x for _, x in lines).encode(), 6)
            row = (name, lines[0][0], lines[-1][0], index.write(data), len(data), len(lines))
            found.append(row)

        for batch in batches:
            for r in batch.to_pylist():
                if archive is None:
                    name = uuid.uuid4().hex
                    archive, index, lines = files.Output(f"{out}/data", f"{name}.warc.gz"), files.Output(f"{out}/data", f"{name}.cdx"), []
                member = _record(r["page"], r["url"], r["payload"], r["digest"], r["owner"], r["owner_url"], date)
                at = archive.write(member)
                lines.append((r["key"], r["key"] + " " + json.dumps({"page": r["page"], "offset": at, "length": len(member)}) + "\n"))
                if len(lines) == block_lines:
                    close_block()
                    lines = []
        if archive is not None:
            if lines:
                close_block()
            directory = files.Output(f"{out}/data", f"{name}.dir")
            directory.write("".join(json.dumps(x[1:]) + "\n" for x in found).encode())
            for output in (archive, index, directory):
                output.publish()
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)],
                                             names=["file", "first_key", "last_key", "offset", "length", "captures"])

    ordered.mapInArrow(store, BLOCK).write.parquet(f"{out}/blocks")
    return out


def blocks(spark: SparkSession, archive: str) -> DataFrame:
    """The directory of all index blocks."""
    return spark.read.schema(BLOCK).parquet(f"{archive}/blocks")


def _fetch(archive: str, file: str, wanted, payloads: bool):
    """Capture rows for (key, line) pairs of one archive; neighbouring records are one read."""
    runs = []
    for key, line in wanted:
        entry = json.loads(line)
        if runs and runs[-1][1] == entry["offset"] and entry["offset"] - runs[-1][0] < 1 << 24:
            runs[-1][1] += entry["length"]
            runs[-1][2].append((key, entry))
        else:
            runs.append([entry["offset"], entry["offset"] + entry["length"], [(key, entry)]])
    with files.ranges(f"{archive}/data", f"{file}.warc.gz") as stream:
        for first, past, entries in runs:
            stream.seek(first)
            data = stream.read(past - first)
            for key, entry in entries:
                row = _parse(data[entry["offset"] - first:entry["offset"] - first + entry["length"]])
                if not payloads:
                    row["payload"] = None
                yield row | {"key": key, "file": file, "offset": entry["offset"], "length": entry["length"]}


def _lines(archive: str, file: str, places):
    """(key, line) of the index blocks at (offset, length)."""
    with files.ranges(f"{archive}/data", f"{file}.cdx") as stream:
        for offset, length in places:
            stream.seek(offset)
            for line in zlib.decompress(stream.read(length)).decode().splitlines():
                yield line.split(" ", 1)


ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("key", pa.string()), ("record_type", pa.string()),
                   ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("payload", pa.binary()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


def _batched(rows, limit: int = 500, size: int = 8 << 20):
    held, held_bytes = [], 0
    for row in rows:
        held.append(row)
        held_bytes += len(row["payload"] or b"")
        if len(held) == limit or held_bytes >= size:
            yield pa.RecordBatch.from_pylist(held, ARROW)
            held, held_bytes = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, ARROW)


def captures(spark: SparkSession, archive: str, payloads: bool = True) -> DataFrame:
    """Every capture, read back from the archives block by block."""
    def read(batches):
        for batch in batches:
            for b in batch.to_pylist():
                yield from _batched(_fetch(archive, b["file"], _lines(archive, b["file"], [(b["offset"], b["length"])]), payloads))

    dealt = blocks(spark, archive).repartition("file", "offset")
    return dealt.mapInArrow(read, CAPTURE)


def lookup(urls: DataFrame, archive: str, url: str = "url", payloads: bool = True, nameless: bool = False) -> DataFrame:
    """Captures of the given urls (any capture with the same key), by directory search and range reads.

    Null urls are ignored, or with ``nameless`` ask for the captures without url.
    """
    spark = urls.sparkSession
    # One row per archive: as many as the write had partitions.
    spans = sorted((r["lo"], r["hi"], r["file"]) for r in blocks(spark, archive).groupBy("file").agg(
        F.min("first_key").alias("lo"), F.max("last_key").alias("hi")).collect())
    table = spark.createDataFrame(spans, "lo string, hi string, file string")
    keys = urls.where(F.lit(nameless) | F.col(url).isNotNull()).select(F.expr(sort_key(f"`{url}`")).alias("want")).distinct()

    def candidates(batches):
        lows = [s[0] for s in spans]
        for batch in batches:
            rows = []
            for key in batch.column(0).to_pylist():
                at = bisect.bisect_right(lows, key) - 1
                while at >= 0 and spans[at][1] >= key:  # a key may go on over several archives
                    rows.append((key, spans[at][2]))
                    at -= 1
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())],
                                             names=["want", "file"])

    def find(batches):
        known = {}
        for batch in batches:
            by_file = {}
            for r in batch.to_pylist():
                by_file.setdefault(r["file"], set()).add(r["want"])
            for file, wanted in by_file.items():
                if file not in known:
                    with files.ranges(f"{archive}/data", f"{file}.dir") as stream:
                        known[file] = [json.loads(x) for x in stream.read().decode().splitlines()]
                directory = known[file]
                lasts, places = [d[1] for d in directory], {}
                for key in wanted:
                    at = bisect.bisect_left(lasts, key)
                    while at < len(directory) and directory[at][0] <= key:
                        places[at] = (directory[at][2], directory[at][3])
                        at += 1
                lines = ((k, x) for k, x in _lines(archive, file, [places[p] for p in sorted(places)]) if k in wanted)
                yield from _batched(_fetch(archive, file, lines, payloads))

    if table.isEmpty():
        return spark.createDataFrame([], CAPTURE)
    pairs = keys.mapInArrow(candidates, "want string, file string")
    return pairs.repartition("file").sortWithinPartitions("file", "want").mapInArrow(find, CAPTURE)

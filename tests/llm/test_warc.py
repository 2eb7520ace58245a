"""Archives: round trips, revisits, lookups against a plain search, readable by any gzip reader."""

from __future__ import annotations

import glob
import gzip
import hashlib
from collections import Counter

from slotcast.llm import warc

SCHEMA = "page_id bigint, url string, html string, key string, payload int"  # extra columns with clashing names


def pages(spark):
    big = "é" * 600
    rows = [(1, "http://www.A.example.com:80/x?q=1#f", big), (2, "https://u@a.example.com/x?q=1", big), (3, None, None), (4, "no url", ""),
            (5, "http://b.example.org/a b\r\nX: y", "small"), (6, "http://b.example.org", "small"), (None, "http://c.org/", big),
            (2, "https://u@a.example.com/x?q=1", big), (None, None, "z" * 2000), (None, "http://c.org/", "z" * 2000),
            (7, "http://d.org/" + "p" * 3000, "w" * 500_000), (8, "http://e.org/", "\r\n\r\nHTTP/1.1 " + "WARC/1.1\r\n\r\n" * 100)]
    rows += [(100 + i, f"http://same.org/{i % 3}", f"<p>{i % 7}</p>" * (200 if i % 2 else 5)) for i in range(300)]
    return rows, spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA)


def expected(rows):
    data = [(p, u, (h or "").encode()) for p, u, h in rows]
    out = Counter()
    for p, _, b in data:
        same = [q for q, _, c in data if c == b and q is not None]
        owner = max(same) if len(b) >= 1000 and same else None
        visit = owner is not None and owner != p
        out[p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if visit else "response", owner if visit else None] += 1
    return out


def as_counter(found):
    return Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found)


def test_round_trip(spark, tmp_path):
    rows, docs = pages(spark)
    archive = warc.write(docs.repartition(3), str(tmp_path / "a"), block_lines=7)
    found = warc.captures(spark, archive).collect()
    assert as_counter(found) == expected(rows)
    bodies = Counter((r["page_id"], r["payload"]) for r in found if r["record_type"] == "response")
    for (p, body), n in bodies.items():
        assert body in [(h or "").encode() for q, _, h in rows if q == p]
    whole = b"".join(gzip.open(f).read() for f in glob.glob(f"{tmp_path}/a/data/*.warc.gz"))
    assert whole.count(b"WARC-Type: ") == len(rows) and not glob.glob(f"{tmp_path}/a/data/.*")
    directory = warc.blocks(spark, archive).collect()
    assert all(b["first_key"] <= b["last_key"] and b["captures"] <= 7 for b in directory) and sum(b["captures"] for b in directory) == len(rows)
    for f in {b["file"] for b in directory}:
        mine = sorted((b["offset"], b["first_key"], b["last_key"]) for b in directory if b["file"] == f)
        assert all(a[2] <= b[1] for a, b in zip(mine, mine[1:]))


def test_lookup(spark, tmp_path):
    rows, docs = pages(spark)
    archive = warc.write(docs.repartition(3), str(tmp_path / "a"), block_lines=4)
    urls = ["http://same.org/1", "http://a.example.com/x?q=1", "HTTPS://B.example.org/a b\r\nX: y#z", "http://none.org/", None, "http://same.org/1"]
    found = warc.lookup(spark.createDataFrame([(u,) for u in urls], "url string"), archive).collect()
    want = Counter(p for p, u, _ in rows if u in ("http://same.org/1", "https://u@a.example.com/x?q=1", "http://b.example.org/a b\r\nX: y"))
    assert Counter(r["page_id"] for r in found) == want
    keys = {r["key"] for r in found}
    assert keys == {"org,same)/1", "com,example,a)/x?q=1", "org,example,b)/a+b++X:+y"}


def test_empty(spark, tmp_path):
    _, docs = pages(spark)
    archive = warc.write(docs.where("false"), str(tmp_path / "a"))
    assert warc.captures(spark, archive).count() == 0
    assert warc.lookup(docs.select("url"), archive).count() == 0


def test_damaged_payload_is_reported(spark):
    import pytest

    good = warc._record(1, "u", b"abc", hashlib.sha1(b"abc").hexdigest(), None, None, warc.DATE)
    assert warc._parse(good)["payload"] == b"abc"
    with pytest.raises(ValueError):
        warc._parse(warc._record(1, "u", b"abc", hashlib.sha1(b"abd").hexdigest(), None, None, warc.DATE))


def test_looking_up_every_page_finds_every_record_once(spark, tmp_path):
    rows, docs = pages(spark)
    archive = warc.write(docs.repartition(3), str(tmp_path / "a"), block_lines=5)
    assert as_counter(warc.lookup(docs, archive, payloads=False, nameless=True).collect()) == expected(rows)
    only = warc.lookup(docs.where("url IS NULL"), archive, nameless=True).collect()
    assert Counter(r["page_id"] for r in only) == Counter(p for p, u, _ in rows if u is None)

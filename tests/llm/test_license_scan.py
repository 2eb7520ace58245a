"""Licence scan against a plain comparison of every segment with every template."""

from __future__ import annotations

import re

from slotcast.llm import license_scan as ls

SCHEMA = "doc_id bigint, text string, license string, lines int, hits int"  # extra columns with clashing names
W = "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

MIT = ls.TEMPLATES[3][1]
DOCS = [(1, "Prose.\nReleased under the MIT License.\nMore."), (2, "released UNDER the mit license\n" * 5), (3, None), (4, ""), (5, "word"),
        (6, "Intro text\n\n" + MIT.replace(", ", ",\n") + "\n\nThe end of it"), (7, MIT.replace(" ", "\n")), (8, "Licensed under CC BY-SA 4.0.\nLicensed under CC BY 4.0."),
        (9, "Licensed&&& under%%% the Apache*** License, Version 2.0."), (10, "x y " * 50_000), (10, "Licensed under the MIT License. Now."),
        (None, "line\n" * 5000), (None, "line\n" * 5000), (11, "Released under the MIT License."), (12, "\n \n\n\t\nLicensed under CC BY-NC 4.0.\n \n")]


def words(text):
    return re.findall(W, text.translate({c: c + 32 for c in range(65, 91)}))


def plain(text):
    text = text or ""
    segments = text.split("\n") + (re.split(ls.PARAGRAPHS, text) if re.search(ls.PARAGRAPHS, text) else []) + [text]
    hits = set()
    for w in {tuple(words(s)) for s in segments}:
        a, best = set(zip(w, w[1:])), None
        for order, (name, body) in enumerate(ls.TEMPLATES):
            t = words(body)
            b = set(zip(t, t[1:]))
            dice = 2 * len(a & b) / (len(a) + len(b))
            if dice >= ls.THRESHOLD and (best is None or (dice, -order) > best[:2]):
                best = (dice, -order, name)
        if best:
            hits.add((w, best))
    top = max((h for _, h in hits), default=(0.0, 0, None))
    return top[2], top[0], len(hits)


def test_equals_plain_comparison(spark):
    docs = spark.createDataFrame([(i, t, "l", 1, 2) for i, t in DOCS], SCHEMA)
    got = [(r["doc_id"], r["license"], r["dice"], r["n_hits"]) for r in ls.scan(docs).collect()]
    want = [(i, *plain(t)) for i, t in DOCS]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    found = {i: name for i, name, *_ in want if name}
    assert [found[i] for i in (1, 6, 7, 9, 12)] == ["MIT", "MIT", "MIT", "Apache-2.0", "CC-BY-NC-4.0"]


def test_own_templates_and_empty_tables(spark):
    docs = spark.createDataFrame([(i, t, "l", 1, 2) for i, t in DOCS], SCHEMA)
    assert ls.scan(docs, templates=[("x", "one"), ("y", "")]).where("n_hits > 0").count() == 0
    assert [r["license"] for r in ls.scan(docs, templates=[("it's \\ odd", "line line")], threshold=1.0).where("n_hits > 0").collect()] == ["it's \\ odd"] * 2
    assert ls.scan(docs.where("false")).count() == 0


GPL = """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
"""
FILL = "and so we went down to the old river where under the trees nobody had seen the boat of last year"
INSIDE = [FILL + " Licensed under the Apache License, Version 2.0. " + FILL, "/*\n" + GPL + " */\nint main;\n",
          FILL + " Released under the MIT License. Licensed under CC BY 4.0! " + FILL + " licensed under the apache licence, version 2.0, " + FILL,
          "Licensed under the MIT License.\n" + FILL + " Licensed under the MIT License. " + FILL, "Licensed under the MIT License. Now.",
          (FILL + " Licensed under CC BY-SA 4.0. ") * 3, "Released under the MIT License. " * 7, FILL, "This is\nfree and unencumbered\nsoftware released into\nthe public domain. " + FILL,
          FILL + " use of this source code is is is governed by a BSD-style license that can be found in the in the LICENSE file " + FILL]


def plain_with_windows(text):
    """Every run of words against every template, then the best disjoint ones beside the segments' hits."""
    w, best, spans = words(text), {}, []
    segments = [text.split("\n"), re.split(ls.PARAGRAPHS, text) if re.search(ls.PARAGRAPHS, text) else [], [text]]
    known = [(order, name, set(zip(t, t[1:]))) for order, (name, body) in enumerate(ls.TEMPLATES) for t in [words(body)]]

    def dice(run, b):
        a = set(zip(run, run[1:]))
        return 2 * len(a & b) / (len(a) + len(b))

    for cut in segments:
        at = 0
        for s in map(words, cut):
            top = max(((dice(s, b), -order, name) for order, name, b in known))
            if top[0] >= ls.THRESHOLD:
                best[tuple(s)] = top
                spans.append((at, at + len(s), top[0], top[2]))
            at += len(s)
    windows = []
    for order, name, b in known:
        most = int(len(b) * (2 - ls.THRESHOLD) / ls.THRESHOLD + 1e-9)
        for i in range(len(w)):
            for z in range(i + 2, min(i + most + 1, len(w)) + 1):
                d = dice(w[i:z], b)
                if d >= ls.THRESHOLD and not any(s[2] == 1 and s[0] < z and i < s[1] for s in spans):
                    windows.append((-d, order, z - i, i, z, name))
    taken = []
    for x in sorted(windows):
        if not any(y[3] < x[4] and x[3] < y[4] for y in taken):
            taken.append(x)
    for d, order, _, i, z, name in taken:
        if not any(s[0] < z and i < s[1] and (s[3] == name or s[2] >= -d) for s in spans):
            best[tuple(w[i:z])] = (-d, -order, name)
    top = max(best.values(), default=(0.0, 0, None))
    return top[2], top[0], len(best)


def test_notices_inside_segments_equal_all_windows(spark):
    docs = spark.createDataFrame(list(enumerate(INSIDE)), "doc_id int, text string")
    got = {r["doc_id"]: (r["license"], r["dice"], r["n_hits"]) for r in ls.scan(docs).collect()}
    assert got == {i: plain_with_windows(t) for i, t in enumerate(INSIDE)}
    assert got[0] == ("Apache-2.0", 1.0, 1) and got[1] == ("GPL-3.0", 1.0, 1) and got[2][2] == 2 and got[7] == (None, 0.0, 0)


def test_families_that_differ_by_a_word(spark):
    header = ("This {0} is free software; you can redistribute it and/or modify\nit under the terms of the GNU {1}General Public License as\n"
              "published by the Free Software Foundation; either version {2} of the License, or\n(at your option) any later version.\n")
    texts = {"GPL-2.0": header.format("program", "", "2"), "GPL-3.0": header.format("program", "", "3").replace(";", ","),
             "LGPL-2.1": header.format("library", "Lesser ", "2.1"), "LGPL-3.0": header.format("library", "Lesser ", "3"),
             "AGPL-3.0": header.format("program", "Affero ", "3")}
    inside = {name: FILL + " " + t.replace("\n", " ") + FILL for name, t in texts.items()}
    docs = spark.createDataFrame([(n, t) for group in (texts, inside) for n, t in group.items()], "doc_id string, text string")
    assert all(r["license"] == r["doc_id"] and r["dice"] == 1 for r in ls.scan(docs).collect())


def test_many_notices_in_one_line_equal_all_windows(spark):
    short = " ".join(["Released under the MIT License.", FILL, "Licensed under CC BY 4.0."] * 4)
    twice = "licensed under licensed under the apache license, version 2.0 the apache license, version 2.0. " + FILL
    docs = spark.createDataFrame([(0, short), (1, twice), (2, FILL + " " + twice + " " + short)], "doc_id int, text string")
    got = {r["doc_id"]: (r["license"], r["dice"], r["n_hits"]) for r in ls.scan(docs).collect()}
    assert got == {r["doc_id"]: plain_with_windows(r["text"]) for r in docs.collect()}

"""Licence scan: document segments compared to licence templates by Dice over word bigrams.

Segments are the lines of a text, its paragraphs (between blank lines) and the whole text,
each reduced to normalised words. A segment with a distinct bigrams can reach Dice t with a
template of b only if b * t / (2 - t) <= a <= b * (2 - t) / t; templates outside that bound
are skipped before any bigram is compared. Everything is one projection per row, without a
shuffle.

Notices inside longer segments are found as windows: runs of words of the text, of at most as
many bigrams as a template's upper bound, that reach t with it. Windows that overlap a segment
of Dice 1 are left out. Of the others the best is taken (higher Dice, template listed first,
fewer words, further left), those that overlap it are dropped, and so on. A window taken is a
hit unless it overlaps a matching segment of the same licence or of no lower Dice. As the best
windows begin and end with a bigram of their template, only those are scored, and only in texts
that hold enough bigrams of it. Taking windows compares each with those taken: a text of k
notices without a line of their own costs k * k steps.

Defined results: null, empty and one-word texts match nothing (``license`` null, ``dice`` 0,
``n_hits`` 0). Repeated segments count once. Equal coefficients go to the template listed
first. Repeated rows and repeated ids each give a row; extra columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from slotcast.llm.words import word_array

THRESHOLD = 0.85

# Licence ids with the public wording of their notices and short texts.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License - see the LICENSE file for details."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Released under the CC0 1.0 Universal Public Domain Dedication."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the License, "
                "or (at your option) any later version."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
                 "License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation, either version 3 of the "
                 "License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
                 "License, or (at your option) any later version."),
)

BIGRAMS = "array_distinct(transform(sequence(0, size({w}) - 2), i -> concat({w}[i], ' ', {w}[i + 1])))"
PARAGRAPHS = r"\n[ \t\r]*\n"


def _templates(df: DataFrame, templates, threshold: float) -> list[dict]:
    """Normalised templates with their bigrams and size bounds, by the same SQL the documents go through."""
    spark = df.sparkSession
    rows = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)],
                                 "ord int, name string, text string")
    found = (rows.selectExpr("ord", "name", f"{word_array('text')} AS w").where("size(w) >= 2")
             .selectExpr("ord", "name", BIGRAMS.format(w="w") + " AS b").orderBy("ord").collect())
    return [{"ord": r["ord"], "name": r["name"], "b": r["b"],
             "lo": math.ceil(len(r["b"]) * threshold / (2 - threshold) - 1e-9),
             "hi": math.floor(len(r["b"]) * (2 - threshold) / threshold + 1e-9)} for r in found]


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _with_windows(rows: DataFrame, doc_id: str, threshold: float) -> DataFrame:
    """``doc_id, hits``: the matching segments and, where ``n_near`` names templates, the windows beside them."""
    def step(df: DataFrame, name: str, value: str, drop: tuple = ()) -> DataFrame:
        return df.select(*[c for c in df.columns if c not in drop], F.explode(F.expr(f"array({value})")).alias(name))

    def starts(parts: str) -> str:
        return f"aggregate({parts}, array(0), (s, x) -> concat(s, array(element_at(s, -1) + size(x))))"

    # Word spans of the matching segments; a newline separates words, so both cuts share the text's word numbers.
    rows = step(rows, "cuts", "IF(size(matched) = 0, NULL, concat(n_lines, n_paragraphs, array(n_words)))")
    rows = step(rows, "at", f"IF(cuts IS NULL, NULL, concat(slice({starts('n_lines')}, 1, size(n_lines)), "
                f"slice({starts('n_paragraphs')}, 1, size(n_paragraphs)), array(0)))")
    rows = step(rows, "spans", """coalesce(flatten(transform(sequence(0, size(cuts) - 1), i -> transform(
        filter(matched, h -> h.segment = array_join(cuts[i], ' ')),
        h -> named_struct('a', at[i], 'z', at[i] + size(cuts[i]), 'dice', h.dice, 'license', h.license)))),
        CAST(array() AS array<struct<a:int,z:int,dice:double,license:string>>))""", ("cuts", "at", "n_lines", "n_paragraphs"))
    rows = step(rows, "open", "array_except(n_marks, flatten(transform(filter(spans, s -> s.dice >= 1D), s -> sequence(s.a - 1, s.z - 1))))")
    rows = step(rows, "grams", "IF(size(open) = 0, NULL, transform(sequence(0, size(n_words) - 2), i -> concat(n_words[i], ' ', n_words[i + 1])))")
    # Last place of the same bigram before each place, and each template's open bigrams: a window's distinct bigrams
    # are the places in it whose last place lies before it, so its counts grow by one step with its end.
    rows = step(rows, "sorted", "IF(grams IS NULL, NULL, sort_array(transform(grams, (g, i) -> named_struct('g', g, 'i', i))))")
    rows = step(rows, "last", """IF(sorted IS NULL, NULL, transform(sort_array(transform(sorted, (x, k) ->
        named_struct('i', x.i, 'last', IF(k > 0 AND sorted[k - 1].g = x.g, sorted[k - 1].i, -1)))), x -> x.last))""", ("sorted",))
    rows = step(rows, "member", "IF(grams IS NULL, NULL, transform(n_near, t -> transform(grams, g -> array_contains(t.b, g))))")
    rows = step(rows, "begin", "IF(grams IS NULL, NULL, transform(member, m -> filter(open, i -> m[i])))")
    score = "2.0D * (s.shared + INT(last[j] < i AND member[k][j])) / (s.n + INT(last[j] < i) + t.n)"
    # A window without a covered place holds at least t.lo open bigrams of its template.
    rows = step(rows, "windows", f"""IF(grams IS NULL, NULL, filter(flatten(transform(n_near, (t, k) -> flatten(transform(
        filter(begin[k], (i, m) -> m + t.lo <= size(begin[k]) AND begin[k][m + t.lo - 1] < i + t.hi),
        i -> aggregate(sequence(i, least(i + t.hi, size(grams)) - 1),
            named_struct('shared', 0, 'n', 0, 'w', CAST(array() AS array<struct<behind:double,ord:int,n:int,a:int,z:int,license:string>>)),
            (s, j) -> named_struct('shared', s.shared + INT(last[j] < i AND member[k][j]), 'n', s.n + INT(last[j] < i), 'w',
                IF(member[k][j] AND {score} >= {threshold!r}D, concat(s.w, array(
                    named_struct('behind', -({score}), 'ord', t.ord, 'n', j - i + 2, 'a', i, 'z', j + 2, 'license', t.name))), s.w)),
            s -> s.w))))),
        x -> NOT exists(spans, s -> s.dice >= 1D AND s.a < x.z AND x.a < s.z)))""",
        ("open", "grams", "last", "member", "begin", "n_marks", "n_near"))
    rows = step(rows, "taken", """aggregate(sort_array(windows), filter(windows, x -> false),
        (s, x) -> IF(exists(s, y -> y.a < x.z AND x.a < y.z), s, concat(s, array(x))))""", ("windows",))
    return rows.select(doc_id, F.expr("""IF(coalesce(size(taken), 0) <= 0, matched, array_distinct(concat(matched, transform(
        filter(taken, x -> NOT exists(spans, s -> s.a < x.z AND x.a < s.z AND (s.license = x.license OR s.dice >= -x.behind))),
        x -> named_struct('dice', -x.behind, 'ord', x.ord, 'license', x.license, 'segment', array_join(slice(n_words, x.a + 1, x.n), ' '))))))""").alias("hits"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates=TEMPLATES,
         threshold: float = THRESHOLD) -> DataFrame:
    """Per input row: id, ``license, dice, n_hits, hits``.

    ``hits`` lists (dice, ord, license, segment) of every distinct matching segment or window with
    its best template; ``license`` and ``dice`` are those of the best hit.
    """
    known = _templates(docs, templates, threshold)
    if not known:
        return docs.select(F.col(doc_id), F.lit(None).cast("string").alias("license"), F.lit(0.0).alias("dice"),
                           F.lit(0).cast("bigint").alias("n_hits"),
                           F.expr("CAST(array() AS array<struct<dice:double,ord:int,license:string,segment:string>>)").alias("hits"))
    lo, hi = min(t["lo"] for t in known), max(t["hi"] for t in known)
    literal = ", ".join(
        f"named_struct('ord', {t['ord']}, 'name', {_quoted(t['name'])}, 'lo', {t['lo']}, 'hi', {t['hi']}, "
        f"'n', {len(t['b'])}, 'b', array({', '.join(map(_quoted, t['b']))}))" for t in known)
    def among(words) -> str:
        return "IN (" + ", ".join(map(_quoted, sorted(words))) + ")"

    pairs = {b for t in known for b in t["b"]}
    first, second = ({b.split(" ")[k] for b in pairs} for k in (0, 1))
    source = f"`{text}`"
    paragraphs = PARAGRAPHS.replace("\\", "\\\\")
    line_words = word_array("l")
    # A newline separates words, so the text's words are its lines' words in a row.
    rows = docs.select(F.col(doc_id), F.explode(F.expr(
        f"array(transform(split(coalesce({source}, ''), '\\n', -1), l -> {line_words}))")).alias("lines"), F.expr(
        f"CASE WHEN {source} RLIKE '{paragraphs}' THEN transform(split({source}, '{paragraphs}', -1), l -> {line_words}) "
        "ELSE array() END").alias("paragraphs"))
    rows = rows.select("*", F.explode(F.expr("array(flatten(lines))")).alias("words"))
    # Where a bigram of a template begins, and the templates that have enough of theirs in the text.
    rows = rows.select("*", F.explode(F.expr(
        f"array(IF(size(words) < 2, CAST(array() AS array<int>), filter(sequence(0, size(words) - 2), i -> words[i] {among(first)} "
        f"AND words[i + 1] {among(second)} AND concat(words[i], ' ', words[i + 1]) {among(pairs)})))")).alias("marks"))
    held = "array_distinct(transform(marks, i -> concat(words[i], ' ', words[i + 1])))"
    rows = rows.select("*", F.explode(F.expr(
        f"array(IF(size(marks) < {lo}, array(), {held}))")).alias("held"))
    rows = rows.select("*", F.explode(F.expr(
        f"array(filter(array({literal}), t -> size(array_intersect(held, t.b)) >= t.lo))")).alias("near"))
    kept = [F.expr(f"IF(size(near) = 0, NULL, {c})").alias(f"n_{c}") for c in ("lines", "paragraphs", "words", "marks", "near")]
    # Distinct bigrams are at most words - 1, so too few words cannot reach the lower bound.
    segments = rows.select(doc_id, *kept, F.explode(F.expr(
        f"array(transform(filter(concat(lines, paragraphs, array(words)), s -> size(s) > {lo}), "
        f"s -> named_struct('s', s, 'b', {BIGRAMS.format(w='s')})))")).alias("segments"))
    carried = [doc_id, "n_lines", "n_paragraphs", "n_words", "n_marks", "n_near"]
    scored = segments.select(*carried, F.explode(F.expr(f"""array(filter(transform(
        filter(segments, g -> size(g.b) BETWEEN {lo} AND {hi}),
        g -> named_struct('segment', array_join(g.s, ' '), 'best', array_max(transform(
            filter(array({literal}), t -> size(g.b) BETWEEN t.lo AND t.hi),
            t -> named_struct('dice', 2.0D * size(array_intersect(g.b, t.b)) / (size(g.b) + t.n), 'rank', -t.ord, 'license', t.name))))),
        h -> h.best.dice >= {threshold!r}D))""")).alias("h"))
    hits = _with_windows(scored.select(*carried, F.explode(F.expr(
        "array(array_distinct(transform(h, x -> named_struct('dice', x.best.dice, 'ord', -x.best.rank, 'license', x.best.license, "
        "'segment', x.segment))))")).alias("matched")), doc_id, threshold)
    best = "array_max(transform(hits, x -> named_struct('dice', x.dice, 'rank', -x.ord, 'license', x.license)))"
    return hits.selectExpr(f"`{doc_id}`", f"{best}.license AS license", f"coalesce({best}.dice, 0D) AS dice",
                           "CAST(size(hits) AS BIGINT) AS n_hits", "hits")


def oracle(sql_words, templates=TEMPLATES, threshold: float = THRESHOLD) -> str:
    """DuckDB SQL for ``doc_id, license, dice, n_hits``, comparing every segment with every template."""
    values = ", ".join("({}, '{}', '{}')".format(i, n, t.replace("'", "''")) for i, (n, t) in enumerate(templates))
    bigrams = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
WITH t AS (SELECT ord, name, {bigrams} AS b FROM (SELECT ord, name, {sql_words('text')} AS w
           FROM (VALUES {values}) v(ord, name, text)) WHERE len(w) >= 2),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT r, unnest(string_split(text, chr(10))) AS seg FROM d
      UNION ALL SELECT r, unnest(regexp_split_to_array(text, '{PARAGRAPHS}')) FROM d WHERE regexp_matches(text, '{PARAGRAPHS}')
      UNION ALL SELECT r, text FROM d),
w AS (SELECT DISTINCT r, {sql_words('seg')} AS w FROM s WHERE len({sql_words('seg')}) > 1),
g AS (SELECT r, w, {bigrams} AS b FROM w),
x AS (SELECT r, w, ord, name, 2.0 * len(list_intersect(g.b, t.b)) / (len(g.b) + len(t.b)) AS dice FROM g, t
      WHERE len(g.b) >= len(t.b) * {threshold} / {2 - threshold} - 1e-6 AND len(g.b) <= len(t.b) * {2 - threshold} / {threshold} + 1e-6),
h AS (SELECT * FROM x WHERE dice >= {threshold}),
k AS (SELECT r, count(DISTINCT w) AS n_hits, first(name ORDER BY dice DESC, ord) AS license, max(dice) AS dice FROM h GROUP BY r)
SELECT doc_id, license, coalesce(CAST(dice AS DOUBLE), 0.0) AS dice, coalesce(n_hits, 0) AS n_hits FROM d LEFT JOIN k USING (r)"""

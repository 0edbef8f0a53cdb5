"""License scans: MinHash bands over text windows retrieve templates, exact containment verifies.

Words are runs of letters and digits, A-Z in lower case. A template of ``n`` words is looked for in
windows of ``n + n // 4`` words that start at every ``max(1, n // 4)``-th word, so any place of ``n``
words lies within some window. A window that holds 0.75 of a template's shingles (five words; all
words of a shorter template) shares at least half of the union with it, also for the slackest
window. With ``BANDS`` bands of one MinHash value each, it is retrieved with a probability of
1 - 0.5 ** BANDS or more (all but one in 16 million); the share of the template's shingles in
each retrieved window is then counted exactly.

Only windows with an *anchor* word are built. Anchors follow from the templates: for each template,
words such that more than a quarter of its shingles contain one. A window without any of them can
not hold 0.75 of the template, so nothing is lost, and texts without anchors are never split.

Close versions. Two templates that share at least ``CLOSE_PERCENT`` of the smaller one's shingles are versions
of one text, and a place that holds one of them holds most of the other. Of close templates whose best
windows in a document overlap, only the one with the largest share of its shingles is reported (ties: all).

Plan: built-in functions only. One scan; texts without anchors fall out in it; windows of the others
are exploded, joined to the templates of their length (a fixed list of a few rows, broadcast), and
aggregated by document and template. No window or signature crosses the network. Templates may be given as a
DataFrame ``license, text`` of whole texts; it is read by the driver up to ``MOST_TEMPLATES`` rows, more raise.

Edge cases: null, empty and anchor-free texts have no match; a text shorter than a template is one
window; rows that repeat a ``doc_id`` are taken together; rows without one are told apart, each with rows
of its own; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsync.llm.frames import id_text

SHINGLE = 5
BANDS = 24
CONTAINMENT_PERCENT = 75
CLOSE_PERCENT = 50
MOST_TEMPLATES = 2_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[^\p{L}\p{N}]+"

# Notices that name a license, as they are usually written.
TEMPLATES = {
    "Apache-2.0/notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "BSD/conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"),
    "CC-BY-4.0/notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0/notice": "Licensed under CC BY-NC 4.0.",
    "AGPL-3.0/header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."),
    "GPL-2.0/notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0/header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."),
    "GPL-3.0/notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0/header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "ISC/permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "LGPL-2.1/header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version."),
    "MIT/notice": "Released under the MIT License.",
    "MIT/permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions"),
    "MPL-2.0/header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "reserved/notice": "All rights reserved.",
}


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def layout(n_words: int) -> tuple[int, int, int]:
    """Words of a shingle, step between window starts, and words of a window."""
    step = max(1, n_words // 4)
    return min(SHINGLE, n_words), step, n_words + step - 1


def anchors(words: list[str], size: int) -> set[str]:
    """Words, longest first, until more than a quarter of the distinct shingles contain one."""
    shingles = {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}
    chosen: set[str] = set()
    for word in sorted(set(words), key=lambda w: (-len(w), w)):
        if sum(not chosen.isdisjoint(s) for s in shingles) * 100 > (100 - CONTAINMENT_PERCENT) * len(shingles):
            break
        chosen.add(word)
    return chosen


def split_words(text: Column) -> Column:
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _GAP)
    return F.filter(parts, lambda w: w != "")


def with_signature(windows: DataFrame) -> DataFrame:
    """``shingles`` (distinct hashes of ``words`` taken ``size`` at a time) and their ``bands``."""
    places = F.when(F.size("words") >= F.col("size"), F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)).otherwise(
        F.array().cast("array<int>"))
    hashed = windows.withColumn("shingles", F.array_distinct(F.transform(
        places, lambda i: F.xxhash64(F.array_join(F.slice("words", i, F.col("size")), " ")))))
    return hashed.withColumn("bands", F.transform(F.sequence(F.lit(1), F.lit(BANDS)), lambda band: F.xxhash64(
        band, F.array_min(F.transform("shingles", lambda h: F.xxhash64(h, band))))))


def templates_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """One row per template: its length class, shingles and bands."""
    rows = [(name, len(w), layout(len(w))[0], w) for name, w in ((k, template_words(v)) for k, v in templates.items())]
    frame = spark.createDataFrame(rows, "license string, n_words int, size int, words array<string>")
    return with_signature(frame).select("license", "n_words", F.col("shingles").alias("wanted"), F.col("bands").alias("wanted_bands"))


def template_shingles(text: str) -> set[tuple[str, ...]]:
    words = template_words(text)
    size = layout(len(words))[0]
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def close_versions(templates: dict[str, str]) -> list[tuple[str, str]]:
    """Pairs of templates, both ways, that share ``CLOSE_PERCENT`` of the smaller one's shingles or more."""
    shingles = {k: template_shingles(v) for k, v in templates.items()}
    return [(a, b) for a, x in shingles.items() for b, y in shingles.items()
            if a != b and len(next(iter(x))) == len(next(iter(y))) and 100 * len(x & y) >= CLOSE_PERCENT * min(len(x), len(y))]


def _given(templates: dict[str, str] | DataFrame) -> dict[str, str]:
    if isinstance(templates, dict):
        return templates
    rows = templates.select("license", "text").limit(MOST_TEMPLATES + 1).collect()
    if len(rows) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} license templates")
    return {r.license: r.text for r in rows if r.license is not None and template_words(r.text or "")}


def scan_licenses(docs: DataFrame, templates: dict[str, str] | DataFrame = TEMPLATES) -> DataFrame:
    """One row per document and template found: ``doc_id, license, n_shared, n_shingles, first_word``.

    ``n_shared`` is the most of the template's ``n_shingles`` distinct shingles in one window, and
    ``first_word`` the (0-based) start of the first such window.
    """
    spark, templates = docs.sparkSession, _given(templates)
    lengths = sorted({len(template_words(t)) for t in templates.values()})
    marks = {n: sorted(set().union(*(anchors(w, layout(n)[0]) for w in map(template_words, templates.values())
                                     if len(w) == n))) for n in lengths}
    every = sorted(set().union(*marks.values()))
    lowered = F.lower("text")
    may_hold = F.lit(False)
    for word in every:
        may_hold = may_hold | F.contains(lowered, F.lit(word))
    classes = F.array(*[F.struct(F.lit(n).alias("n_words"), F.lit(layout(n)[0]).alias("size"), F.lit(layout(n)[1]).alias("step"),
                                 F.lit(layout(n)[2]).alias("width"), F.array(*map(F.lit, marks[n])).alias("marks"))
                        for n in lengths])
    row = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())  # tells rows without an id apart
    split = (id_text(docs).withColumn("row", row).filter(may_hold).select("doc_id", "row", split_words(F.col("text")).alias("all_words"))
             .withColumn("class", F.explode(classes)))
    # windows that hold a mark at word p start at a multiple of step in (p - width, p]
    starts = split.withColumn("places", F.expr(
        "filter(sequence(0, greatest(size(all_words) - 1, 0)), i -> array_contains(class.marks, get(all_words, i)))"))
    starts = starts.withColumn("starts", F.expr(
        "array_distinct(flatten(transform(places, p -> transform("
        "sequence(greatest(0, p - class.width + class.step) div class.step, p div class.step), k -> int(k * class.step)))))"))
    windows = (starts.select("doc_id", "row", "all_words", "class.n_words", "class.size", "class.width", F.explode("starts").alias("start"))
               .select("doc_id", "row", "n_words", "size", "start", F.expr("slice(all_words, start + 1, width)").alias("words")))
    found = (with_signature(windows).join(F.broadcast(templates_table(spark, templates)), "n_words")  # a fixed list
             .filter(F.arrays_overlap("bands", "wanted_bands"))
             .select("doc_id", "row", "license", "n_words", "start", F.size(F.array_intersect("shingles", "wanted")).cast("bigint").alias("n_shared"),
                     F.size("wanted").cast("bigint").alias("n_shingles"))
             .filter(F.col("n_shared") * 100 >= F.col("n_shingles") * CONTAINMENT_PERCENT))
    best = F.max(F.struct("n_shared", (-F.col("start")).alias("back")))
    own = (found.groupBy("doc_id", "row", "license", "n_words", "n_shingles").agg(best.alias("best"))
           .select("doc_id", "row", F.struct("license", (-F.col("best.back")).cast("bigint").alias("first_word"), F.col("best.n_shared").alias("n_shared"),
                                             "n_shingles", F.expr("n_words + greatest(1, n_words div 4) - 1").alias("width")).alias("m")))
    # a document's matches are no more than the templates
    close = F.array(*[F.lit(f"{a}\n{b}") for a, b in close_versions(templates)]).cast("array<string>")
    together = own.groupBy("doc_id", "row").agg(F.collect_list("m").alias("ms"))
    better = ("exists(ms, o -> array_contains(close, concat(m.license, chr(10), o.license)) and o.first_word < m.first_word + m.width "
              "and m.first_word < o.first_word + o.width and o.n_shared * m.n_shingles > m.n_shared * o.n_shingles)")
    kept = together.withColumn("close", close).select("doc_id", F.explode(F.expr(f"filter(ms, m -> not {better})")).alias("m"))
    return kept.select("doc_id", "m.license", "m.n_shared", "m.n_shingles", "m.first_word")


def scan_sql(templates: dict[str, str] = TEMPLATES) -> str:
    """The same rows in SQL: every shingle of every text against the templates', summed by window."""
    wanted = ",\n    ".join(f"('{name}', {len(w)}, {layout(len(w))[0]}, '{s}')"
                            for name, w in ((k, template_words(v)) for k, v in templates.items())
                            for s in sorted({" ".join(w[i:i + layout(len(w))[0]]) for i in range(len(w) - layout(len(w))[0] + 1)}))
    sizes = sorted({layout(len(template_words(t)))[0] for t in templates.values()})
    close = ", ".join(f"('{a}', '{b}')" for a, b in close_versions(templates)) or "('', '')"
    flat = "\n    UNION ALL ".join(
        f"SELECT doc_id, {k} AS size, unnest(range(len(words) - {k - 1})) AS p, unnest(list_transform(range(len(words) - {k - 1}), "
        f"lambda i: array_to_string(words[i + 1:i + {k}], ' '))) AS shingle FROM w WHERE len(words) >= {k}" for k in sizes)
    return f"""WITH wanted (license, n_words, size, shingle) AS (VALUES
    {wanted}),
classes AS (
    SELECT license, n_words, size, count(*) AS n_shingles, greatest(1, n_words // 4) AS step,
           n_words + greatest(1, n_words // 4) - 1 AS width
    FROM wanted GROUP BY ALL),
w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                                     '{_GAP}'), lambda x: x <> '') AS words
    FROM documents),
flat AS (
    {flat}),
hits AS (
    SELECT doc_id, c.license, n_shingles, step, shingle, p,
           unnest(range(greatest(0, p + c.size - width + step - 1) // step, p // step + 1)) * step AS start
    FROM flat JOIN wanted t USING (size, shingle) JOIN classes c ON c.license = t.license),
counted AS (
    SELECT doc_id, license, n_shingles, start, count(DISTINCT shingle) AS n_shared FROM hits GROUP BY ALL),
best AS MATERIALIZED (
    SELECT doc_id, license, max(n_shared) AS n_shared, n_shingles, arg_max(start, (n_shared, -start)) AS first_word
    FROM counted WHERE n_shared * 100 >= n_shingles * {CONTAINMENT_PERCENT} GROUP BY doc_id, license, n_shingles),
close (a, b) AS (VALUES {close}),
placed AS (SELECT best.*, width FROM best JOIN classes USING (license))
SELECT doc_id, license, n_shared, n_shingles, first_word FROM placed m
WHERE NOT EXISTS (
    SELECT 1 FROM placed o JOIN close ON a = m.license AND b = o.license
    WHERE o.doc_id = m.doc_id AND o.first_word < m.first_word + m.width AND m.first_word < o.first_word + o.width
      AND o.n_shared * m.n_shingles > m.n_shared * o.n_shingles)"""

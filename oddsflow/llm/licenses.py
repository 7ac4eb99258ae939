r"""Licence scan: lines and paragraphs against licence templates by Dice coefficient.

A unit (each distinct line, and paragraph between blank lines) is lower-cased (A-Z) and cut into words ``[a-z0-9]+``, with dotted numbers whole.  Its set of word
bigrams is compared with each template's: twice the common ones over the sum of sizes.
A coefficient of `least` or more needs sizes within [least/(2-least), (2-least)/least]
of each other, so only templates of such size are compared with a unit.

What no matching unit covers is searched for notices between other words: comment leaders
go, a notice may run over lines, and stretches of words that begin and end with a
bigram of a template, no longer than the size bounds allow, are compared.  From each begin the end that is best by counts of places is judged exactly; of
stretches that overlap the best one counts.  `oracle_sql` has lines and paragraphs only,
so the two agree wherever no notice stands between other words.

Only documents that have enough bigrams of some template are cut into units at all; a unit
or stretch cannot have more of them than its document.

Per document the best match counts: highest coefficient, then licence name.  Null text is empty and matches nothing; rows with null or repeated ids are judged
each by its own text; other columns are ignored.  Only DataFrame functions are used, and no shuffle.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 0.8
#: Fixed texts: public licence notices, by name.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
]
WORD = r"[0-9]+(?:[.][0-9]+)+|[a-z0-9]+"
PARAGRAPH = r"\n[\x20\t\r]*\n"
LEADER = r"(?im)^[\x20\t]*(?:rem|dnl)(?=[\x20\t])"  # comment leaders that are words; signs are none
CUT = "-cut-"  # in the place of a matching unit; in no template
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def template_bigrams(text: str) -> list[str]:
    words = re.findall(WORD, text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def bounds(size: int, least: float) -> tuple[int, int]:
    """Smallest and largest bigram set that can reach the coefficient with one of `size`."""
    fits = [n for n in range(1, int(size * (2 - least) / least) + 2) if 2 * min(n, size) >= least * (n + size)]
    return fits[0], fits[-1]


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def _pairs(words: Column) -> Column:
    """The bigrams of the words in their order, null without one."""
    return F.when(F.size(words) > 1, F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1))))


def _dice(grams: Column, own: Column) -> Column:
    return 2 * F.size(F.array_intersect(grams, own)) / (F.size(grams) + F.size(own)).cast("double")


def _whole(units: Column, known, least: float) -> Column:
    """(body, low, license) of the units that match, `low` the negative coefficient of the best template."""

    def hits(grams: Column) -> Column:
        found = []
        for name, own, _ in known:
            low, high = bounds(len(own), least)
            near = F.when(F.size(grams).between(low, high), _dice(grams, F.array(*map(F.lit, own))))  # the size bounds prune before anything is compared
            found.append(F.when(near >= least, F.struct((-near).alias("low"), F.lit(name).alias("license"))))
        return F.array_min(F.array_compact(F.array(*found)))

    each = F.transform(units, lambda u: F.struct(u.alias("body"), _words(u).alias("words")))
    each = F.transform(each, lambda u: F.struct(u["body"].alias("body"), F.array_distinct(_pairs(u["words"])).alias("grams")))
    each = F.transform(each, lambda u: F.struct(u["body"].alias("body"), hits(u["grams"]).alias("best")))
    return F.filter(each, lambda u: u["best"].isNotNull())


def _places(grams: Column, near: Column, known, least: float) -> Column:
    """For each template in `near` its figures, and the places of its bigrams among grams."""
    found = []
    for k, (name, own, n) in enumerate(known):
        own_lit = F.array(*map(F.lit, own))
        at = F.filter(F.sequence(F.lit(0), F.size(grams) - 1), lambda i: F.array_contains(own_lit, F.get(grams, i)))
        one = F.struct(F.lit(name).alias("license"), own_lit.alias("own"), F.lit(n).alias("n"), F.lit(bounds(len(own), least)[0]).alias("need"), F.lit(bounds(n, least)[1]).alias("span"), at.alias("at"))
        found.append(F.when(F.array_contains(near, k) & (F.size(grams) > 0), one))
    return F.array_compact(F.array(*found))


def _stretches(places: Column, grams: Column, least: float) -> Column:
    """(low, license, begin, end) of the best stretches that match, none overlapping a better one."""

    def end(t: Column, begin: Column, j: Column) -> Column:
        ends = F.filter(F.slice(t["at"], j + t["need"], t["span"]), lambda e: e - begin < t["span"])
        return F.array_max(F.transform(ends, lambda e, m: F.struct((2 * (t["need"] + m) / (e - begin + 1 + t["n"])).alias("about"), e.alias("end"))))["end"]

    def judged(t: Column) -> Column:
        spans = F.filter(F.transform(t["at"], lambda b, j: F.struct(b.alias("begin"), end(t, b, j).alias("end"))), lambda x: x["end"].isNotNull())

        def scored(x: Column) -> Column:
            low = F.transform(F.array(F.array_distinct(F.slice(grams, x["begin"] + 1, x["end"] - x["begin"] + 1))), lambda g: -_dice(g, t["own"]))
            return F.struct(F.get(low, F.lit(0)).alias("low"), t["license"].alias("license"), x["begin"].alias("begin"), x["end"].alias("end"))

        return F.filter(F.transform(spans, scored), lambda x: x["low"] <= -least)

    every = F.array_sort(F.flatten(F.transform(places, judged)))
    apart = lambda kept, x: ~F.exists(kept, lambda y: (y["begin"] <= x["end"] + 1) & (x["begin"] <= y["end"] + 1))
    return F.aggregate(every, F.filter(every, lambda x: F.lit(False)), lambda kept, x: F.when(apart(kept, x), F.concat(kept, F.array(x))).otherwise(kept))


def _without(text: Column, bodies: Column) -> Column:
    """The text with CUT for each paragraph and line among the bodies."""
    cut = lambda part: F.when(F.array_contains(bodies, part), CUT).otherwise(part)
    text = F.array_join(F.transform(F.split(text, PARAGRAPH), cut), "\n\n")
    return F.array_join(F.transform(F.split(text, "\n"), cut), "\n")


def matches(docs: DataFrame, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text", templates=None) -> DataFrame:
    """(doc_id, n_matches, license, score) for every row: distinct units and stretches that match, and the best match (null without one)."""
    known = sorted({(name, tuple(grams), len(re.findall(WORD, text.lower())) - 1) for name, text in (templates or TEMPLATES) if (grams := template_bigrams(text))})
    every = F.array(*map(F.lit, sorted({g for _, own, _ in known for g in own})))
    out = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = out.withColumn("words", _words(F.regexp_replace("text", LEADER, "")))
    out = out.select("doc_id", "text", F.array_intersect(_pairs(F.col("words")), every).alias("grams"))
    near = [F.when(F.size(F.array_intersect("grams", F.array(*map(F.lit, own)))) >= bounds(len(own), least)[0], F.lit(k)) for k, (_, own, _) in enumerate(known)]
    out = out.select("doc_id", "text", F.when(F.size("grams") > 0, F.array_compact(F.array(*near))).alias("near"))
    out = out.withColumn("text", F.when(F.size("near") > 0, F.col("text")))  # null: nothing can match, nothing is cut
    units = F.array_distinct(F.concat(F.split("text", "\n"), F.split("text", PARAGRAPH)))
    out = out.withColumn("whole", _whole(units, known, least))
    rest = F.regexp_replace(_without(F.col("text"), F.transform("whole", lambda u: u["body"])), LEADER, "")
    out = out.select("doc_id", "near", "whole", _words(rest).alias("words"))
    out = out.select("doc_id", "near", "whole", _pairs(F.col("words")).alias("grams"))
    out = out.withColumn("places", _places(F.col("grams"), F.col("near"), known, least))
    out = out.select("doc_id", "whole", "grams", _stretches(F.col("places"), F.col("grams"), least).alias("inside"))
    texts = F.array_distinct(F.transform("inside", lambda x: F.array_join(F.slice("grams", x["begin"] + 1, x["end"] - x["begin"] + 1), " ")))
    best = lambda kept: F.transform(kept, lambda x: F.struct(x["low"].alias("low"), x["license"].alias("license")))
    none = F.array().cast("array<struct<low: double, license: string>>")
    every = F.concat(F.coalesce(F.transform("whole", lambda u: u["best"]), none), F.coalesce(best("inside"), none))
    out = out.select("doc_id", (F.coalesce(F.size("whole"), F.lit(0)) + F.coalesce(F.size(texts), F.lit(0))).cast("long").alias("n_matches"), F.array_min(every).alias("best"))
    return out.select("doc_id", "n_matches", F.col("best.license").alias("license"), (-F.col("best.low")).alias("score"))


def oracle_sql(least: float = LEAST) -> str:
    """The same over the table documents, in DuckDB's SQL."""
    known = sorted({(name, tuple(template_bigrams(text))) for name, text in TEMPLATES})
    rows = ", ".join(f"('{name}', [{', '.join(repr(g) for g in grams)}])" for name, grams in known)
    return rf"""
WITH templates(license, own) AS (VALUES {rows}),
rows AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
bodies AS (
    SELECT DISTINCT row, unnest(string_split(text, chr(10)) || regexp_split_to_array(text, '{PARAGRAPH}')) AS body FROM rows),
words AS (SELECT row, body, regexp_extract_all(translate(body, '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM bodies),
grams AS (
    SELECT row, body, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM words WHERE len(w) > 1),
scored AS (
    SELECT row, body, license, 2 * len(list_intersect(g, own)) / (len(g) + len(own))::DOUBLE AS score
    FROM grams JOIN templates ON 2 * least(len(g), len(own)) >= {least} * (len(g) + len(own))),
best AS (
    SELECT row, count(DISTINCT body) AS n_matches, min(struct_pack(low := -score, license := license)) AS best
    FROM scored WHERE score >= {least} GROUP BY row)
SELECT doc_id, coalesce(n_matches, 0) AS n_matches, best.license AS license, -best.low AS score
FROM rows LEFT JOIN best USING (row)
"""

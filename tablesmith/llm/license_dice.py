"""Licence scan by the Dice coefficient over word bigrams, in DataFrame functions only.

Units of a text are its lines, its paragraphs of more than one line, and in lines of several
sentences the runs of as many sentences as a template has at most. A unit is normalised
(lower case, runs of anything but letters and digits become one space) and compared with the
templates that its number of distinct bigrams admits: a Dice coefficient of t needs sizes within a
factor of (2 - t) / t, and a unit that reaches it lacks only so many bigrams of the template that
of one more, whichever are chosen, it holds one. Texts without any of the chosen are left out unsplit.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Public licence notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                 "or (at your option) any later version."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                 "or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License - see the LICENSE file for details."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

SEPARATORS = r"[^\p{L}\p{N}]+"
PARAGRAPHS = r"\n[ \t\r]*\n"
SENTENCE_ENDS = r"([.!?])[ \t\r]+"


def template_bigrams(text: str) -> list[str]:
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def size_bounds(n: int, threshold: float) -> tuple[int, int]:
    """Bigram counts that can reach the threshold against a template of ``n``."""
    factor = (2 - threshold) / threshold
    return math.ceil(n / factor - 1e-9), math.floor(n * factor + 1e-9)


def marks(grams: list[str], threshold: float) -> list[str]:
    """Bigrams of a template of which every unit that reaches the threshold holds at least one.

    Such a unit holds as many of the template's bigrams as the lower size bound. Those with the longest words,
    of equals those with a digit, are chosen, as they are likely rare; that is effort only.
    """
    low, _ = size_bounds(len(grams), threshold)
    return sorted(grams, key=lambda g: (-max(map(len, g.split())), not any(map(str.isdigit, g)), g))[:len(grams) - low + 1]


def sentences_of(templates: list[tuple[str, str]]) -> int:
    """Sentences of the template that has most of them."""
    return max(len(re.split(SENTENCE_ENDS, text)) // 2 + 1 for _, text in templates)


def _spaced(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), SEPARATORS, " "))


def _any(text: Column, parts: set[str]) -> Column:
    return reduce(Column.__or__, [F.contains(text, F.lit(part)) for part in sorted(parts)])


def likely(docs: DataFrame, pairs: set[str]) -> DataFrame:
    """doc_id, text of the rows whose normalised text holds one of the bigrams.

    Both words of one in the text as it is come first; only then is it normalised.
    """
    others: dict[str, set[str]] = {}
    for pair in pairs:
        short, long = sorted(pair.split(), key=len)
        others.setdefault(long, set()).add(short)
    # as the argument of a function a text is made once, not once per word
    words = F.exists(F.array(F.lower("text")), lambda t: reduce(
        Column.__or__, [F.contains(t, F.lit(long)) & _any(t, others[long]) for long in sorted(others)]))
    return docs.select("doc_id", "text").where(words).where(F.exists(F.array(_spaced(F.col("text"))), lambda t: _any(t, pairs)))


def units(docs: DataFrame, longest: int) -> DataFrame:
    """doc_id, unit, place, first, length, body: lines, paragraphs and runs of up to ``longest`` sentences of a line.

    The three kinds come from one scan.
    """
    runs, zero = F.col("unit") == "sentences", F.array(F.lit(0))
    kinds = docs.select("doc_id", "text", F.explode(F.array(*map(F.lit, ("line", "paragraph", "sentences")))).alias("unit"))
    parts = kinds.select("doc_id", "unit", F.posexplode(
        F.when(F.col("unit") == "paragraph", F.split("text", PARAGRAPHS)).otherwise(F.split("text", "\n"))).alias("place", "body"))
    split = (parts.where((F.col("unit") != "paragraph") | F.contains("body", F.lit("\n")))
             .withColumn("s", F.when(runs, F.split(F.regexp_replace("body", SENTENCE_ENDS, "$1\n"), "\n"))
                         .otherwise(F.array("body"))))
    sized = split.withColumn("length", F.explode(F.when(runs, F.sequence(F.lit(1), F.lit(longest))).otherwise(zero))).where("length < size(s)")
    return (sized.withColumn("first", F.explode(F.when(runs, F.sequence(F.lit(0), F.size("s") - F.col("length"))).otherwise(zero)))
            .select("doc_id", "unit", "place", "first", "length",
                    F.when(runs, F.array_join(F.slice("s", F.col("first") + 1, F.col("length")), " ")).otherwise(F.col("body")).alias("body")))


def matches(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """Each unit of ``docs`` that resembles a template: doc_id, unit, place, first, length, license, template, dice.

    ``place`` counts lines or paragraphs from 0; ``first`` and ``length`` are the sentences of a run in its
    line, else 0. Null and empty texts, units of fewer than two words, and templates of fewer match
    nothing. Other columns are not read. The table of templates is part of the plan; keep it to notices.
    """
    known = [(i, name, template_bigrams(text)) for i, (name, text) in enumerate(templates)]
    known = [(i, name, grams, *size_bounds(len(grams), threshold)) for i, name, grams in known if grams]
    if not known:
        raise ValueError("a template of two words or more is needed")
    pairs = {mark for _, _, grams, *_ in known for mark in marks(grams, threshold)}
    least = min(low for *_, low, _ in known)
    sized = (units(likely(docs, pairs), sentences_of(templates)).withColumn("words", F.split(_spaced(F.col("body")), " "))
             .where(F.size("words") > least)
             .withColumn("grams", F.array_distinct(F.zip_with(
                 F.slice("words", F.lit(1), F.size("words") - 1), F.slice("words", F.lit(2), F.size("words") - 1),
                 lambda a, b: F.concat_ws(" ", a, b)))))
    scored = F.array(*[
        F.when(F.size("grams").between(low, high), F.struct(
            F.lit(name).alias("license"), F.lit(i).alias("template"),
            (F.lit(2.0) * F.size(F.array_intersect("grams", F.array(*map(F.lit, grams))))
             / (F.size("grams") + len(grams))).alias("dice")))
        for i, name, grams, low, high in known])
    place = ["doc_id", "unit", "place", "first", "length"]
    return (sized.select(*place, F.explode(F.filter(scored, lambda s: s["dice"] >= threshold)).alias("s"))
            .select(*place, "s.license", "s.template", "s.dice"))


def scan(docs: DataFrame, **options) -> DataFrame:
    """Per document and licence: doc_id, license, n_units (distinct units), dice (the best).

    A unit counts for its most similar template, of equals for the first. Rows that repeat an id are one
    document, whose units at one place count once; so are the rows of a null id.
    """
    best = F.max(F.struct("dice", (-F.col("template")).alias("later"), "license")).alias("best")
    return (matches(docs, **options).groupBy("doc_id", "unit", "place", "first", "length").agg(best)
            .groupBy("doc_id", "best.license").agg(F.count(F.lit(1)).alias("n_units"), F.max("best.dice").alias("dice")))


def scan_sql(templates: list[tuple[str, str]] = TEMPLATES, threshold: float = 0.8) -> str:
    """The same scan in SQL, every unit against every template without bounds."""
    rows = []
    for i, (name, text) in enumerate(templates):
        quoted = ", ".join("'" + g.replace("'", "''") + "'" for g in template_bigrams(text))
        rows.append(f"('{name}', {i}, [{quoted}])")
    return rf"""
WITH templates(license, template, tgrams) AS (VALUES {', '.join(rows)}),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS body,
    unnest(range(len(string_split(text, chr(10))))) AS place FROM documents),
ended AS (SELECT doc_id, place, string_split(regexp_replace(body, '([.!?])[ \t\r]+', '\1' || chr(10), 'g'), chr(10)) AS s FROM lines),
pieces AS (
  SELECT doc_id, 'line' AS unit, place, 0 AS first, 0 AS length, body FROM lines
  UNION ALL SELECT doc_id, 'paragraph', place, 0, 0, body FROM (
    SELECT doc_id, unnest(string_split_regex(text, '\n[ \t\r]*\n')) AS body,
      unnest(range(len(string_split_regex(text, '\n[ \t\r]*\n')))) AS place FROM documents) WHERE contains(body, chr(10))
  UNION ALL SELECT doc_id, 'sentences', place, i, k, array_to_string(s[i + 1:i + k], ' ')
    FROM ended, range(1, {sentences_of(templates) + 1}) AS a(k), range(0, len(s) - k + 1) AS b(i) WHERE k < len(s)),
words AS (
  SELECT doc_id, unit, place, first, length,
    string_split(trim(regexp_replace(lower(body), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS w FROM pieces),
grams AS (
  SELECT doc_id, unit, place, first, length,
    list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
  FROM words WHERE len(w) >= 2),
best AS (
  SELECT doc_id, unit, place, first, length, license, template,
    CAST(2 AS DOUBLE) * len(list_intersect(g, tgrams)) / (len(g) + len(tgrams)) AS dice
  FROM (SELECT DISTINCT * FROM grams), templates WHERE len(tgrams) > 0),
mine AS (SELECT * FROM best WHERE dice >= {threshold}
  QUALIFY row_number() OVER (PARTITION BY doc_id, unit, place, first, length ORDER BY dice DESC, template) = 1)
SELECT doc_id, license, count(*) AS n_units, max(dice) AS dice FROM mine GROUP BY ALL"""

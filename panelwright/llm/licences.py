"""Licence scans: normalised text against licence templates, by Dice coefficient over word bigrams.

Lines, paragraphs of several lines and whole texts of several lines are compared. With a and b distinct bigrams
no coefficient exceeds 2 * min(a, b) / (a + b), so only templates of t / (2 - t) to (2 - t) / t times a unit's
size can reach t; the others are not looked at. All of it is one pass of column functions, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Licence notices as they are usually written.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
     "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
     'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
     "specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
     "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
     "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
     "notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the "
     "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
     "option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
     "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies."),
)


def words(text: Column) -> Column:
    """Lower-case words of ASCII letters and digits."""
    clean = F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), "[^a-z0-9]+", " "))
    # Nothing but single blanks is left between words; a text without words is one empty one, which pairs with nothing.
    return F.split(clean, " ")


def bigrams(w: Column) -> Column:
    """Distinct pairs of neighbouring words."""
    pairs = F.zip_with(F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))),
                       F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(pairs)


def _template_bigrams(text: str) -> list[str]:
    w = "".join(c if c in LOWER or c in "0123456789" else " " for c in text.translate(str.maketrans(UPPER, LOWER))).split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:])))


def _held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is worked out once a row: the optimiser doesn't copy a generator into what refers to it."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def scan(docs: DataFrame, templates=TEMPLATES, least: float = 0.9) -> DataFrame:
    """One row per unit that matches: doc_id, unit, position, template, licence, n_common, dice.

    ``docs`` has doc_id and text; ``templates`` are (licence, text), numbered from 0, of at least two words. A unit gets its
    most similar template, the first of equals. Positions count lines or paragraphs of the text from 0. Units
    of fewer than two words match nothing, nor do null and empty texts. Repeated rows and rows with null
    doc_id are answered one by one; other columns are ignored; an empty table gives no rows.
    """
    known = F.array(*(F.struct(F.lit(i).alias("template"), F.lit(name).alias("licence"),
                               F.array(*map(F.lit, _template_bigrams(text))).alias("grams"))
                      for i, (name, text) in enumerate(templates)))
    most = max(len(_template_bigrams(t)) for _, t in templates)
    text = F.col("text").cast("string")
    numbered = lambda kind, parts, keep: F.filter(F.transform(
        parts, lambda x, i: F.struct(F.lit(kind).alias("unit"), i.alias("position"), x.alias("text"))), keep)
    several = lambda s: s["text"].contains("\n")
    lines = numbered("line", F.split(text, "\n"), lambda s: F.length(s["text"]) > 0)
    paragraphs = numbered("paragraph", F.split(text, r"\n[ \t\r]*\n"), several)
    whole = F.filter(F.array(F.struct(F.lit("text").alias("unit"), F.lit(0).alias("position"), text.alias("text"))),
                     several)
    units = docs.where(text.isNotNull()).select(
        F.col("doc_id").cast("long"), F.explode(F.concat(lines, paragraphs, whole)).alias("u")).select("doc_id", "u.*")
    ratio = (2 - least) / least
    fewest = min(len(_template_bigrams(t)) for _, t in templates)
    # A unit has fewer distinct pairs than words, and all its distinct words but one end a pair of their own.
    units = _held(units, "_words", words(F.col("text"))).drop("text").where(F.size("_words") > F.greatest(
        F.lit(1.0), F.lit(fewest / ratio))).where(F.size(F.array_distinct("_words")) - 1 <= most * ratio)
    units = _held(units, "grams", bigrams(F.col("_words"))).drop("_words")
    size = F.size("grams")
    units = units.where((size > 0) & (size <= most * ratio))
    fits = F.filter(known, lambda t: (F.size(t["grams"]) <= F.size("grams") * ratio) & (F.size("grams") <= F.size(t["grams"]) * ratio))
    units = _held(units, "_fits", fits).where(F.size("_fits") > 0)
    common = F.transform("_fits", lambda t: F.struct(
        t["template"].alias("template"), t["licence"].alias("licence"), F.size(t["grams"]).alias("size"),
        F.size(F.array_intersect("grams", t["grams"])).alias("n_common")))
    scored = F.transform(F.col("_common"), lambda t: F.struct(
        (-t["n_common"] * 2.0 / (F.size("grams") + t["size"])).alias("order"),
        t["template"].alias("template"), t["licence"].alias("licence"), t["n_common"].alias("n_common")))
    units = _held(_held(units, "_common", common), "best", F.array_min(scored))
    best = units.select("doc_id", "unit", "position", "best").where(F.col("best.order") <= -least)
    return best.select("doc_id", "unit", "position", "best.template", "best.licence", "best.n_common",
                       F.round(-F.col("best.order"), 9).alias("dice"))


def sql(templates=TEMPLATES, least: float = 0.9) -> str:
    """DuckDB's answer over the table documents."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({i}, {quote(name)}, {quote(text)})" for i, (name, text) in enumerate(templates))
    grams = ("list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))])")
    clean = lambda t: (f"[x for x in string_split(trim(regexp_replace(translate({t}, '{UPPER}', '{LOWER}'), "  # noqa: E731
                       "'[^a-z0-9]+', ' ', 'g')), ' ') if x <> '']")
    return f"""
with raw as (
  select doc_id, 'line' as unit, string_split(text, chr(10)) as parts from documents
  union all select doc_id, 'paragraph', regexp_split_to_array(text, '\\n[ \\t\\r]*\\n') from documents
  union all select doc_id, 'text', [text] from documents),
units as (select doc_id, unit, unnest(parts) as text, unnest(range(len(parts)))::integer as position from raw),
chosen as (select doc_id, unit, position, {clean('text')} as w from units
           where case unit when 'line' then text <> '' else contains(text, chr(10)) end),
a as (select doc_id, unit, position, {grams} as g, row_number() over () as n from chosen where len(w) > 1),
t as (select template, licence, {grams} as g from (
        select template, licence, {clean('text')} as w from (values {rows}) v(template, licence, text))),
s as (select doc_id, unit, position, n, template, licence, len(list_intersect(a.g, t.g))::integer as n_common,
             2.0::double * len(list_intersect(a.g, t.g)) / (len(a.g) + len(t.g)) as dice from a join t on len(a.g) > 0)
select doc_id, unit, position, template, licence, n_common, round(dice, 9) as dice from s where dice >= {least}
qualify row_number() over (partition by n order by dice desc, template) = 1"""

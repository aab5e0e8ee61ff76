"""Find license notices in documents: phrases, and templates by an exact set-similarity join."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import documents

# Phrases that always count, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices as licensors ask to have them written, with their labels.
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in"
     " compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License"
     " is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
     " See the License for the specific language governing permissions and limitations under the License."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
     " associated documentation files, to deal in the Software without restriction, including without limitation"
     " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,"
     " and to permit persons to whom the Software is furnished to do so"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
     " General Public License as published by the Free Software Foundation, either version 3 of the License, or"
     " (at your option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU"
     " Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "it under the terms of the GNU Affero General Public License as published by the Free Software"
     " Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
     " that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the"
     " following disclaimer."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
     " hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("public-domain", "This is free and unencumbered software released into the public domain."),
]

CONTAINMENT = 0.8
# Blocks are windows of twice a template's class of length, a class apart, so that any run of
# words as long as a template lies whole in some block. Longer templates get doubled classes.
LENGTHS = (16, 32, 128)

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PHRASE = "(?<![^ ])(?:" + "|".join(PHRASES) + ")(?![^ ])"


def _listed_words(text: str) -> list[str]:
    return "".join(c.lower() if c.isascii() and c.isalnum() else " " for c in text).split()


def template_words(text: str) -> list[str]:
    return sorted(set(_listed_words(text)))


def length_class(text: str) -> int:
    """The smallest class that holds all words of a template, repeated ones included."""
    words = len(_listed_words(text))
    found = next((n for n in LENGTHS if n >= words), LENGTHS[-1])
    while found < words:
        found *= 2
    return found


def spaced_words(text: Column) -> Column:
    """The words of a text, one space between them.

    ``lower`` also folds letters beyond ASCII; it leaves every word character a word character,
    so the words stay the same in number, and those of ASCII letters the same in spelling.
    """
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _SEPARATORS, " "))


def _texts(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def word_documents(docs: DataFrame, words: list[str]) -> dict[str, int]:
    """In how many documents each of the given words stands; at most one number per given word."""
    found = (
        docs.select(
            F.explode(F.array_intersect(F.split(spaced_words(F.col("text")), " "), _texts(words))).alias("word")
        )
        .groupBy("word")
        .count()
        .collect()
    )
    return dict.fromkeys(words, 0) | {r["word"]: r["count"] for r in found}


def _windows(length: int, order: list[str]) -> Column:
    """Blocks of twice the length, the length apart: the ranks of their distinct template words, sorted."""
    held = _texts(order)

    def block(start: Column) -> Column:
        known = F.array_intersect(F.slice("words", start + 1, F.lit(2 * length)), held)
        ranks = F.transform(known, lambda w: F.array_position(held, w).cast("int") - 1)
        return F.struct(F.lit(length).alias("length"), F.array_sort(ranks).alias("ranks"))

    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(length))
    return F.transform(starts, block)


def scan_licenses(docs: DataFrame, templates=TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """License phrases and template matches of each document, one row per input row.

    A block of words matches a template when it holds at least ``containment`` of the template's
    distinct words. The join is exact. Words are put in one order, the rarest in all documents
    first. To hold a of the t words of a template, a block must share one of the template's first
    t - a + 1 words (prefix filter), hold at least a words of any template (length filter), and
    have a words left from the shared one on, as must the template (positional filter). What
    remains is counted.

    A document without any prefix word makes no block. Words outside all templates cannot match,
    so only the frequencies of template words are gathered: one number per template word.

    A null or empty text has no words, no labels and score 0. Repeated rows give repeated rows.
    Other columns of ``docs`` are ignored.

    Result: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (1 for a
    phrase, else the largest containment that reached the threshold, else 0), n_blocks (matching
    blocks).
    """
    sets = [(label, template_words(text), length_class(text)) for label, text in templates]
    vocabulary = sorted({w for _, words, _ in sets for w in words})
    documents_of = word_documents(docs, vocabulary)
    order = sorted(vocabulary, key=lambda w: (documents_of[w], w))
    rank = {w: i for i, w in enumerate(order)}

    index = []
    for number, (label, words, length) in enumerate(sets):
        ranks = sorted(rank[w] for w in words)
        least = math.ceil(containment * len(ranks) - 1e-9)
        for place in range(len(ranks) - least + 1):
            index.append((ranks[place], number, label, len(ranks) - place, least, length, ranks))
    prefix = sorted({order[entry[0]] for entry in index})
    index = docs.sparkSession.range(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(first).alias("token"), F.lit(number).alias("template"), F.lit(label).alias("label"),
                        F.lit(left).alias("t_left"), F.lit(least).alias("least"), F.lit(length).alias("t_length"),
                        F.array(*map(F.lit, ranks)).alias("t_ranks"),
                    )
                    for first, number, label, left, least, length, ranks in index
                ]
            )
        )
    )

    words = F.split("norm", " ")
    windows = [_windows(length, order) for length in sorted({length for _, _, length in sets})]
    base = F.when(
        F.col("norm").contains("license") | F.col("norm").contains("cc by"),
        F.regexp_extract_all("norm", F.lit(_PHRASE), F.lit(0)),
    ).otherwise(F.array().cast("array<string>"))
    pieces = F.split("norm", _PHRASE)
    found = F.size("matches") > 0
    phrase_label = F.create_map(*[F.lit(x) for item in PHRASES.items() for x in item])
    rows = (
        docs.select("doc_id", spaced_words(F.col("text")).alias("norm"))
        .withColumn("words", F.when(F.col("norm") == "", F.array().cast("array<string>")).otherwise(words))
        .withColumn("matches", base)
        .select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            F.size("matches").cast("long").alias("n_base"),
            F.when(found, _spaces(pieces[0])).cast("long").alias("first_word"),
            F.when(
                found,
                F.size("words") - _spaces(F.element_at(pieces, -1))
                - _spaces(F.element_at("matches", F.when(found, -1).otherwise(1))) - 1,
            ).cast("long").alias("last_word"),
            F.transform(F.array_distinct("matches"), lambda p: phrase_label[p]).alias("base"),
            F.when(F.arrays_overlap("words", _texts(prefix)), F.concat(*windows)).alias("windows"),
        )
    )
    blocks = rows.select(
        *[c for c in rows.columns if c != "windows"], F.posexplode_outer("windows").alias("block", "window")
    ).select(
        *[c for c in rows.columns if c != "windows"], "block", "window.length", "window.ranks",
        F.posexplode_outer("window.ranks").alias("place", "token"),
    )
    fits = (
        (blocks["token"] == index["token"])
        & (blocks["length"] == index["t_length"])
        & (F.size("ranks") >= F.col("least"))
        & (F.least(F.col("t_left"), F.size("ranks") - F.col("place")) >= F.col("least"))
    )
    shared = F.size(F.array_intersect("ranks", "t_ranks"))
    match = F.when(
        shared >= F.col("least"),
        F.struct((shared / F.size("t_ranks")).alias("share"), F.col("label"), F.col("block"), F.col("template")),
    )
    labels = F.array_sort(F.array_distinct(F.concat("base", F.col("hits.label"))))
    return (
        blocks.join(F.broadcast(index), fits, "left")
        .withColumn("match", match)
        .groupBy("row", "doc_id", "n_words", "n_base", "first_word", "last_word", "base")
        # Different matches of a document: a block and a template each.
        .agg(F.collect_set("match").alias("hits"))
        .select(
            "doc_id", "n_words", "n_base", "first_word", "last_word",
            F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
            F.array_join(labels, ",").alias("labels"),
            F.when(F.col("n_base") > 0, 1.0)
            .otherwise(F.coalesce(F.array_max("hits.share"), F.lit(0.0)))
            .alias("score"),
            F.size(F.array_distinct("hits.block")).cast("long").alias("n_blocks"),
        )
    )


def license_query(spark, sf_dir) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _template_rows() -> str:
    rows = []
    for number, (label, text) in enumerate(TEMPLATES):
        rows.append(f"({number}, '{label}', {length_class(text)}, {_sql_list(template_words(text))})")
    return ",\n".join(rows)


LICENSE_SQL = f"""
WITH norm AS (
  SELECT row_number() OVER () AS r, doc_id, trim(regexp_replace(lower(coalesce(text, '')),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g'), ' ') AS norm FROM documents),
listed AS (SELECT *, CASE WHEN norm = '' THEN []::VARCHAR[] ELSE string_split(norm, ' ') END AS words FROM norm),
phrases(phrase, label) AS (VALUES {", ".join(f"('{p}', '{v}')" for p, v in PHRASES.items())}),
places AS (
  SELECT r, label, unnest(list_filter(range(1, len(words) + 1), lambda i:
    list_slice(words, i, i + len(string_split(phrase, ' ')) - 1) = string_split(phrase, ' '))) - 1 AS place
  FROM listed, phrases WHERE contains(norm, phrase)),
base AS (
  SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels, list(DISTINCT label) AS base_list
  FROM places GROUP BY r),
templates(template, label, length, tokens) AS (VALUES
{_template_rows()}),
lengths AS (SELECT DISTINCT length FROM templates),
windows AS (
  SELECT r, length, unnest(range(0, greatest(len(words), 1), length)) AS start, words FROM listed, lengths),
blocks AS (
  SELECT r, length, start, list_distinct(list_slice(words, start + 1, start + 2 * length)) AS held FROM windows),
hits AS (
  SELECT r, b.length, start, label,
    len(list_intersect(held, tokens))::DOUBLE / len(tokens)::DOUBLE AS share
  FROM blocks b JOIN templates t ON b.length = t.length
  WHERE len(list_intersect(held, tokens)) >= ceil({CONTAINMENT} * len(tokens) - 1e-9)),
method AS (
  SELECT r, max(share) AS share, list(DISTINCT label) AS found, count(DISTINCT (length, start)) AS n_blocks
  FROM hits GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
  first_word::BIGINT AS first_word, last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base_list, []), coalesce(found, [])))), ',') AS labels,
  CASE WHEN coalesce(n_base, 0) > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score,
  coalesce(n_blocks, 0)::BIGINT AS n_blocks
FROM listed LEFT JOIN base USING (r) LEFT JOIN method USING (r)
"""

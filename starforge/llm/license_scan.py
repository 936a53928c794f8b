"""License scan: exact set-similarity join of text blocks with notice templates.

Blocks are runs of ``BLOCK`` words starting at every ``STRIDE``-th word, so a
notice of up to ``BLOCK - STRIDE`` words lies whole in one block wherever it
starts and however its lines wrap.  A block belongs to a template when it
holds at least ``PERCENT`` per cent of the template's distinct words, or all of
them if they are fewer than ``SHORT`` (one word tells short notices apart).  All such
(block, template) pairs are found:

* *frequency order*: one aggregation counts the documents of every template
  word; words are ranked from rare to frequent (ties by the word).
* *prefix filter*: a pair over the threshold shares one of the template's
  ``size - need + 1`` rarest words, so only blocks around such words are built.
* *length filter*: a block with fewer than ``need`` template words is out.
* *positional filter*: words that rank after the first shared one, on either
  side, bound the overlap still possible.
* *verification*: the overlap is counted on the whole sets.

The templates are fixed, so their side of the join is part of the projection:
the only shuffle carries one counter per template word.  Built-in functions
only.

Defined results: NULL or empty text: no words, no labels, score 0, NULL first
and last word.  Rows are judged one by one (repeated rows repeat their result);
other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import ascii_lower, id_text

BLOCK, STRIDE, PERCENT, SHORT = 48, 24, 80, 10

# Base phrases (all end in "license") and their labels
BASE = [("mit", ["mit", "license"]), ("apache", ["apache", "license"]),
        ("gpl", ["general", "public", "license"])]

# Sentences by which public licences are declared
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mit", "Released under the MIT License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc", "Licensed under CC BY-NC 4.0"),
    ("cc", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose is hereby granted"),
    ("public-domain", "This is free and unencumbered software released into the public domain"),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced without prior written permission"),
]

SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def _template_sets() -> list[tuple[str, list[str], int]]:
    """(label, distinct words, words needed) of every template."""
    out = []
    for label, text in TEMPLATES:
        words = sorted(set(re.findall("[0-9a-z]+", text.lower())))
        percent = PERCENT if len(words) >= SHORT else 100
        out.append((label, words, -(-percent * len(words) // 100)))
    return out


def _words(docs: DataFrame) -> DataFrame:
    t = ascii_lower(F.coalesce("text", F.lit("")))
    return docs.select("doc_id", F.filter(F.split(t, SEPARATORS), lambda x: x != "").alias("w"))


def word_ranks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict[str, int]:
    """Rank of every template word by the documents that hold it, rarest
    first.  The result is as large as the templates' vocabulary."""
    vocab = sorted({w for _, ws, _ in _template_sets() for w in ws})
    found = _words(id_text(docs, id_col, text_col)).select(
        F.explode(F.array_distinct(F.filter("w", lambda x: x.isin(vocab)))).alias("word"))
    n = {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {w: i for i, w in enumerate(sorted(vocab, key=lambda w: (n.get(w, 0), w)))}


def _ints(values) -> Column:
    return F.array(*[F.lit(int(v)) for v in values])


def _starts(phrase: list[str]) -> Column:
    """Starts of a base phrase, from the places of its last word."""
    def whole(i):
        ok = F.lit(True)
        for back, word in enumerate(reversed(phrase[:-1]), 1):
            ok = ok & (F.get("w", i - back) == F.lit(word))
        return F.coalesce(ok, F.lit(False))
    return F.transform(F.filter("ends", whole), lambda i: i - (len(phrase) - 1))


def _best_overlap(ranks: list[int], need: int) -> Column:
    """Largest overlap of a block of the row with a template, over the blocks
    that pass the prefix, length and positional filters (else NULL)."""
    prefix, whole, size = _ints(ranks[:len(ranks) - need + 1]), _ints(ranks), len(ranks)

    def possible(x):
        shared = F.array_min(F.array_intersect(x, prefix))       # rarest shared word
        left = F.least(F.lit(size) - F.array_position(whole, shared),
                       F.size(x) - F.array_position(x, shared))
        return (F.size(x) >= need) & F.arrays_overlap(x, prefix) & (left + 1 >= need)

    return F.array_max(F.transform(F.filter("blocks", possible),
                                   lambda x: F.size(F.array_intersect(x, whole))))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: word count, base phrase places, labels and the
    largest containment (1 where a base phrase stands)."""
    rank = word_ranks(docs, id_col, text_col)
    templates = [(label, sorted(rank[w] for w in ws), need) for label, ws, need in _template_sets()]
    prefixes = {r for _, ranks, need in templates for r in ranks[:len(ranks) - need + 1]}
    prefix_words = [w for w, r in rank.items() if r in prefixes]
    to_rank = F.create_map(*[F.lit(x) for w, r in rank.items() for x in (w, r)])

    d = _words(id_text(docs, id_col, text_col))
    places = lambda hit: F.array_compact(F.transform("w", lambda x, i: F.when(hit(x), i)))
    d = d.select("doc_id", "w", F.size("w").cast("long").alias("n_words"),
                 places(lambda x: x == "license").alias("ends"),
                 places(lambda x: x.isin(prefix_words)).alias("hits"))

    for label, phrase in BASE:
        d = d.withColumn(f"at_{label}", _starts(phrase))

    # candidate blocks: the two that cover each prefix word, as sorted ranks
    numbers = F.array_distinct(F.filter(F.flatten(F.transform("hits", lambda i: F.array(
        (i / STRIDE).cast("int"), (i / STRIDE).cast("int") - 1))), lambda b: b >= 0))
    d = d.withColumn("numbers", numbers)
    d = d.withColumn("blocks", F.transform("numbers", lambda b: F.sort_array(F.array_compact(
        F.transform(F.array_distinct(F.slice("w", b * STRIDE + 1, BLOCK)),
                    lambda x: F.element_at(to_rank, x))))))

    names = []
    for n, (label, ranks, need) in enumerate(templates):
        d = d.withColumn(f"best_{n}", _best_overlap(ranks, need))
        names.append((label, f"best_{n}", len(ranks), need))

    starts = F.concat(*[F.col(f"at_{label}") for label, _ in BASE])
    base = [F.when(F.size(f"at_{label}") > 0, F.lit(label)) for label, _ in BASE]
    method = [F.when(F.col(c) >= need, F.lit(label)) for label, c, _, need in names]
    shares = [F.when(F.col(c) >= need, F.col(c) / F.lit(float(size))).otherwise(0.0)
              for _, c, size, need in names]
    joined = lambda cols: F.array_join(F.array_sort(F.array_distinct(
        F.array_compact(F.array(*cols)))), ",")
    return d.select(
        "doc_id", "n_words", F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        joined(base).alias("base_labels"), joined(base + method).alias("labels"),
        F.greatest(F.when(F.size(starts) > 0, 1.0).otherwise(0.0), *shares).alias("score"))


def license_sql() -> str:
    """Every block against every template, without filters."""
    sets = ", ".join("({}, '{}', [{}], {}, {})".format(
        n, label, ", ".join(f"'{w}'" for w in ws), len(ws), need)
        for n, (label, ws, need) in enumerate(_template_sets()))
    phrases = ", ".join("('{}', [{}], {})".format(label, ", ".join(f"'{w}'" for w in p), len(p))
                        for label, p in BASE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
p(label, words, n) AS (VALUES {phrases}),
s(k, label, words, size, need) AS (VALUES {sets}),
hit AS (SELECT r, p.label, i FROM (SELECT r, w, unnest(range(0, len(w))) AS i FROM d) x, p
        WHERE list_slice(w, i + 1, i + p.n) = p.words),
b AS (SELECT r, list_distinct(list_slice(w, {STRIDE} * i + 1, {STRIDE} * i + {BLOCK})) AS ws
      FROM (SELECT r, w, unnest(range(0, (len(w) + {STRIDE} - 1) // {STRIDE})) AS i FROM d)),
j AS (SELECT r, label, len(list_intersect(ws, words)) AS n, size, need FROM b, s),
m AS (SELECT r, label, max(n / CAST(size AS DOUBLE)) AS share FROM j WHERE n >= need GROUP BY r, label),
hb AS (SELECT r, count(*) AS n, min(i) AS lo, max(i) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM hit GROUP BY r),
al AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
       FROM (SELECT r, label FROM hit UNION SELECT r, label FROM m) GROUP BY r),
ms AS (SELECT r, max(share) AS share FROM m GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hb.n, 0) AS BIGINT) AS n_base,
       CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word,
       coalesce(hb.labels, '') AS base_labels, coalesce(al.labels, '') AS labels,
       CASE WHEN hb.n > 0 THEN 1.0 ELSE coalesce(share, 0.0) END AS score
FROM d LEFT JOIN hb USING (r) LEFT JOIN al USING (r) LEFT JOIN ms USING (r)
"""

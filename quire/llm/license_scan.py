"""License scan: exact set-similarity join of text blocks with notice templates, in DataFrame functions.

A block is a run of ``BLOCK`` words, one starting every ``BLOCK / 2`` words, so every passage of half
a block lies whole in some block. Tokens are ordered by how many documents hold them, rarest first.
A template of t tokens is found in a block that holds o = ceil(threshold * t) of them, so

* length: the block has at least o template tokens;
* prefix: the first t - o + 1 tokens of the template and the first |B| - o + 1 of the block share one;
* position: a shared token at positions i and j leaves at most min(t - i, |B| - j) common tokens.

Pairs that pass are counted exactly. Tokens that no template has change no overlap and are left out
of blocks beforehand.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK, THRESHOLD = 64, 0.9

#: Phrases whose places are counted, and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Wording of licence notices, and their labels.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "gnu lesser general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0-1.0", "to the extent possible under law the author has waived all copyright and related rights"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("reserved", "copyright all rights reserved"),
)

_SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text, ASCII-lower-cased; a null text has none.

    ``lower`` also folds other letters, which changes neither the number of words nor any ASCII
    word, save for the two letters whose lower case is ASCII; they are kept apart first.
    """
    kept = F.when(text.rlike("[Kİ]"), F.translate(text, "Kİ", "ĸı")).otherwise(text)
    return F.array_remove(F.split(F.lower(F.coalesce(kept, F.lit(""))), _SEPARATOR), "")


def token_counts(tokens: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many rows of ``words`` each vocabulary token occurs; as many rows as the vocabulary has."""
    found = tokens.select(F.explode(F.array_intersect("words", F.array(*map(F.lit, vocabulary)))).alias("t"))
    return {r["t"]: r["count"] for r in found.groupBy("t").count().collect()}


def prefix_index(counts: dict[str, int], templates, threshold: float) -> tuple[dict[str, int], list[dict]]:
    """Ranks of all template tokens (rarest first) and, per template, its ranked tokens, o and label."""
    vocabulary = sorted({w for _, t in templates for w in t.split()}, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(vocabulary)}
    out = []
    for label, text in templates:
        ranks = sorted({rank[w] for w in text.split()})
        out.append({"label": label, "ranks": ranks, "least": math.ceil(threshold * len(ranks) - 1e-9)})
    return rank, out


def _longs(values) -> Column:
    return F.array(*(F.lit(v) for v in values))


def _phrase_at(parts: list[str]):
    def test(i: Column) -> Column:
        cond = F.get("words", i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            cond = cond & (F.get("words", i + k) == part)
        return cond

    return test


def base_places(df: DataFrame) -> DataFrame:
    """``words`` in, arrays of the starts of each phrase out: ``at0``, ``at1``, ...

    A place needs its phrase's rarest word, so other rows skip the walk over their words.
    """
    out = df
    for k, (phrase, _) in enumerate(PHRASES):
        parts = phrase.split()
        walk = F.filter(F.sequence(F.lit(0), F.size("words") - len(parts)), _phrase_at(parts))
        some = F.size("words") >= len(parts)
        for part in parts:
            some = some & F.array_contains("words", part)
        out = out.withColumn(f"at{k}", F.when(some, walk).otherwise(F.array().cast("array<int>")))
    return out


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """Per row: ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``.

    ``score`` is 1 where a base phrase stands, else the highest containment of a template that was
    found, else 0. Null and wordless texts have no words, no labels and score 0; repeated rows and
    null ids are kept; an empty table gives an empty result.
    """
    tokens = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col), words(F.col(text_col).cast("string")).alias("words"))
    vocabulary = sorted({w for _, t in templates for w in t.split()})
    rank, index = prefix_index(token_counts(tokens, vocabulary), templates, threshold)
    rarest = {r for t in index for r in t["ranks"][: len(t["ranks"]) - t["least"] + 1]}
    prefix_words = F.array(*(F.lit(w) for w, r in rank.items() if r in rarest))
    ranks = F.create_map(*(x for w, r in rank.items() for x in (F.lit(w), F.lit(r))))

    half = block // 2
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - half), F.lit(half))
    marked = base_places(tokens).select(
        "row",
        id_col,
        F.size("words").cast("bigint").alias("n_words"),
        *(f"at{k}" for k in range(len(PHRASES))),
        F.when(F.arrays_overlap("words", prefix_words), F.transform(starts, lambda i: F.slice("words", i, block))).alias("blocks"),
    )
    blocks = marked.select("*", F.explode_outer("blocks").alias("block")).drop("blocks")
    held = F.transform(F.array_intersect("block", F.array(*map(F.lit, rank))), lambda w: F.element_at(ranks, w))
    blocks = blocks.withColumn("held", F.array_sort(held)).drop("block")

    pairs = _longs([]).cast("array<struct<label:string,part:double>>")
    for t in index:
        size, least = len(t["ranks"]), t["least"]
        n = F.size("held")
        # first shared token of the two prefixes, and its positions on both sides
        prefix = _longs(t["ranks"][: size - least + 1])
        shared = F.array_intersect(prefix, F.slice("held", 1, F.greatest(F.lit(0), n - least + 1)))
        first = F.get(shared, F.lit(0))
        room = F.least(size - F.array_position(_longs(t["ranks"]), first), n - F.array_position("held", first)) + 1
        passes = (n >= least) & (F.size(shared) > 0) & (room >= least)
        overlap = F.size(F.array_intersect("held", _longs(t["ranks"])))
        hit = F.when(passes, F.when(overlap >= least, F.array(F.struct(F.lit(t["label"]).alias("label"), (overlap / size).alias("part")))))
        pairs = F.concat(pairs, F.coalesce(hit, _longs([]).cast("array<struct<label:string,part:double>>")))
    found = blocks.withColumn("found", F.when(F.size("held") > 0, pairs))

    at = F.concat(*(f"at{k}" for k in range(len(PHRASES))))
    per_row = found.groupBy("row").agg(
        F.first(id_col).alias(id_col),
        F.first("n_words").alias("n_words"),
        *(F.first(f"at{k}").alias(f"at{k}") for k in range(len(PHRASES))),
        F.array_distinct(F.flatten(F.collect_set("found"))).alias("found"),
    )
    base = F.array_compact(F.array(*(F.when(F.size(f"at{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(PHRASES))))
    method = F.transform("found", lambda f: f["label"])
    return per_row.select(
        id_col,
        "n_words",
        F.size(at).cast("bigint").alias("n_base"),
        F.array_min(at).cast("bigint").alias("first_word"),
        F.array_max(at).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, method)), ",").alias("labels"),
        F.when(F.size(at) > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("found", lambda f: f["part"])), F.lit(0.0))).alias("score"),
    )


def brute_force_sql(templates=TEMPLATES, threshold: float = THRESHOLD, block: int = BLOCK) -> str:
    """DuckDB SQL of the same result by comparing every block with every template."""
    values = ", ".join(f"('{label}', {i}, '{text}')" for i, (label, text) in enumerate(templates))
    phrases = ", ".join(f"('{p}', '{label}', {len(p.split())})" for p, label in PHRASES)
    half = block // 2
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
ph(p, label, m) AS (VALUES {phrases}),
place AS (SELECT r, label, i - 1 AS i FROM (SELECT r, w, label, p, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, ph WHERE len(w) >= m) WHERE array_to_string(w[i:i + m - 1], ' ') = p),
base AS (SELECT r, count(*) AS n, min(i) AS a, max(i) AS b, list_sort(list_distinct(list(label))) AS l FROM place GROUP BY r),
t AS (SELECT label, k, list_distinct(string_split(x, ' ')) AS ws FROM (VALUES {values}) v(label, k, x)),
blk AS (SELECT r, list_distinct(w[i:i + {block - 1}]) AS ws FROM (SELECT r, w, unnest(range(1, greatest(1, len(w) - {half}) + 1, {half})) AS i FROM d)),
f AS (SELECT r, label, max(len(list_intersect(blk.ws, t.ws)) / len(t.ws)) AS part FROM blk, t
      WHERE len(list_intersect(blk.ws, t.ws)) >= ceil({threshold} * len(t.ws) - 1e-9) GROUP BY r, label),
g AS (SELECT r, list(label) AS l, max(part) AS part FROM f GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, CAST(a AS BIGINT) AS first_word, CAST(b AS BIGINT) AS last_word,
       coalesce(array_to_string(base.l, ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.l, []), coalesce(g.l, [])))), ',') AS labels,
       CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(part, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN g USING (r)
"""

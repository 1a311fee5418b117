"""License scans: places of fixed phrases, and an exact set-similarity join of text blocks with license templates.

A block is a line, or a window of words whatever the line breaks: windows are twice as long as the longest template and each
overlaps half of the next, so that a notice wrapped over lines lies whole in one. For the join a block's words are a set, of which only words that occur in a template count: others add nothing to
an overlap. All template words are ordered by the number of documents that hold them, the rarest first. A template of n words
reaches the containment threshold only with ceil(threshold * n) of them in the block, so one of its first words in that order
must be there (prefix filter), the block needs that many template words (length filter), and what may still follow in both
orders after a shared prefix word has to suffice (positional filter). What passes is counted in full. A block takes every
template that reaches the threshold, less those whose words in the block are only some of another one's.

Everything is a DataFrame expression. The templates are constants of this module and their rows are broadcast. Documents are
never shuffled with their texts.

Defined results: null and empty texts have no words and no labels; rows that repeat come back each for itself; a null ``doc_id``
stays null; other columns are not read; an empty table gives no rows. Very long lines are blocks like all others.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CONTAINMENT = 0.9

# The phrases of the base labels, from the contract.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Wording of common public license notices, in words.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]

#: Words from one window to the next.
STEP = max(len(t.split(" ")) for _, t in TEMPLATES)

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """A-Z in lower case. Of other characters only the Kelvin sign and the dotted capital I would become ASCII letters; they are
    set aside first, as other letters beyond ASCII."""
    kept = F.replace(F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("K"), F.lit("ķ")), F.lit("İ"), F.lit("ı"))
    return F.lower(kept)


def spaced(low: Column) -> Column:
    """The words of a lower-cased text, each between single blanks; a lone blank if there is none."""
    return F.regexp_replace(F.concat(F.lit(" "), low, F.lit(" ")), _SEPARATORS, " ")


def _any_base(words: Column) -> Column:
    return reduce(lambda a, b: a | b, [words.contains(f" {p} ") for p in PHRASES])


def _blanks(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def phrase_starts(words: Column) -> Column:
    """Where the phrases start: an array of (start, label). The words between a phrase's places are counted part by part; no
    phrase overlaps itself."""

    def of(phrase: str, label: str) -> Column:
        size = phrase.count(" ") + 1
        parts = F.split(words, f"(?<= ){phrase}(?= )")
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("found"))

        def step(seen: Column, part: Column) -> Column:
            at = seen.at + _blanks(part) - 1
            return F.struct((at + size).alias("at"), F.concat(seen.found, F.array(at)).alias("found"))

        found = F.aggregate(parts, start, step, lambda seen: F.slice(seen.found, F.lit(1), F.size(seen.found) - 1))
        return F.when(words.contains(f" {phrase} "), F.transform(found, lambda i: F.struct(i.alias("start"), F.lit(label).alias("label"))))

    none = F.array().cast("array<struct<start:bigint,label:string>>")
    return F.concat(*[F.coalesce(of(phrase, label), none) for phrase, label in PHRASES.items()])


def word_order(documents: DataFrame) -> list[str]:
    """Every template word, by the number of documents that hold it, then by itself."""
    vocabulary = sorted({w for _, t in TEMPLATES for w in t.split(" ")})
    own = F.array(*map(F.lit, vocabulary))
    held = documents.select(F.explode(F.array_intersect(F.split(spaced(lowered(F.col("text"))), " "), own)).alias("word"))
    counts = {r.word: r.n for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}  # one row a template word
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def template_rows(spark: SparkSession, order: list[str], containment: float) -> DataFrame:
    """A row for each word of each template's prefix: the word, its place, the template's size and the overlap it needs."""
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for k, (label, text) in enumerate(TEMPLATES):
        own = sorted(set(text.split(" ")), key=rank.__getitem__)
        need = math.ceil(containment * len(own) - 1e-9)
        rows += [(w, i, k, label, own, len(own), need) for i, w in enumerate(own[: len(own) - need + 1])]
    return spark.createDataFrame(rows, "word string, t_place int, template int, label string, t_words array<string>, t_size int, need int")


def scan(documents: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_blocks`` of every row: the phrases' places
    and labels, the labels with those of the join, the largest containment (1 with a phrase), and how many lines matched, or windows where no line did."""
    spark = documents.sparkSession
    order = word_order(documents)
    prefixes = template_rows(spark, order, containment)
    firsts = sorted({r.word for r in prefixes.select("word").distinct().collect()})
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), lowered(F.col("text")).alias("low"))
    docs = docs.select("doc_id", "low", spaced(F.col("low")).alias("words"))
    docs = docs.select("doc_id", "low", "words", F.when(F.length("words") > 1, _blanks(F.col("words")) - 1).otherwise(0).cast("long").alias("n_words"))
    ordered = F.array(*map(F.lit, order))
    # without a prefix word no line can match
    some = F.arrays_overlap(F.split("words", " "), F.array(*map(F.lit, firsts)))
    lines = F.when(some, F.transform(F.split("low", "\n"), lambda line: F.array_intersect(ordered, F.split(spaced(line), " "))))
    least = min(r.need for r in prefixes.select("need").distinct().collect())
    lines = F.filter(lines, lambda b: F.size(b) >= least)
    # the words are bound once, not split for each window
    of = lambda own: F.transform(F.sequence(F.lit(1), F.size(own), F.lit(STEP)), lambda i: F.array_intersect(ordered, F.slice(own, i, 2 * STEP)))
    windows = F.when(some, F.flatten(F.transform(F.array(F.split("words", " ")), of)))
    windows = F.filter(windows, lambda b: F.size(b) >= least)
    starts = F.when(_any_base(F.col("words")), phrase_starts(F.col("words")))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", starts.alias("base"), lines.alias("lines"), windows.alias("windows"))
    base = F.coalesce("base", F.array().cast("array<struct<start:bigint,label:string>>"))
    rows = rows.select(
        "row",
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda b: b.start)).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda b: b.start)).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(F.transform(base, lambda b: b.label))).alias("base_list"),
        F.coalesce(F.size("lines"), F.lit(0)).alias("n_lines"),
        F.posexplode_outer(F.concat("lines", "windows")).alias("block", "b_words"),
    )
    words = rows.select("*", F.posexplode_outer("b_words").alias("b_place", "word"))
    pairs = words.join(F.broadcast(prefixes), "word", "left")  # a few rows for each template
    rest = 1 + F.least(F.col("t_size") - F.col("t_place") - 1, F.size("b_words") - F.col("b_place") - 1)
    passes = (F.size("b_words") >= F.col("need")) & (rest >= F.col("need"))
    common = F.when(passes, F.array_intersect("b_words", "t_words"))
    overlap = F.size(common)
    matched = F.when(overlap >= F.col("need"), F.struct(common.alias("common"), (overlap / F.col("t_size")).alias("share"), F.col("label").alias("label")))
    keys = ["row", "doc_id", "n_words", "n_base", "first_word", "last_word", "base_list", "n_lines"]
    found = pairs.select(*keys, "block", matched.alias("m")).groupBy(*keys).agg(F.collect_set(F.when(F.col("m").isNotNull(), F.struct("block", "m"))).alias("ms"))
    within = lambda x, y: (F.size(y.m.common) > F.size(x.m.common)) & (F.size(F.array_except(x.m.common, y.m.common)) == 0)
    best = F.filter("ms", lambda x: ~F.exists("ms", lambda y: (y.block == x.block) & within(x, y)))
    labels = F.array_sort(F.array_union("base_list", F.transform(best, lambda x: x.m.label)))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("ms", lambda x: x.m.share)), F.lit(0.0)))
    blocks = F.array_distinct(F.transform("ms", lambda x: x.block))
    of_lines = F.size(F.filter(blocks, lambda b: b < F.col("n_lines")))
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_list", ",").alias("base_labels"),
        F.array_join(F.array_distinct(labels), ",").alias("labels"),
        score.alias("score"),
        F.when(of_lines > 0, of_lines).otherwise(F.size(blocks)).alias("n_blocks"),
    )


def oracle_sql(containment: float = CONTAINMENT) -> str:
    """DuckDB SQL for the rows of ``scan`` over ``documents``: every block against every template."""
    templates = ",\n  ".join(f"({k}, '{label}', {sorted(set(t.split(' ')))})" for k, (label, t) in enumerate(TEMPLATES))
    phrases = ",\n  ".join(f"('{label}', {p.split(' ')})" for p, label in PHRASES.items())
    words = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH t(k, label, own) AS (VALUES {templates}),
n AS (SELECT *, len(own) AS size, ceil({containment} * len(own) - 1e-9) AS need FROM t),
vocabulary AS (SELECT list_distinct(flatten(list(own))) AS v FROM t),
p(label, own) AS (VALUES {phrases}),
low AS (SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
d AS (SELECT rid, doc_id, low, {words.format('low')} AS w FROM low),
base AS (SELECT rid, label, i - 1 AS pos FROM (SELECT rid, w, label, own, unnest(found.i) AS i FROM (
    SELECT d.rid, d.w, p.label, p.own, {{'i': list_filter(range(1, len(w) + 1), lambda i: w[i] = own[1] AND w[i:i + len(own) - 1] = own)}} AS found
    FROM d, p WHERE list_has_all(d.w, p.own)) x) y),
b AS (SELECT rid, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list_sort(list_distinct(list(label))) AS base_list FROM base GROUP BY rid),
blocks AS (
  SELECT rid, 'line' AS kind, i AS place, list_distinct(list_intersect({words.format('line')}, v)) AS own
  FROM (SELECT rid, unnest(string_split(low, chr(10))) AS line, unnest(range(len(string_split(low, chr(10))))) AS i FROM d) x, vocabulary
  UNION ALL SELECT rid, 'window', i, list_distinct(list_intersect(w[i:i + {2 * STEP} - 1], v)) FROM (SELECT rid, w, unnest(range(1, len(w) + 1, {STEP})) AS i FROM d) x, vocabulary
),
m AS (SELECT rid, kind, place, k, label, size, list_intersect(blocks.own, n.own) AS common FROM blocks JOIN n ON len(list_intersect(blocks.own, n.own)) >= need WHERE len(blocks.own) > 0),
best AS (SELECT * FROM m x WHERE NOT EXISTS (SELECT 1 FROM m y WHERE y.rid = x.rid AND y.kind = x.kind AND y.place = x.place AND len(y.common) > len(x.common) AND list_has_all(y.common, x.common))),
f AS (SELECT rid, list_distinct(list(label)) AS labels FROM best GROUP BY rid),
s AS (SELECT rid, max(len(common) / size) AS share, count(DISTINCT place) FILTER (kind = 'line') AS n_lines, count(DISTINCT place) FILTER (kind = 'window') AS n_windows FROM m GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(array_to_string(base_list, ','), '') AS base_labels, array_to_string(list_sort(list_distinct(list_concat(coalesce(base_list, []), coalesce(f.labels, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score, CAST(CASE WHEN n_lines > 0 THEN n_lines ELSE coalesce(n_windows, 0) END AS INTEGER) AS n_blocks
FROM d LEFT JOIN b USING (rid) LEFT JOIN f USING (rid) LEFT JOIN s USING (rid)
"""


def op10_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and template matches of every document."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))

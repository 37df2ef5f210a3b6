"""License scans: fixed phrases, and an exact set-similarity join of text blocks with templates.

A block is a window of ``2 * stride`` words at every ``stride``-th word of the whole text, whatever its line
breaks, so a notice of at most ``stride`` words lies whole in one block.  There are two strides in ``STRIDES``: short
notices are looked for in short blocks, where few other words stand beside them, long ones in long blocks.  A block
matches a template if it holds at least ``THRESHOLD`` of the template's distinct words, and all of the words that
tell it from other licenses (``mit``, ``nc``).  Words are put in one
global order, rarest first (by the number of documents, counted over all of them), and then

* prefix: a matching block has one of the template's first ``n - needed + 1`` words, so only
  blocks with such a word are exploded and joined, on that word, with the templates' index;
* length: a block with fewer template words than needed can't match;
* positional: nor can one with too few words after the shared one, in either order;

and the candidates that are left are verified.  Templates are a short fixed table, so their
index is broadcast; blocks that pass are the only rows shuffled.

Defined results: a null text is an empty one, without words, places and labels, with score 0;
repeated rows are counted each; the score is the largest share of a template's words that a
block holds if that reaches the threshold, 1 for a phrase, else 0.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyframe.llm.stage import documents, staged

THRESHOLD = 0.8
STRIDES = (8, 48)

PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# Openings of public license notices, the label of each, and words that a block must hold.
TEMPLATES = (
    ("released under the mit license", "mit", "mit license"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        "mit", "permission granted charge restriction",
    ),
    ("licensed under the apache license version 2 0", "apache-2", "apache 2"),
    (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
        "the license you may obtain a copy of the license at",
        "apache-2", "apache file compliance",
    ),
    ("licensed under the gnu general public license version 3", "gpl-3", "gnu general 3"),
    (
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
        "free software foundation either version",
        "gpl", "redistribute gnu general foundation",
    ),
    ("released under the bsd license", "bsd", "bsd license"),
    (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
        "bsd", "redistribution binary forms permitted",
    ),
    (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
        "distributed with this file you can obtain one",
        "mpl", "mozilla mpl",
    ),
    ("licensed under cc by nc 4 0", "cc-by-nc", "cc nc"),
    (
        "this work is licensed under the creative commons attribution noncommercial 4 0 international license",
        "cc-by-nc", "creative commons noncommercial",
    ),
    (
        "this work is licensed under the creative commons attribution sharealike 4 0 international license",
        "cc-by-sa", "creative commons sharealike",
    ),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        "isc", "permission distribute fee appear",
    ),
    ("this is free and unencumbered software released into the public domain", "unlicense", "unencumbered domain"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_APART = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def normalised(text: Column) -> Column:
    """Words of a text, A-Z lowered, joined by single spaces."""
    return F.trim(F.regexp_replace(F.translate(text, _UPPER, _LOWER), _APART, " "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _words(text: Column) -> Column:
    return F.when(text == "", F.lit(0)).otherwise(_spaces(text) + 1).cast("long")


def phrase_places(words: Column, n_words: Column, phrase: str) -> Column:
    """Number, first and last place of a phrase in ``words``, a normalised text."""
    padded = F.concat(F.lit(" "), words, F.lit(" "))
    pieces = F.split(padded, f" {phrase}(?= )", -1)
    size = len(phrase.split())
    return F.when(
        F.contains(padded, F.lit(f" {phrase} ")),
        F.struct(
            (F.size(pieces) - 1).cast("long").alias("n"),
            _spaces(F.element_at(pieces, 1)).cast("long").alias("first"),
            (n_words - size - (_spaces(F.element_at(pieces, -1)) - 1)).cast("long").alias("last"),
        ),
    )


def _distinct(template: str) -> list[str]:
    return sorted(set(template.split()))


def scale_of(template: str) -> int:
    """The number of the shortest stride that the whole template fits in."""
    return next(k for k, stride in enumerate(STRIDES) if len(template.split()) <= stride)


def word_order(docs: DataFrame, text: str = "text") -> list[str]:
    """All words of the templates, those in the fewest documents first."""
    vocabulary = sorted({w for t, _, _ in TEMPLATES for w in t.split()})
    own = F.array_intersect(F.array(*[F.lit(w) for w in vocabulary]), F.split(normalised(F.col(text)), " "))
    found = docs.select(F.explode(own).alias("word")).groupBy("word").count().collect()
    counts = {r["word"]: r["count"] for r in found}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def template_index(spark: SparkSession, order: list[str], threshold: float) -> DataFrame:
    """A row for each prefix word of each template: its place, and what a match needs."""
    rank = {w: k for k, w in enumerate(order)}
    rows = []
    for number, (template, label, must) in enumerate(TEMPLATES):
        words = sorted(_distinct(template), key=rank.get)
        needed = ceil(threshold * len(words) - 1e-9)
        for place, word in enumerate(words[: len(words) - needed + 1]):
            rows.append((word, place, number, label, words, needed, scale_of(template), must.split()))
    schema = "word string, t_place int, template int, label string, t_words array<string>, needed int, scale int, must array<string>"
    return spark.createDataFrame(rows, schema)


def with_blocks(docs: DataFrame, keys: list[str], order: list[str], prefixes: list[str], text: str = "text") -> DataFrame:
    """``keys``, words, phrase places, and ``blocks``: scale and template words of each block with a prefix word, in global order."""
    vocabulary, first = F.array(*[F.lit(w) for w in order]), F.array(*[F.lit(w) for w in prefixes])
    c = F.col
    return (
        docs.select(*keys, F.coalesce(c(text), F.lit("")).alias("_text"))
        .withColumn("_words", normalised(c("_text")))
        .withColumn("n_words", _words(c("_words")))
        .withColumns({f"_p{k}": phrase_places(c("_words"), c("n_words"), p) for k, (p, _) in enumerate(PHRASES)})
        # Texts without any prefix word have no blocks.
        .withColumn("_list", F.when(F.arrays_overlap(F.split("_words", " "), first), F.split("_words", " ")).otherwise(F.array().cast("array<string>")))
        .withColumn("blocks", F.flatten(F.array(*[_blocks(c("_list"), k, vocabulary, first) for k in range(len(STRIDES))])))
        .drop("_text", "_words", "_list")
    )


def _blocks(words: Column, scale: int, vocabulary: Column, first: Column) -> Column:
    stride = STRIDES[scale]
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - stride - 1, F.lit(0)), F.lit(stride))
    windows = F.transform(starts, lambda at: F.slice(words, at + 1, F.lit(2 * stride)))
    # Most windows have no prefix word; only the others are put in order.
    near = F.filter(windows, lambda window: F.arrays_overlap(window, first))
    return F.transform(near, lambda window: F.struct(F.lit(scale).alias("scale"), F.array_intersect(vocabulary, window).alias("words")))


def matching_blocks(blocks: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """(key, label, share) of every block that holds enough of a template."""
    words = (
        blocks.select(key, F.posexplode("blocks").alias("block", "_b"))
        .select(key, "block", F.col("_b.scale").alias("scale"), F.col("_b.words").alias("b_words"))
        .select(key, "block", "scale", "b_words", F.posexplode("b_words").alias("b_place", "word"))
        .join(F.broadcast(index), ["word", "scale"])
    )
    after = F.least(F.size("t_words") - F.col("t_place"), F.size("b_words") - F.col("b_place"))
    candidates = words.where(
        (F.size("b_words") >= F.col("needed")) & (F.least("t_place", "b_place") + after >= F.col("needed"))
    )
    shared = F.size(F.array_intersect("b_words", "t_words"))
    # A block that shares several prefix words with a template is a candidate several times; one row is enough.
    first = F.element_at(F.array_intersect("b_words", F.slice("t_words", F.lit(1), F.size("t_words") - F.col("needed") + 1)), 1)
    return (
        candidates.where(F.col("word") == first)
        .withColumn("_shared", shared)
        .where((F.col("_shared") >= F.col("needed")) & (F.size(F.array_except("must", "b_words")) == 0))
        .select(key, "label", (F.col("_shared") / F.size("t_words")).alias("share"))
    )


def scan(docs: DataFrame, keys: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """``keys``, words, phrase places and labels of every document."""
    spark = docs.sparkSession
    order = word_order(docs)
    index = template_index(spark, order, threshold)
    prefixes = sorted({r["word"] for r in index.select("word").collect()}, key=order.index)
    rows = with_blocks(docs, keys, order, prefixes).withColumn("_row", F.monotonically_increasing_id())
    rows = staged(rows, "license-blocks")
    found = (
        matching_blocks(rows.where(F.size("blocks") > 0), index, "_row")
        .groupBy("_row")
        .agg(F.collect_set("label").alias("_labels"), F.max("share").alias("_share"))
    )
    places = F.filter(F.array(*[f"_p{k}" for k in range(len(PHRASES))]), lambda p: p.isNotNull())
    base = F.array_compact(
        F.array(*[F.when(F.col(f"_p{k}").isNotNull(), F.lit(label)) for k, (_, label) in enumerate(PHRASES)])
    )
    n_base = F.aggregate(places, F.lit(0).cast("long"), lambda n, p: n + p["n"])
    none = F.array().cast("array<string>")
    return rows.join(found, "_row", "left").select(
        *keys,
        "n_words",
        n_base.alias("n_base"),
        F.array_min(F.transform(places, lambda p: p["first"])).alias("first_word"),
        F.array_max(F.transform(places, lambda p: p["last"])).alias("last_word"),
        F.concat_ws(",", F.array_sort(F.array_distinct(base))).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_distinct(F.concat(base, F.coalesce("_labels", none))))).alias("labels"),
        F.when(F.size(base) > 0, F.lit(1.0)).otherwise(F.coalesce("_share", F.lit(0.0))).alias("score"),
    )


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and license labels of every document."""
    return scan(documents(spark, sf_dir).select("doc_id", "text"), ["doc_id"])


_SQL_WORDS = "trim(regexp_replace(translate({}, '" + _UPPER + "', '" + _LOWER + "'), '" + _APART + "', ' ', 'g'))"
_SQL_TEMPLATES = ", ".join(
    f"({k}, '{label}', {len(_distinct(t))}, {ceil(THRESHOLD * len(_distinct(t)) - 1e-9)}, {STRIDES[scale_of(t)]}, {_distinct(t)!r}, {must.split()!r})"
    for k, (t, label, must) in enumerate(TEMPLATES)
)
_SQL_PHRASES = ", ".join(f"('{p}', {len(p.split())}, '{label}')" for p, label in PHRASES)

OP4_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
    ' ' || {_SQL_WORDS.format("coalesce(text, '')")} || ' ' AS padded FROM documents),
counted AS (
  SELECT row, doc_id, text, padded,
    CASE WHEN padded = '  ' THEN 0 ELSE length(padded) - length(replace(padded, ' ', '')) - 1 END AS n_words FROM docs),
phrases(phrase, size, label) AS (VALUES {_SQL_PHRASES}),
-- Each space is doubled, so that neighbouring places share none.
places AS (
  SELECT row, label, size, n_words, string_split(replace(padded, ' ', '  '), ' ' || replace(phrase, ' ', '  ') || ' ') AS pieces
  FROM counted, phrases WHERE contains(padded, ' ' || phrase || ' ')),
base AS (
  SELECT row, sum(len(pieces) - 1) AS n_base,
    min((length(pieces[1]) - length(replace(pieces[1], ' ', '')) - 1) // 2) AS first_word,
    max(n_words - size - (length(pieces[-1]) - length(replace(pieces[-1], ' ', '')) - 1) // 2) AS last_word,
    list(label) AS labels
  FROM places GROUP BY row),
templates(id, label, size, needed, stride, words, must) AS (VALUES {_SQL_TEMPLATES}),
wanted AS (SELECT id, stride, word, list_contains(must, word) AS must FROM (SELECT *, unnest(words) AS word FROM templates)),
-- Every word counts for the two blocks of each stride that reach over it; nothing is cut into windows.
placed AS (
  SELECT row, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS place
  FROM (SELECT row, string_split(trim(padded), ' ') AS words FROM counted)),
met AS (SELECT row, id, word, must, place // stride AS block FROM placed JOIN wanted USING (word)),
reached AS (SELECT * FROM met UNION ALL SELECT row, id, word, must, block - 1 FROM met WHERE block > 0),
shared AS (
  SELECT row, id, block, count(DISTINCT word) AS n, count(DISTINCT word) FILTER (must) AS n_must FROM reached GROUP BY row, id, block),
found AS (
  SELECT row, list(label) AS labels, max(n / size) AS share FROM shared JOIN templates USING (id)
  WHERE n >= needed AND n_must = len(must) GROUP BY row)
SELECT doc_id, n_words::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(list_distinct(b.labels)), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(b.labels, f.labels))), ','), '') AS labels,
  CASE WHEN b.labels IS NOT NULL THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
FROM counted LEFT JOIN base b USING (row) LEFT JOIN found f USING (row)
"""

"""License scan by diagonal voting, in DataFrame operations only.

Templates are word sequences with a label: short phrases, which count where all
their words stand consecutively, and notices, which may be quoted with small
changes. Every run of `GRAM` words of every document is joined, by hash and then
word for word, to the places of the same run in the templates. A hit at word p of
a document and word t of a template votes for diagonal p - t. A phrase stands
where its diagonal has all votes. For notices, neighbouring diagonals (at most
`GAP` words apart, by an insertion or a deletion) whose votes cover different parts
of the template are merged into a span, and a span is verified: at least `SHARE` of
the template's words and of the span's words are matched. Of notices whose spans
overlap, the one with the most matched words names the place, so a variant does
not name its sibling as well. The score is the largest matched share of a
template, 1 for a phrase, 0 where nothing is found.

Documents are read once. A row for each document and its hits are written to the
shared folder; all later steps work on the hits, which are few, grouped by
document, template and diagonal. The templates are a parameter of bounded size
and are broadcast.

Defined cases: a null text is empty; a document without words or hits has a row
with zeros, empty labels and null places; rows with equal doc_id and text are one
document and give one row, rows that share a doc_id with different texts (compared by
64-bit hash and length) give a row each; rows without doc_id are answered like others; empty tables give no rows; other
columns are ignored. Templates of fewer words than a gram are refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import lowered, written

GRAM = 2  # words of a gram: the shortest phrase
GAP = 3  # words between neighbouring diagonals
SHARE = 80  # per cent of a notice's and of a span's words
PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases and their labels.
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]

# Opening sentences of public licenses and the usual one-line notices.
NOTICES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nd", "licensed under cc by nd 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain"),
]

KEY = ["doc_id", "digest", "n_words"]


def _numbered(phrases: Sequence[tuple[str, str]], notices: Sequence[tuple[str, str]]) -> list[tuple[int, str, bool, list[str]]]:
    """Templates (number, label, whether a phrase, words)."""
    both = [(label, True, text.split()) for label, text in phrases] + [(label, False, text.split()) for label, text in notices]
    if any(len(words) < GRAM for _, _, words in both):
        raise ValueError(f"a template needs {GRAM} words")
    return [(k, *t) for k, t in enumerate(both)]


def _template_grams(spark: SparkSession, templates: list[tuple[int, str, bool, list[str]]]) -> DataFrame:
    """One row for each gram of each template: gram hash, its words, template, place."""
    schema = ", ".join(f"g{i} string" for i in range(GRAM)) + ", template int, place int"
    rows = [(*words[at : at + GRAM], k, at) for k, _, _, words in templates for at in range(len(words) - GRAM + 1)]
    return spark.createDataFrame(rows, schema).withColumn("gram", F.xxhash64(*[f"g{i}" for i in range(GRAM)]))


def hits(docs: DataFrame, templates: list[tuple[int, str, bool, list[str]]]) -> DataFrame:
    """One row for each document (template null) and one for each gram that it shares with a template."""
    text = F.coalesce("text", F.lit(""))
    words = F.concat(F.array(F.lit(None).cast("string")), F.regexp_extract_all(lowered(text), F.lit(f"({PATTERN})"), F.lit(1)))
    read = docs.select("doc_id", F.xxhash64(text, F.char_length(text)).alias("digest"), words.alias("words"))
    grams = F.arrays_zip(*[F.slice("words", i + 1, F.greatest(F.size("words") - i, F.lit(0))).alias(f"w{i}") for i in range(GRAM)])
    # Element 0 is the document itself, element p + 1 the gram that starts at word p.
    each = read.select("doc_id", "digest", (F.size("words") - 1).cast("long").alias("n_words"), F.posexplode(grams).alias("at", "w"))
    whole = F.col("w.w0").isNotNull() & F.col(f"w.w{GRAM - 1}").isNotNull()
    each = each.withColumn("gram", F.when(whole, F.xxhash64(*[F.col(f"w.w{i}") for i in range(GRAM)])))
    found = each.join(F.broadcast(_template_grams(docs.sparkSession, templates)), "gram", "left")
    same = F.col("template").isNotNull()
    for i in range(GRAM):
        same = same & (F.col(f"w.w{i}") == F.col(f"g{i}"))
    return found.where((F.col("at") == 0) | same).select(*KEY, (F.col("at") - 1).cast("long").alias("word"), "template", "place")


def spans(votes: DataFrame, templates: DataFrame) -> DataFrame:
    """Verified places of notices (KEY, label, share), from votes (KEY, word, template, place)."""
    per = votes.groupBy(*KEY, "template", (F.col("word") - F.col("place")).alias("diagonal")).agg(
        F.min("place").alias("low"), F.max("place").alias("high"),
        F.flatten(F.collect_list(F.sequence(F.col("place"), F.col("place") + GRAM - 1))).alias("covered"),
    )
    along = Window.partitionBy(*KEY, "template").orderBy("diagonal")
    apart = (F.col("low") > F.lag("high").over(along)) | (F.col("high") < F.lag("low").over(along))
    joins = (F.col("diagonal") - F.lag("diagonal").over(along) <= GAP) & apart
    chained = per.withColumn("begins", F.when(joins, 0).otherwise(1)).withColumn("chain", F.sum("begins").over(along))
    merged = chained.groupBy(*KEY, "template", "chain").agg(
        F.min(F.col("diagonal") + F.col("low")).alias("first"), F.max(F.col("diagonal") + F.col("high") + GRAM - 1).alias("last"),
        F.size(F.array_distinct(F.flatten(F.collect_list("covered")))).alias("matched"),
    )
    enough = (F.col("matched") * 100 >= F.col("size") * SHARE) & (F.col("matched") * 100 >= (F.col("last") - F.col("first") + 1) * SHARE)
    verified = merged.join(F.broadcast(templates), "template").where(enough).withColumn("share", F.col("matched") / F.col("size"))
    by_place = Window.partitionBy(*KEY).orderBy("first", "last")
    reached = F.max("last").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    placed = verified.withColumn("begins", F.when(F.col("first") <= reached, 0).otherwise(1)).withColumn("spot", F.sum("begins").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
    weight = F.struct("matched", "share")
    best = placed.withColumn("best", F.max(weight).over(Window.partitionBy(*KEY, "spot")))
    return best.where(F.col("best") == weight).select(*KEY, "label", "share")


def scanned(docs: DataFrame, phrases: Sequence[tuple[str, str]] = PHRASES, notices: Sequence[tuple[str, str]] = NOTICES) -> DataFrame:
    """docs (doc_id, text) with n_words, n_base, first_word, last_word, base_labels, labels and score."""
    templates = _numbered(phrases, notices)
    facts = docs.sparkSession.createDataFrame(
        [(k, label, phrase, len(words)) for k, label, phrase, words in templates], "template int, label string, phrase boolean, size int"
    )
    found = written(hits(docs, templates), "license-hits")
    votes = found.where("template is not null").distinct().join(F.broadcast(facts.select("template", "phrase")), "template")

    diagonal = F.col("word") - F.col("place")
    full = votes.where("phrase").groupBy(*KEY, "template", diagonal.alias("start")).agg(F.count("*").alias("n"))
    places = full.join(F.broadcast(facts), "template").where(F.col("n") == F.col("size") - GRAM + 1)
    base = places.select(*KEY, "label", F.lit(1.0).alias("share"), "start")
    notice = spans(votes.where(~F.col("phrase")), facts).withColumn("start", F.lit(None).cast("long"))
    plain = found.where("template is null").select(*KEY, F.lit(None).cast("string").alias("label"), F.lit(0.0).alias("share"), F.lit(None).cast("long").alias("start"))

    def named(label: Column) -> Column:
        return F.array_join(F.sort_array(F.collect_set(label)), ",")

    return plain.unionByName(base).unionByName(notice).groupBy(*KEY).agg(
        F.count("start").alias("n_base"), F.min("start").alias("first_word"), F.max("start").alias("last_word"),
        named(F.when(F.col("start").isNotNull(), F.col("label"))).alias("base_labels"), named(F.col("label")).alias("labels"), F.max("share").alias("score"),
    ).drop("digest")


def _values() -> str:
    rows = [f"({k}, '{label}', {phrase}, {len(words)}, {list(words)!r})" for k, label, phrase, words in _numbered(PHRASES, NOTICES)]
    return ", ".join(rows)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SQL = rf"""
WITH templates(template, label, phrase, size, w) AS (VALUES {_values()}),
grams AS (
  SELECT template, label, phrase, size, place, w[place + 1] AS a, w[place + 2] AS b FROM (SELECT *, unnest(range(0, size - 1)) AS place FROM templates)
), docs AS (
  SELECT doc_id, text, regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '{PATTERN}') AS w
  FROM (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents)
), pairs AS (
  SELECT doc_id, text, word, w[word + 1] AS a, w[word + 2] AS b FROM (SELECT *, unnest(range(0, len(w) - 1)) AS word FROM docs)
), votes AS (
  SELECT doc_id, text, template, label, phrase, size, place, word, word - place AS diagonal FROM pairs JOIN grams USING (a, b)
), base AS (
  SELECT doc_id, text, label, 1.0::DOUBLE AS share, diagonal AS start FROM votes WHERE phrase GROUP BY doc_id, text, template, label, size, diagonal HAVING count(*) = size - 1
), diagonals AS (
  SELECT doc_id, text, template, label, size, diagonal, min(place) AS low, max(place) AS high, flatten(list([place, place + 1])) AS covered
  FROM votes WHERE NOT phrase GROUP BY ALL
), linked AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER along <= {GAP} AND (low > lag(high) OVER along OR high < lag(low) OVER along) THEN 0 ELSE 1 END AS begins
  FROM diagonals WINDOW along AS (PARTITION BY doc_id, text, template ORDER BY diagonal)
), chained AS (
  SELECT *, sum(begins) OVER (PARTITION BY doc_id, text, template ORDER BY diagonal) AS chain FROM linked
), merged AS (
  SELECT doc_id, text, template, label, size, min(diagonal + low) AS first, max(diagonal + high + 1) AS last, len(list_distinct(flatten(list(covered)))) AS matched
  FROM chained GROUP BY doc_id, text, template, label, size, chain
), verified AS (
  SELECT *, matched / size AS share FROM merged WHERE matched * 100 >= size * {SHARE} AND matched * 100 >= (last - first + 1) * {SHARE}
), started AS (
  SELECT *, CASE WHEN first <= max(last) OVER (PARTITION BY doc_id, text ORDER BY first, last ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens FROM verified
), placed AS (
  SELECT *, sum(opens) OVER (PARTITION BY doc_id, text ORDER BY first, last ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS spot FROM started
), notices AS (
  SELECT * FROM placed QUALIFY matched = max(matched) OVER (PARTITION BY doc_id, text, spot) AND share = max(share) OVER (PARTITION BY doc_id, text, spot, matched)
), found AS (
  SELECT doc_id, text, NULL AS label, 0.0::DOUBLE AS share, NULL AS start FROM docs
  UNION ALL SELECT * FROM base UNION ALL SELECT doc_id, text, label, share, NULL FROM notices
), scores AS (
  SELECT doc_id, text, count(start) AS n_base, min(start) AS first_word, max(start) AS last_word,
    coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE start IS NOT NULL))), ','), '') AS base_labels,
    coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE label IS NOT NULL))), ','), '') AS labels, max(share) AS score
  FROM found GROUP BY doc_id, text
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word, base_labels, labels, score
FROM scores s JOIN docs d ON s.text = d.text AND s.doc_id IS NOT DISTINCT FROM d.doc_id
"""

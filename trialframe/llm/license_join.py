"""License scans: an exact containment join of text blocks with license templates.

DataFrame expressions only.  A block is a window of consecutive words, line breaks or not,
a quarter longer than the template's wording.  It matches when it holds at least
``threshold`` of the template's distinct words.  The join:

1. Words that stand in no template cannot add to an overlap, so a document keeps the
   places of its words from the templates' vocabulary.
2. These words are counted over all documents; each template's words are put in the
   global order, rarest first.
3. Prefix filter: a template that needs ``c`` of its ``t`` words is indexed under its
   ``t - c + 1`` rarest; any block that matches holds one of them, so only the places of
   these words probe the index, each with the vocabulary words near it.
4. Positional filter: a block is looked for at the rarest template word that it holds,
   so only the template's words from there on in the order count.
5. Length filter: enough different ones must stand near the place.
6. The remaining pairs are verified window by window.

The index has a row for each prefix word of each template, so its size is bounded
by the template list, a parameter; it is broadcast up to ``BROADCAST_ROWS`` rows
and joined by shuffle beyond.  A probe carries the words of two windows at most.

Exact phrases (words standing consecutively) are found besides, from the same places.

Defined cases: null text = empty text: no words, no labels, score 0; repeated rows
each get their result; a null ``doc_id`` is kept; empty tables give empty results;
other columns are ignored.  Only A-Z are lower-cased, so a sign that merely
lower-cases to a letter (the Kelvin sign) stays different.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialframe.llm.common import id_text, shared_table

THRESHOLD = 0.9
BROADCAST_ROWS = 20_000

# Fixed values: (label, wording) of common license notices.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("reserved", "All rights reserved"),
)
# Phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The signs outside A-Z whose small form holds an ASCII letter.
KELVIN, DOTTED = "\u212a", "\u0130"


def low(text: Column) -> Column:
    """``text`` with A-Z lower-cased; other letters may change too, but never from or to ASCII."""
    return F.when(text.contains(KELVIN) | text.contains(DOTTED), F.translate(text, CAPITALS, SMALL)).otherwise(F.lower(text))


def template_words(wording: str) -> list[str]:
    import re

    return list(dict.fromkeys(re.findall(r"[0-9a-z]+", wording.lower())))


def span_of(wording: str) -> int:
    """Words in a block of a template: its wording and a quarter more."""
    import re

    n = len(re.findall(r"[0-9a-z]+", wording.lower()))
    return n + n // 4


def numbers(size: Column) -> Column:
    """0 to ``size - 1``."""
    return F.when(size > 0, F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def word_places(docs: DataFrame, vocabulary: list[str], phrases=PHRASES) -> DataFrame:
    """(doc_id, h, n_words, places, hits): ``h`` is the text's hash, ``places`` array<struct<at,label>> has every place where
    a phrase's words stand consecutively, ``hits`` array<struct<at,w>> the vocabulary's words, both by place."""
    phrases = [(p.split(), label) for p, label in phrases]
    known = sorted({*vocabulary, *(p[0] for p, _ in phrases)})
    rows = id_text(docs).select("doc_id", F.xxhash64("text").alias("h"),
                                F.regexp_extract_all(low(F.col("text")), F.lit(WORD), 1).alias("words"))
    word = lambda i: F.get(F.col("words"), i)       # noqa: E731
    rows = rows.select("doc_id", "h", "words", F.filter(numbers(F.size("words")), lambda i: word(i).isin(known)).alias("known"))

    def places(words: list[str], label: str) -> Column:
        def stands(i: Column) -> Column:
            test = word(i) == words[0]
            for k, w in enumerate(words[1:], 1):
                test &= F.coalesce(word(i + k) == w, F.lit(False))
            return test
        return F.transform(F.filter("known", stands), lambda i: F.struct(i.cast("long").alias("at"), F.lit(label).alias("label")))

    return rows.select("doc_id", "h", F.size("words").cast("long").alias("n_words"),
                       F.concat(*[places(p, label) for p, label in phrases]).alias("places"),
                       F.transform("known", lambda i: F.struct(i.alias("at"), word(i).alias("w"))).alias("hits"))


def scan_places(places: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, h, at, template, label, containment) of blocks that meet the threshold, from a table of ``word_places``.

    A row for each place of a rare template word that a matching block holds as its rarest: the best block
    there (the first of equals); ``at`` is the number of its first template word.
    """
    spark = places.sparkSession
    sets = [(i, label, template_words(wording), span_of(wording)) for i, (label, wording) in enumerate(templates)]
    vocabulary = sorted({w for _, _, words, _ in sets for w in words})
    # one row for each word of the templates at most
    counts = {r["word"]: r["n"] for r in
              places.select(F.explode(F.array_distinct("hits.w")).alias("word")).where(F.col("word").isin(vocabulary))
              .groupBy("word").agg(F.count("*").alias("n")).collect()}
    index = []
    for template, label, words, span in sets:
        need = ceil(threshold * len(words) - 1e-9)
        order = sorted(words, key=lambda w: (counts.get(w, 0), w))
        index += [(order[at], template, label, order[at:], len(words), need, span) for at in range(len(order) - need + 1)]
    index_rows = spark.createDataFrame(
        index, "word string, template int, label string, t_words array<string>, t_size int, need int, span int")
    if len(index) <= BROADCAST_ROWS:
        index_rows = F.broadcast(index_rows)

    probing, reach = sorted({row[0] for row in index}), max((s for *_, s in sets), default=1)
    hit = lambda i: F.get(F.col("hits"), i)         # noqa: E731
    probe = lambda i: F.struct(hit(i)["at"].alias("at"), hit(i)["w"].alias("word"),     # noqa: E731
                               F.slice("hits", F.greatest(i - reach + 2, F.lit(1)), 2 * reach - 1).alias("near"))
    probes = places.select("doc_id", "h", F.explode(F.transform(
        F.filter(numbers(F.size("hits")), lambda i: hit(i)["w"].isin(probing)), probe)).alias("p")).select("doc_id", "h", "p.*")
    own = F.filter("near", lambda x: (F.abs(x["at"] - F.col("at")) < F.col("span")) & F.array_contains("t_words", x["w"]))
    met = (probes.join(index_rows, "word").withColumn("own", own)
           .where(F.size(F.array_distinct("own.w")) >= F.col("need")))

    def block(start: Column) -> Column:
        held = F.filter("own", lambda x: (x["at"] >= start) & (x["at"] < start + F.col("span")))
        return F.struct(F.size(F.array_distinct(F.transform(held, lambda x: x["w"]))).alias("overlap"), (-start).alias("first"))

    starts = F.filter("own.at", lambda s: (s <= F.col("at")) & (s + F.col("span") > F.col("at")))
    best = F.array_max(F.transform(starts, block))
    return (met.withColumn("best", best).where(F.col("best.overlap") >= F.col("need"))
            .select("doc_id", "h", (-F.col("best.first")).alias("at"), "template", "label",
                    (F.col("best.overlap") / F.col("t_size")).alias("containment")))


def vocabulary_of(templates) -> list[str]:
    return sorted({w for _, wording in templates for w in template_words(wording)})


def scan_blocks(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``scan_places`` of documents."""
    return scan_places(shared_table(word_places(docs, vocabulary_of(templates), ()), "license-words"), templates, threshold)


def scan_documents(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: n_words, n_base, first_word, last_word, base_labels, labels, score, n_blocks.

    ``score`` is the largest containment found, 1 where a phrase stands; ``n_blocks`` counts the starts of matching blocks.
    """
    places = shared_table(word_places(docs, vocabulary_of(templates), phrases), "license-words")
    found = (scan_places(places, templates, threshold).groupBy("doc_id", "h")
             .agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"),
                  F.count_distinct("at").alias("n_blocks")))           # at most one label a template
    base = places.select(
        "doc_id", "h", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.at").alias("first_word"), F.array_max("places.at").alias("last_word"),
        F.array_sort(F.array_distinct("places.label")).alias("base"))
    found = found.withColumnsRenamed({"doc_id": "f_id", "h": "f_h"})
    both = base.join(found, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("h") == F.col("f_h")), "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    return both.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                       F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
                       F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
                       F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"))

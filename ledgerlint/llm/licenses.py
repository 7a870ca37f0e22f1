"""Licence scan with a positional rare-token index.

The index holds the words of short licence templates with their positions, and
each word's inverse document frequency over the whole corpus.  For every text
its rarest licence words are looked up; their postings are intersected by
relative position (position in the text less position in the template), so
words that stand to each other as in the template add up.  A template whose
aligned words carry at least ``MIN_SCORE`` of its weight is a candidate, and is
reported if the text also has its mandatory key phrase word for word.  A
template whose key phrase is in the text is scored over all its own words too,
each with a weight of at least ``LEAST_IDF``: other licences in the same text,
or a notice that most files have, cannot hide it.  The greater score counts.

Besides, four fixed phrases are found exactly (the *base*).

Every text is read once.  One projection takes from it, without a shuffle, the
licence words it has, which key phrases stand in it, the counts of the base, and,
only where a key phrase stands (nothing else can be verified), the places of its
licence words; this narrow table is stored.  Frequencies, look-up and
intersection work on it.  The templates, hence the index and all that is
broadcast, are of fixed size.  All steps are DataFrame functions.

Words are runs of ASCII letters and digits and of non-ASCII characters,
lower-cased.  Defined cases: a null text is empty; a text without words has
counts 0, null positions, no labels and score 0; rows that share id and text
have equal results; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlint.llm.common import text_bytes, written

# The phrases of the base and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Label, opening words of the licence or of its notice, and the phrase it must have.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "permission is hereby granted free of charge"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at", "you may not use this file except in compliance with the license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "terms of the gnu general public license"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", "gnu lesser general public license"),
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "waived all copyright and related or neighboring rights"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
)
#: All words of the templates.
WORDS = sorted({w for _, text, _ in TEMPLATES for w in text.split()})
RAREST = 24  # words of a text that are looked up
MIN_IDF = 0.7  # a word that half of all texts have tells nothing in the first look-up
LEAST_IDF = 0.1  # weight that any word of a template keeps where its key phrase stands
MIN_SCORE = 0.6
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normalised(text: Column) -> Column:
    """The words of a text, joined by one space."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")  # A-Z alone
    return F.trim(F.regexp_replace(lower, _SEPARATORS, " "))


def _word_count(body: Column) -> Column:
    return F.when(body == "", 0).otherwise(F.length(body) - F.length(F.replace(body, F.lit(" "), F.lit(""))) + 1).cast("long")


def _phrase(body: Column, phrase: str) -> tuple[Column, Column, Column]:
    """Number of places of a phrase, and the first and last of them as word positions (null if none)."""
    padded = F.concat(F.lit(" "), body, F.lit(" "))
    has = padded.contains(f" {phrase} ")
    parts = F.split(padded, f"(?<= ){phrase}(?= )", -1)
    spaces = lambda c: (F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))).cast("long")
    first = spaces(F.element_at(parts, 1)) - 1
    last = _word_count(body) - (spaces(F.element_at(parts, -1)) - 1) - len(phrase.split())
    return F.when(has, F.size(parts) - 1).otherwise(0).cast("long"), F.when(has, first), F.when(has, last)


def _read(docs: DataFrame, id: str, text: str) -> DataFrame:
    """One row per document, without its text: doc_id, tie, the base's counts, base, has, keys, placed.

    ``has`` are the licence words of the text, ``keys`` the templates whose key phrase is in it, and
    ``placed`` the places (pos, word) of its licence words, null if there is no key phrase.
    """
    rows = docs.select(docs[id].alias("doc_id"), F.xxhash64(text_bytes(docs[text])).alias("tie"), normalised(docs[text]).alias("body"))
    body, split = F.col("body"), F.split("body", " ")
    found = [_phrase(body, p) for p, _ in BASE]
    padded = F.concat(F.lit(" "), body, F.lit(" "))
    keys = F.array_compact(F.array(*[F.when(padded.contains(f" {key} "), t) for t, (_, _, key) in enumerate(TEMPLATES)]))
    vocabulary = F.array(*[F.lit(w) for w in WORDS])
    places = F.filter(F.transform(split, lambda w, i: F.struct(i.alias("pos"), w.alias("word"))), lambda x: F.array_contains(vocabulary, x["word"]))
    one = rows.select(
        "doc_id",
        "tie",
        _word_count(body).alias("n_words"),
        sum((f[0] for f in found[1:]), found[0][0]).alias("n_base"),
        F.least(*[f[1] for f in found]).alias("first_word"),
        F.greatest(*[f[2] for f in found]).alias("last_word"),
        F.array_sort(F.array_compact(F.array(*[F.when(f[0] > 0, label) for f, (_, label) in zip(found, BASE)]))).alias("base"),
        F.array_intersect(split, vocabulary).alias("has"),
        keys.alias("keys"),
        "body",
    )
    return one.withColumn("placed", F.when(F.size("keys") > 0, places)).drop("body")


def _aligned(texts: DataFrame) -> DataFrame:
    """(doc_id, tie, template, score) of the templates that a text's words place and its key phrases verify. ``texts``: as :func:`_read` gives them."""
    spark = texts.sparkSession
    df = {r["word"]: r["df"] for r in texts.select(F.explode("has").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df")).collect()}  # one row a word of the templates
    n = texts.count()
    idf = {w: math.log((n + 1) / (df.get(w, 0) + 1)) for w in WORDS}
    rarest = sorted((w for w in WORDS if idf[w] >= MIN_IDF), key=lambda w: (-idf[w], w))
    # The index: a word's postings weigh idf among the words looked up first, and a floored idf among all words of a template.
    postings, rare_weight, weight = [], [1e-9] * len(TEMPLATES), [0.0] * len(TEMPLATES)
    for t, (_, text, _) in enumerate(TEMPLATES):
        own = text.split()
        kept = set([w for w in rarest if w in own][:RAREST])
        for at, w in enumerate(own):
            postings.append((w, t, at, idf[w] if w in kept else 0.0, max(idf[w], LEAST_IDF)))
            rare_weight[t] += postings[-1][3]
            weight[t] += postings[-1][4]
    lookup = F.broadcast(spark.createDataFrame(postings, "word string, template int, at int, rare double, every double"))
    own = texts.filter("placed is not null").dropDuplicates(["doc_id", "tie"])
    first = F.slice(F.array_intersect(F.array(*[F.lit(w) for w in rarest]).cast("array<string>"), F.col("has")), 1, RAREST)
    hits = own.select("doc_id", "tie", "keys", first.alias("first"), F.explode("placed").alias("x")).select("*", "x.pos", "x.word").join(lookup, "word")
    hits = hits.filter(F.array_contains("keys", F.col("template")))
    # At one offset a posting is met at one place at most, so sums count no word twice.
    offsets = hits.groupBy("doc_id", "tie", "template", (F.col("pos") - F.col("at")).alias("offset")).agg(
        F.sum(F.when(F.array_contains("first", F.col("word")), F.col("rare")).otherwise(0.0)).alias("rare"), F.sum("every").alias("every")
    )
    full = lambda weights: F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("template") + 1)
    score = F.least(F.greatest(F.col("rare") / full(rare_weight), F.col("every") / full(weight)), F.lit(1.0))
    return offsets.groupBy("doc_id", "tie", "template").agg(F.max(score).alias("score")).filter(F.col("score") >= MIN_SCORE)


def scanned(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    texts = written(_read(docs, id, text), "license-words")
    verified = _aligned(texts).groupBy("doc_id", "tie").agg(F.collect_list(F.struct("template", "score")).alias("verified"))
    verified = verified.select(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"), "verified")
    joined = texts.drop("has", "keys", "placed").join(verified, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie")), "left")
    joined = joined.withColumn("verified", F.coalesce("verified", F.array().cast("array<struct<template:int,score:double>>")))
    names = F.array(*[F.lit(t[0]) for t in TEMPLATES])
    labels = F.array_sort(F.array_distinct(F.concat("base", F.transform("verified", lambda c: F.element_at(names, c["template"] + 1)))))
    score = F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("verified", lambda c: c["score"])), F.lit(0.0)))
    return joined.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"))

"""Licence scans with a positional index of rare licence words. Built-in functions only.

Every text is read as words; of each text only its licence words (those of the templates
and base phrases) are kept, with their places. A word's rarity is its inverse document
frequency over the whole table. Each template is posted under its ``RARE_WORDS`` rarest words, and every place
where one of them stands in a text looks up the postings; those that agree on the relative position of text and
template are counted. A template is found if enough of its own posted words line up at one relative position and all of
its key phrases stand in the text word by word: how many are needed depends on the template alone, so
neither other licences in a text nor a long text around one take a label away. Base phrases are reported wherever their words stand in a row.

The postings and frequencies are tables over the fixed vocabulary below, so broadcasting
them is bounded by this file. Nothing but licence words of candidate texts is shuffled.

Defined results: texts of any length are read whole; a null text is empty; texts without licence words have no labels and
score 0; repeated rows each get their row; columns other than ``doc_id`` and ``text`` are
ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.shared import id_and_text, settled

# Word pattern (upper case included, as texts are not lower-cased first) and base phrases.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Licence texts as published, with the phrases that must stand in a text: (label, words, key phrases).
TEMPLATES = [
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "licensed under the mit license", ["mit license"]),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        ["permission is hereby granted free of charge"],
    ),
    ("apache-2.0", "licensed under the apache license version 2 0 the license", ["apache license"]),
    ("apache-2.0", "released under the apache license", ["apache license"]),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        ["source and binary forms"],
    ),
    ("bsd", "released under the bsd license", ["bsd license"]),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
        ["general public license"],
    ),
    ("lgpl", "under the terms of the gnu lesser general public license", ["lesser general public license"]),
    ("agpl", "under the terms of the gnu affero general public license", ["affero general public license"]),
    (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ["mozilla public license"],
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted",
        ["permission to use copy modify"],
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ["unencumbered software", "public domain"],
    ),
    ("cc0", "to the extent possible under law the author has waived all copyright", ["waived all copyright"]),
    (
        "cc",
        "this work is licensed under a creative commons attribution international license",
        ["creative commons"],
    ),
    ("proprietary", "this software is confidential and proprietary information", ["confidential and proprietary"]),
]
#: Too common in any English text to be looked up; they still count where a phrase is verified.
COMMON = frozenset("a and any are as by can for in is it of or that the this to with you".split())
RARE_WORDS = 8
#: Share of the rare words of a template that must line up.
MIN_ALIGNED = 0.5

VOCABULARY = sorted({w for _, text, _ in TEMPLATES for w in text.split()} | {w for phrase in BASE for w in phrase.split()})


def licence_words(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_words and ``found``: the licence words of each text in order, with their places."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    known = ", ".join(f"'{w}'" for w in VOCABULARY)
    # lower() folds a few letters beyond A-Z onto ASCII; such words are no licence words
    found = F.expr(
        f"""transform(
            filter(sequence(0, size(words) - 1), i -> size(words) > 0
                and lower(words[i]) in ({known}) and length(words[i]) = octet_length(words[i])),
            i -> named_struct('at', cast(i as bigint), 'word', lower(words[i])))"""
    )
    found = F.when(F.size("words") > 0, found).otherwise(F.array().cast("array<struct<at:bigint,word:string>>"))
    return (
        id_and_text(docs)
        .select("doc_id", F.xxhash64("text").alias("text_key"), words.alias("words"))
        .select("doc_id", "text_key", F.size("words").cast("bigint").alias("n_words"), found.alias("found"))
    )


def places(phrase: str) -> Column:
    """Where the words of a phrase stand in a row: their first words' places."""
    words = phrase.split()
    in_row = " and ".join(
        f"found[i + {k}].word = '{w}' and found[i + {k}].at = found[i].at + {k}" for k, w in enumerate(words)
    )
    last = f"size(found) - {len(words)}"
    return F.expr(
        f"""case when {last} >= 0 then transform(filter(sequence(0, {last}), i -> {in_row}), i -> found[i].at)
            else cast(array() as array<bigint>) end"""
    )


def postings(df: DataFrame, frequency: dict[str, int]) -> DataFrame:
    """Each template's rarest words with their places, and how many of them are looked up."""
    rows = []
    for number, (label, text, _) in enumerate(TEMPLATES):
        words = text.split()
        rarest = sorted(set(words) - COMMON, key=lambda w: (frequency.get(w, 0), w))[:RARE_WORDS]
        rows += [(number, label, at, word, len(rarest)) for at, word in enumerate(words) if word in rarest]
    return df.sparkSession.createDataFrame(rows, "template int, label string, template_at bigint, word string, needed int")


def document_frequency(words: DataFrame) -> DataFrame:
    """In how many texts each licence word stands."""
    return (
        words.select(F.explode(F.array_distinct(F.expr("transform(found, f -> f.word)"))).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("texts"))
    )


def aligned(words: DataFrame) -> DataFrame:
    """Templates of each text with the largest share of rare words at one relative position."""
    frequency = {row.word: row.texts for row in document_frequency(words).collect()}  # fixed vocabulary
    index = postings(words, frequency)
    posted = ", ".join(f"'{w}'" for w in VOCABULARY if w not in COMMON)
    keys = ["doc_id", "text_key"]
    occurrences = (
        words.filter(F.size("found") > 1)
        .select(*keys, F.explode(F.expr(f"filter(found, f -> f.word in ({posted}))")).alias("f"))
        .select(*keys, F.col("f.at").alias("at"), F.col("f.word").alias("word"))
    )
    return (
        occurrences.join(F.broadcast(index), "word")
        .groupBy(*keys, "template", "label", "needed", (F.col("at") - F.col("template_at")).alias("shift"))
        .agg(F.countDistinct("template_at").alias("in_line"))
        .withColumn("share", F.least(F.lit(1.0), F.col("in_line") / F.col("needed")))
        .filter((F.col("in_line") >= F.least(F.lit(2), F.col("needed"))) & (F.col("share") >= MIN_ALIGNED))
        .groupBy(*keys)
        .agg(F.collect_set(F.struct("template", "label")).alias("candidates"), F.max("share").alias("share"))
    )


def scan(docs: DataFrame) -> DataFrame:
    """Words, base matches and labels of every document, with the places of the base matches."""
    words = settled(licence_words(docs), "licence-words")
    base = [
        F.arrays_zip(F.array_repeat(F.lit(label), F.size(places(phrase))).alias("label"), places(phrase).alias("at"))
        for phrase, label in BASE.items()
    ]
    verified = [
        F.when(
            reduce(
                Column.__and__,
                [F.size(places(key)) > 0 for key in keys],
                F.expr(f"exists(candidates, c -> c.template = {number})"),
            ),
            F.lit(label),
        )
        for number, (label, _, keys) in enumerate(TEMPLATES)
    ]
    candidates = aligned(words).withColumnsRenamed({"doc_id": "_doc_id", "text_key": "_text_key"})
    same = F.expr("doc_id <=> _doc_id and text_key <=> _text_key")
    return (
        words.join(candidates, same, "left")
        .select(
            "doc_id",
            "n_words",
            "share",
            F.concat(*base).alias("base"),
            F.array_compact(F.array(*verified)).alias("method"),
        )
        .withColumn("n_base", F.size("base").cast("bigint"))
    )


def summary(found: DataFrame) -> DataFrame:
    """One row per document: counts, span of the base matches, labels as text, score from 0 to 1."""
    base_labels = F.array_sort(F.array_distinct(F.expr("transform(base, b -> b.label)")))
    labels = F.array_sort(F.array_union(base_labels, F.coalesce("method", F.array().cast("array<string>"))))
    share = F.when(F.size(F.coalesce("method", F.array().cast("array<string>"))) > 0, F.col("share"))
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        F.array_min(F.expr("transform(base, b -> b.at)")).alias("first_word"),
        F.array_max(F.expr("transform(base, b -> b.at)")).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce(share, F.lit(0.0))).alias("score"),
    )

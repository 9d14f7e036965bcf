"""License scans with a positional rare-token index, in DataFrame functions only.

Templates are licence notices as word sequences, some words of which form the
mandatory key phrase; the four base phrases are templates whose words are all
key. Words' document frequencies are counted over all documents, and of each
key phrase the rarest word (highest IDF) becomes its anchor. A document that
holds an anchor gets postings (word, position) of its licence words; postings
meet the templates' own postings, each pair votes for the start at which the
template would lie, and the votes of one start are intersected: all key words
must be there, and enough of the others.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm.textcore import stored

WORDS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
ENOUGH = 0.75  # share of a template's words that must be in place


@dataclass(frozen=True)
class Template:
    """A notice; key is the part of its words that must all be there."""
    label: str
    text: str
    key: str
    base: bool = False

    def words(self) -> list[tuple[int, str, bool]]:
        """(position, word, whether it is a key word)"""
        words, key = _words(self.text), _words(self.key)
        at = next(i for i in range(len(words)) if words[i:i + len(key)] == key)
        return [(i, w, at <= i < at + len(key)) for i, w in enumerate(words)]


def _words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


# fixed values: the base phrases and their labels
BASE_TEMPLATES = (
    Template("gpl", "gnu general public license", "gnu general public license", True),
    Template("apache", "apache license", "apache license", True),
    Template("cc-by", "cc by", "cc by", True),
    Template("mit", "mit license", "mit license", True),
)

# fixed values: customary notices of public licences
NOTICES = (
    Template("apache", "you may not use this file except in compliance with the license you may "
             "obtain a copy of the license at http www apache org licenses license 2 0",
             "www apache org licenses"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under "
             "the terms of the gnu general public license as published by the free software "
             "foundation", "gnu general public license"),
    Template("lgpl", "gnu lesser general public license", "lesser general public license"),
    Template("agpl", "gnu affero general public license", "affero general public license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of "
             "this software and associated documentation files", "hereby granted free of charge"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification "
             "are permitted provided that the following conditions are met",
             "source and binary forms"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose "
             "with or without fee is hereby granted", "with or without fee"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0",
             "mozilla public license"),
    Template("cc-by", "creative commons attribution 4 0 international", "creative commons attribution"),
    Template("cc0", "creative commons cc0 1 0 universal public domain dedication",
             "cc0 1 0 universal"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software"),
)

TEMPLATES = BASE_TEMPLATES + NOTICES
KEY = ["id", "h"]  # a row by its id and its text's hash; equal rows have equal labels


def _template_postings(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """(word, template, place, key): as many rows as the templates have words."""
    return spark.createDataFrame(
        [(w, i, at, key) for i, t in enumerate(templates) for at, w, key in t.words()],
        "word string, template int, place int, key boolean")


def _anchors(docs: DataFrame, templates: tuple[Template, ...]) -> list[str]:
    """The rarest key word of each template, by the number of documents that
    hold it (ties: the longer, then the first by alphabet)."""
    vocabulary = sorted({w for t in templates for _, w, key in t.words() if key})
    held = docs.select(F.explode(F.array_intersect(
        "words", F.array(*map(F.lit, vocabulary)))).alias("word"))
    # at most one row per key word of the templates
    df = {r["word"]: r["df"] for r in held.groupBy("word").agg(F.count("*").alias("df")).collect()}
    return sorted({min((w for _, w, key in t.words() if key),
                       key=lambda w: (df.get(w, 0), -len(w), w)) for t in templates})


def license_scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels,
    score.

    n_base counts the places of base templates, first_word and last_word are
    the smallest and largest of their starts (words from 0; null without any).
    labels are those of all templates found, score the best share of a found
    template's words in place, 0 without any. A null or empty text has no
    words. Repeated rows are each returned.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    split = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("h"),
        F.regexp_extract_all(F.lower(text), F.lit(WORDS), F.lit(0)).alias("words"))
    anchors = F.array(*map(F.lit, _anchors(split, templates)))
    vocabulary = sorted({w for t in templates for _, w, _ in t.words()})
    placed = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("word"))),
                      lambda p: p["word"].isin(vocabulary))
    rows = stored(split.select(
        "id", "h", F.size("words").cast("bigint").alias("n_words"),
        F.when(F.arrays_overlap("words", anchors), placed).alias("placed")), "licence-words")

    size = F.broadcast(spark.createDataFrame(
        [(i, t.label, t.base, len(t.words()), sum(k for _, _, k in t.words()))
         for i, t in enumerate(templates)],
        "template int, label string, base boolean, words int, keys int"))
    postings = (rows.where("placed is not null").select(*KEY, F.inline("placed"))
                .dropDuplicates([*KEY, "at"]))
    found = (postings.join(F.broadcast(_template_postings(spark, templates)), "word")
             .select(*KEY, "template", (F.col("at") - F.col("place")).alias("start"), "key")
             .groupBy(*KEY, "template", "start")
             .agg(F.count("*").alias("met"), F.count_if("key").alias("keys_met"))
             .join(size, "template")
             .where((F.col("keys_met") == F.col("keys")) & (F.col("met") >= ENOUGH * F.col("words"))))

    def labels(of) -> F.Column:
        return F.array_join(F.sort_array(F.collect_set(of)), ",")

    per_row = found.groupBy(*KEY).agg(
        F.count_if("base").alias("n_base"), F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
        labels(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        labels(F.col("label")).alias("labels"), F.max(F.col("met") / F.col("words")).alias("score"))
    per_row = per_row.withColumnsRenamed({"id": "id_r", "h": "h_r"})
    return rows.join(per_row, F.col("id").eqNullSafe(F.col("id_r")) & (F.col("h") == F.col("h_r")),
                     "left").select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        F.col("first_word").cast("bigint").alias("first_word"),
        F.col("last_word").cast("bigint").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))

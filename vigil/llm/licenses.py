"""License scan: phrases word by word, and an exact set-similarity join of text blocks with license templates.

A block is a paragraph, up to a line of white space only, so a notice counts however its lines are wrapped. A template meets a block if at least THRESHOLD of the template's distinct words are in the block
(containment). The join works on words in one global order, rare words first:

- length filter: a block needs as many template words as the least that any template asks for;
- prefix filter: with n words of which c must be met, one of the template's first n - c + 1 words must be in the block;
- positional filter: the words from there on must be enough, in the template and in the block;
- what is left is counted exactly.

Words that no template has cannot add to an overlap: they come first in the order and are left out. The index of
template words is a parameter's size (all words of all templates), whatever the size of the corpus, so it is
broadcast. Everything is DataFrame expressions.

Null texts count as empty (no words, no labels). A row's result depends on its text alone, so repeated rows give
repeated results; tables without rows give none; other columns are not read.
"""

from __future__ import annotations

import math
import re
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import written

#: The phrases that must be found word by word, and their labels.
PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
#: Notices by which licenses are commonly declared (short public notices, one block each).
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3", "GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("gpl-2", "GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
THRESHOLD = 0.95
BLANK = "\\n\\s*\\n"
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words_of(text: str) -> list[str]:
    """The words of a template or phrase: A-Z lower-cased, runs of digits, letters and all beyond ASCII."""
    return [w for w in re.split(NOT_WORD, text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))) if w]


def needed(n_words: int, threshold: float) -> int:
    return math.ceil(threshold * n_words - 1e-9)


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once a row, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def phrase_places(words: Column, phrase: list[str]) -> Column:
    """Starts (words from 0) of the phrase, all places; the words are looked at one by one only if all of them occur."""
    def here(i):
        hit = F.get(words, i) == phrase[0]
        for k, w in enumerate(phrase[1:], 1):
            hit = hit & (F.get(words, i + k) == w)
        return hit

    n = F.size(words)
    rare = max(phrase, key=len)
    return F.when((n >= len(phrase)) & F.array_contains(words, rare), F.filter(F.sequence(F.lit(0), n - len(phrase)), here)).otherwise(F.array().cast("array<int>"))


def read_words(df: DataFrame, key: str, text: str, phrases: dict[str, str], vocabulary: list[str], least: int) -> DataFrame:
    """One pass over the texts: phrase places, and of each paragraph with ``least`` template words or more those words."""
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    paragraphs = F.transform(F.split(lower, BLANK), lambda part: F.filter(F.split(part, NOT_WORD), lambda w: w != ""))

    def facts(by_block):
        blocks = F.filter(F.transform(by_block, lambda ws: F.array_distinct(F.filter(ws, lambda w: w.isin(vocabulary)))), lambda ws: F.size(ws) >= least)
        places = lambda words: F.struct(F.size(words).cast("long").alias("n_words"), *[phrase_places(words, words_of(p)).alias(x) for x, p in phrases.items()])
        return F.struct(blocks.alias("blocks"), let(F.flatten(by_block), places).alias("base"))

    return df.select(F.col(key).alias("__key"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("__text"), let(paragraphs, facts).alias("x")).select("__key", "__text", "x.blocks", "x.base")


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES,
         threshold: float = THRESHOLD) -> DataFrame:
    """Per row: key, n_words, n_base, first_word, last_word, base_labels, labels, score (the largest containment found; 1 for a phrase)."""
    spark = df.sparkSession
    sets = [(label, list(dict.fromkeys(words_of(t)))) for label, t in templates]
    vocabulary = sorted({w for _, ws in sets for w in ws})
    read = written(read_words(df, key, text, phrases, vocabulary, min(needed(len(ws), threshold) for _, ws in sets)))

    blocks = read.filter(F.size("blocks") > 0).select("__key", "__text", F.explode("blocks").alias("words"))
    often = {r["w"]: r["n"] for r in blocks.select(F.explode("words").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}  # of the vocabulary
    order = sorted(vocabulary, key=lambda w: (often.get(w, 0), w))
    place = {w: i for i, w in enumerate(order)}
    index = []
    for label, ws in sets:
        ids, c = sorted(place[w] for w in ws), needed(len(ws), threshold)
        index += [(ids[i], i, label, ids, c) for i in range(len(ids) - c + 1)]
    prefix = sorted({order[x[0]] for x in index})
    index = F.broadcast(spark.createDataFrame(index, "word int, t_at int, label string, t_words array<int>, c int"))

    ids = F.array_sort(F.transform("words", lambda w: F.array_position(F.array(*map(F.lit, order)), w).cast("int") - 1))
    probes = blocks.filter(F.exists("words", lambda w: w.isin(prefix))).select("__key", "__text", ids.alias("b_words")).select("__key", "__text", "b_words", F.posexplode("b_words").alias("b_at", "word"))
    left = F.least(F.size("t_words") - F.col("t_at"), F.size("b_words") - F.col("b_at"))
    met = F.size(F.array_intersect("b_words", "t_words"))
    found = (probes.join(index, "word").filter(left >= F.col("c")).withColumn("met", met).filter(F.col("met") >= F.col("c"))
             .groupBy("__key", "__text").agg(F.collect_set("label").alias("found"), F.max(F.col("met") / F.size("t_words")).alias("containment")))

    places = [F.col(f"base.`{x}`") for x in phrases]
    starts = F.flatten(F.array(*places))
    base = F.filter(F.array(*[F.when(F.size(p) > 0, F.lit(x)) for x, p in zip(phrases, places)]), lambda x: x.isNotNull())
    facts = read.select("__key", "__text", F.col("base.n_words").alias("n_words"), F.size(starts).cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"),
                        F.array_max(starts).cast("long").alias("last_word"), F.array_sort(base).alias("base"))
    f = found.select(F.col("__key").alias("__k"), F.col("__text").alias("__t"), "found", "containment")
    joined = facts.join(f, F.col("__key").eqNullSafe(F.col("__k")) & (F.col("__text") == F.col("__t")), "left")
    labels = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("found", F.array().cast("array<string>")))))
    return joined.select(F.col("__key").alias(key), "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
                         F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"))

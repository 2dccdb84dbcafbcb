"""License scan by an exact set-similarity join of text blocks with license templates.

A block is a run of consecutive lower-cased words, as many as the template has and a quarter more, wherever lines break,
so a notice may be wrapped, and words scattered over a long text do not count. A block meets a template when it contains
at least ``threshold`` of the template's distinct words and all of its ``TELLING`` ones, which name the license.

A text can only hold such a block if its whole set of words meets the template, so these sets are joined first.
Template words are ordered by how many documents hold them, rarest
first; a text keeps only template words, in that order. A text that meets a template must contain one of the
template's first ``|T| - needed + 1`` words (prefix), have at least ``needed`` words (length), and enough words must
follow the first common one on both sides (position); for pairs that pass, the blocks that begin at each template
word of the text are counted exactly. Templates are a short fixed list, so their index is broadcast.

Defined cases: null and empty texts have no words and no label; repeated rows get the same result each; ids may be
null; texts without template words take no part. Very long texts are split whole; of equal blocks the first counts. Columns other than the id and the text are not read, so their names cannot clash; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakemill.llm.frames import lower_ascii

# Notices as their licenses ask to have them written, with the label each stands for.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)
# The words of each template, in the same order, without which it is another license's notice or none's.
TELLING = (("apache",), (), (), ("cc", "by", "nc"), ("cc", "by", "sa"), ("general", "public", "3"), ("general", "public", "3"), ("mit",), (), ("mozilla",))
# Phrases that always count, with their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
THRESHOLD = 0.8
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NO_WORD_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def template_words(text: str) -> list[str]:
    return [w for w in re.split(_NO_WORD, text.lower()) if w]


def spaced(text: Column) -> Column:
    """The text's words, each between two spaces of its own; empty without words."""
    words = F.trim(F.regexp_replace(lower_ascii(text), _NO_WORD, " "))
    return F.when(words == "", "").otherwise(F.concat(F.lit(" "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" ")))


def _words_in(spaced_text: Column) -> Column:
    return ((F.length(spaced_text) - F.length(F.replace(spaced_text, F.lit(" "), F.lit("")))) / 2).cast("long")


def n_words(text: Column) -> Column:
    """How many words a text has: its parts between runs of other characters, less the empty ones at either end."""
    parts = F.split(text, _NO_WORD_ANY_CASE)
    empty = F.when(F.get(parts, F.lit(0)) == "", 1).otherwise(0) + F.when((F.size(parts) > 1) & (F.get(parts, F.size(parts) - 1) == ""), 1).otherwise(0)
    return (F.size(parts) - empty).cast("long")


def phrase_columns(spaced_text: Column, phrases: Sequence[tuple[str, str]] = PHRASES) -> dict[str, Column]:
    """n_words, n_base, first_word, last_word and base (labels) of the phrases' places."""
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in phrases:
        pattern = " " + "  ".join(phrase.split()) + " "
        n = ((F.length(spaced_text) - F.length(F.replace(spaced_text, F.lit(pattern), F.lit("")))) / len(pattern)).cast("long")
        at = F.instr(spaced_text, F.lit(pattern))
        back = F.length(spaced_text) - F.instr(F.reverse(spaced_text), F.lit(pattern[::-1])) - len(pattern) + 2
        counts.append(n)
        firsts.append(F.when(n > 0, _words_in(F.substring(spaced_text, F.lit(1), at - 1))))
        lasts.append(F.when(n > 0, _words_in(F.substring(spaced_text, F.lit(1), back - 1))))
        labels.append(F.when(n > 0, F.lit(label)))
    return {
        "n_words": _words_in(spaced_text), "n_base": sum(counts[1:], counts[0]),
        "first_word": F.least(*firsts), "last_word": F.greatest(*lasts), "base": F.array_compact(F.array(*labels)),
    }


def word_order(docs: DataFrame, words: list[str]) -> list[str]:
    """``words`` by the number of documents that hold them, rarest first; one row per word reaches the driver."""
    held = F.array_intersect(F.lit(words), F.split(lower_ascii(F.coalesce("text", F.lit(""))), _NO_WORD))
    counted = docs.select(F.explode(held).alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()
    n = {row["w"]: row["n"] for row in counted}
    return sorted(words, key=lambda w: (n.get(w, 0), w))


def holds(text: Column, asked: Sequence[Sequence[str]]) -> Column:
    """Whether the text can hold all words of one of the lists: they are looked for as substrings of the lower-cased text.

    (The lambda holds the lower-cased text so that it is made once.)
    """
    def any_of(lowered: Column) -> Column:
        return reduce(lambda a, b: a | b, (reduce(lambda a, b: a & b, (lowered.contains(w) for w in words)) for words in asked))

    return text.isNotNull() & F.exists(F.array(F.lower(text)), any_of)


def block_matches(spark: SparkSession, docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, telling=TELLING) -> DataFrame:
    """(doc_id, xxh, block, template, label, containment): the best block, by its first word, of every text and template that meet."""
    sets = [(label, set(template_words(text))) for label, text in templates]
    order = word_order(docs, sorted({w for _, words in sets for w in words}))
    place = {w: i for i, w in enumerate(order)}
    index = []
    for t, (label, words) in enumerate(sets):
        ranked = sorted(words, key=place.__getitem__)
        needed = math.ceil(threshold * len(ranked) - 1e-9)
        span = math.ceil(len(template_words(templates[t][1])) / threshold - 1e-9)
        for i, w in enumerate(ranked[:len(ranked) - needed + 1]):
            index.append((w, t, label, i, len(ranked), needed, ranked, list(telling[t]), span))
    prefix = F.broadcast(spark.createDataFrame(
        index, "word string, template int, label string, at int, size int, needed int, words array<string>, telling array<string>, span int"))
    least = min(row[5] for row in index)
    firsts = F.lit(sorted({row[0] for row in index}))
    lowered = lower_ascii(F.col("text"))
    made = F.struct(lowered.alias("lowered"), F.array_intersect(F.lit(order), F.split(lowered, _NO_WORD)).alias("held"))
    # Exploding a single struct keeps it one value: as a plain column the split would be made anew wherever it is used.
    texts = docs.filter(F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("xxh"), F.explode(F.array(made)).alias("t")).select(
        "doc_id", "xxh", "t.*").filter(F.size("held") >= least)
    asked = F.filter(F.transform("held", lambda w, i: F.struct(i.alias("pos"), w.alias("word"))), lambda x: F.array_contains(firsts, x["word"]))
    ranked = texts.withColumn("asked", F.explode(asked)).select("doc_id", "xxh", "lowered", "held", "asked.*").join(prefix, "word")
    has_all = lambda held: F.size(F.array_intersect(held, F.col("telling"))) == F.size("telling")
    enough = (F.size("held") >= F.col("needed")) & (
        F.least(F.col("size") - F.col("at"), F.size("held") - F.col("pos")) >= F.col("needed"))
    first = F.get(F.array_intersect("held", "words"), 0) == F.col("word")
    overlap = F.size(F.array_intersect("held", "words"))
    pairs = ranked.filter(enough).filter(first & (overlap >= F.col("needed")) & has_all(F.col("held")))

    numbered = F.transform(F.split("lowered", _NO_WORD), lambda w, i: F.struct(i.alias("i"), w.alias("w")))
    # Exploded like the texts: as a plain column the split would be made anew for every template word of the text.
    placed = pairs.withColumn("placed", F.explode(F.array(F.filter(numbered, lambda x: F.array_contains(F.col("words"), x["w"])))))

    def block(x: Column, k: Column) -> Column:
        near = F.filter(F.slice(F.col("placed"), k + 1, F.col("span")), lambda y: y["i"] < x["i"] + F.col("span"))
        return F.struct(F.array_distinct(F.transform(near, lambda y: y["w"])).alias("held"), (-x["i"]).alias("back"))

    blocks = F.filter(F.transform("placed", block), lambda b: (F.size(b["held"]) >= F.col("needed")) & has_all(b["held"]))
    best = F.array_max(F.transform(blocks, lambda b: F.struct(F.size(b["held"]).alias("n"), b["back"].alias("back"))))
    found = placed.withColumn("best", F.explode(F.array(best))).filter(F.col("best").isNotNull())
    return found.select(
        "doc_id", "xxh", (-F.col("best.back")).alias("block"), "template", "label", (F.col("best.n") / F.col("size")).alias("containment"))


def scanned(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, words and base phrases, all labels, and the greatest containment (1 with a base phrase)."""
    matches = block_matches(spark, docs).groupBy(F.col("doc_id").alias("id"), F.col("xxh").alias("x")).agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("best"))
    text = F.coalesce("text", F.lit(""))
    phrased = holds(text, [phrase.split() for phrase, _ in PHRASES])
    rows = docs.select(F.col("doc_id"), F.xxhash64("text").alias("xxh"), n_words(text).alias("n_words"),
                       F.when(phrased, spaced(text)).otherwise("").alias("spaced"))
    base = rows.select("doc_id", "xxh", "n_words", *[c.alias(n) for n, c in phrase_columns(F.col("spaced")).items() if n != "n_words"])
    joined = base.join(matches, F.col("doc_id").cast("long").eqNullSafe(F.col("id")) & (F.col("xxh") == F.col("x")), "left")
    listed = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", listed("base").alias("base_labels"),
        listed(F.concat("base", F.coalesce("found", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))

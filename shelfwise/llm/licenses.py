"""License scans: phrases, and an exact set-similarity join of text blocks with license templates.

A block matches a template when it holds at least a given share of the template's different words. The words that occur
in templates are ordered by how many documents hold them, rarest first. Of a block and a template that need ``need``
common words, the first ``size - need + 1`` words in that order (the prefixes) must share one, so blocks are compared only
with templates whose prefix theirs meets; the length filter wants ``need`` words in the block, the positional filter
that the words after the last common one in both prefixes can still make up ``need``. What passes is counted exactly.
Templates are parameters, so their words, and the counts gathered for them, are bounded; texts are neither exploded nor
shuffled, and a document without any template's rare words is never cut into blocks.

Blocks are overlapping windows: a passage of up to half a block lies in a block as a whole. A template of more than
``block_words / 2`` words is compared with longer blocks, doubled until they are twice its length, so that a text that
holds all of it always matches; ``matches`` number the blocks of each length for themselves.

Defined results: a null or blank text has no words and no places. Every row is scanned by itself, so repeated rows
and null ids need no care. Without documents all template words are equally rare.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .spans import once

# What separates words, and the base phrases with their labels.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Characteristic passages of common licenses, with their labels.
TEMPLATES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
    "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "apache": "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the "
    "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or at your option any "
    "later version",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
    "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
}
THRESHOLD = 0.8
BLOCK_WORDS = 200

MATCH = "array<struct<block:int,label:string,containment:double>>"


def normalized(text: Column) -> Column:
    """The words in lower case, each with a space before and after it. (Beyond A-Z, ``lower`` changes no ASCII word
    and joins or splits none.)"""
    words = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS, " "))
    return F.when(words == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def word_list(padded: Column) -> Column:
    return F.when(padded == " ", F.array().cast("array<string>")).otherwise(F.split(F.trim(padded), " "))


def template_words(templates: dict[str, str]) -> dict[str, list[str]]:
    def plain(text: str) -> str:
        return "".join(letter if letter.isalnum() or ord(letter) > 127 else " " for letter in text.lower())

    return {label: plain(text).split() for label, text in templates.items()}


def by_block_length(templates: dict[str, list[str]], block_words: int) -> dict[int, dict[str, set[str]]]:
    """The templates' different words, by the length of the blocks they are compared with."""
    groups: dict[int, dict[str, set[str]]] = {}
    for label, words in templates.items():
        length = block_words
        while length < 2 * len(words):
            length *= 2
        groups.setdefault(length, {})[label] = set(words)
    return groups


def token_order(docs: DataFrame, text: str, vocabulary: list[str]) -> list[str]:
    """The vocabulary, rarest in the documents first; ties in alphabetical order."""
    words = word_list(normalized(F.col(f"`{text}`")))
    held = docs.select(F.explode(F.array_intersect(F.lit(vocabulary), words)).alias("word"))
    counts = {row.word: row["count"] for row in held.groupBy("word").count().collect()}  # no more than the vocabulary
    return sorted(vocabulary, key=lambda word: (counts.get(word, 0), word))


def spaces(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))


def base_places(padded: Column) -> dict[str, Column]:
    """Number of places of all phrases, first and last starting word, labels. Phrases cannot overlap."""
    anyone = f"(?<= )(?:{'|'.join(PHRASES)})(?= )"
    holds = {phrase: F.contains(padded, F.lit(f" {phrase} ")) for phrase in PHRASES}
    some = holds[next(iter(PHRASES))]
    for one in holds.values():
        some = some | one
    first = F.substr(padded, F.lit(1), F.regexp_instr(padded, F.lit(anyone)) - 1)
    last = F.regexp_extract(padded, f"(?s)^(.*){anyone}", 1)
    labels = F.array_compact(F.array(*[F.when(holds[phrase], F.lit(label)) for phrase, label in PHRASES.items()]))
    return {
        "n_base": F.when(some, F.regexp_count(padded, F.lit(anyone))).otherwise(0).cast("long"),
        "first_word": F.when(some, spaces(first) - 1).cast("long"),
        "last_word": F.when(some, spaces(last) - 1).cast("long"),
        "base_labels": F.array_sort(F.array_distinct(labels)),
    }


def template_matches(
    words: Column, templates: dict[str, set[str]], order: list[str], threshold: float, block_words: int
) -> Column:
    """Every (block, label, containment) that meets the threshold."""
    rank = {word: place for place, word in enumerate(order)}
    index = []
    for label, held in templates.items():
        listed = sorted(held, key=rank.__getitem__)
        need = math.ceil(round(threshold * len(listed), 9))
        index.append((label, listed, need, listed[: len(listed) - need + 1]))
    rare = sorted({word for *_, prefix in index for word in prefix}, key=rank.__getitem__)
    lists = F.array(*[
        F.struct(F.lit(label).alias("label"), F.lit(listed).alias("words"), F.lit(need).alias("need"), F.lit(prefix).alias("prefix"))
        for label, listed, need, prefix in index
    ])
    least = min(need for _, _, need, _ in index)

    def compared(block: Column, number: Column) -> Column:
        def candidate(one: Column) -> Column:
            open_ = F.size(block) - one["need"] + 1  # length of the block's prefix
            shared = F.array_intersect(F.slice(block, F.lit(1), F.greatest(open_, F.lit(0))), one["prefix"])
            end = F.element_at(shared, -1)
            left = F.least(
                F.size(one["words"]) - F.array_position(one["words"], end), F.size(block) - F.array_position(block, end)
            )
            meets = F.when((open_ > 0) & (F.size(shared) > 0), F.size(shared) + left >= one["need"])
            return F.coalesce(meets, F.lit(False))

        counted = F.transform(F.filter(lists, candidate), lambda one: F.struct(
            number.alias("block"), one["label"].alias("label"),
            (F.size(F.array_intersect(block, one["words"])) / F.size(one["words"])).alias("containment"),
            (F.size(F.array_intersect(block, one["words"])) >= one["need"]).alias("met"),
        ))
        return F.filter(counted, lambda one: one["met"])

    stride = max(1, block_words // 2)
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - 1 - (block_words - stride), F.lit(0)), F.lit(stride))
    blocks = F.transform(starts, lambda at: F.array_intersect(F.lit(order), F.slice(words, at + 1, F.lit(block_words))))
    found = F.flatten(F.transform(blocks, lambda block, number: F.when(
        (F.size(block) >= least) & F.arrays_overlap(block, F.lit(rare)), compared(block, number)
    ).otherwise(F.array())))
    kept = F.transform(found, lambda one: F.struct(one["block"], one["label"], one["containment"])).cast(MATCH)
    return F.when(F.arrays_overlap(words, F.lit(rare)), kept).otherwise(F.array().cast(MATCH))


def scan_licenses(
    docs: DataFrame, text: str = "text", into: str = "licenses", templates: dict[str, str] | None = None,
    threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with a struct ``into``: n_words, n_base, first_word, last_word, base_labels, matches, labels, score.

    ``score`` is 1 with a base phrase, else the largest containment of a match, else 0.
    """
    held = by_block_length(template_words(TEMPLATES if templates is None else templates), block_words)
    order = token_order(docs, text, sorted({word for group in held.values() for words in group.values() for word in words}))
    padded = once(docs, _padded=normalized(F.col(f"`{text}`")))
    listed = once(padded, _words=word_list(F.col("_padded")), **{into: F.struct(
        F.when(F.col("_padded") == " ", 0).otherwise(spaces(F.col("_padded")) - 1).cast("long").alias("n_words"),
        *[value.alias(name) for name, value in base_places(F.col("_padded")).items()],
    )}).drop("_padded")
    matches = []
    for length, group in held.items():
        used = set().union(*group.values())
        ranked = [word for word in order if word in used]
        matches.append(template_matches(F.col("_words"), group, ranked, threshold, length))
    matched = once(listed, _matches=matches[0] if len(matches) == 1 else F.concat(*matches)).drop("_words")
    found = F.col(f"`{into}`")
    labels = F.concat(found["base_labels"], F.transform("_matches", lambda one: one["label"]))
    best = F.coalesce(F.array_max(F.transform("_matches", lambda one: one["containment"])), F.lit(0.0))
    return matched.withColumn(
        into, found.withField("matches", F.col("_matches")).withField("labels", F.array_sort(F.array_distinct(labels)))
        .withField("score", F.when(found["n_base"] > 0, F.lit(1.0)).otherwise(best)),
    ).drop("_matches")

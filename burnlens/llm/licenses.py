"""Licence scan: Dice coefficient over word bigrams (operator 10).

A text is normalised to lower-case words of letters and digits. Its bigrams are
joined with those of the licence templates; a template of n bigrams is found
where a window of n bigrams of the text holds so many distinct ones of the
template that Dice = 2 * shared / (window + template) reaches the threshold.
Size bounds prune before that: a (text, template) pair with fewer matching
bigrams than the threshold needs is dropped by a count, and a text shorter than
the least size that can reach it never meets the template.

DataFrame functions only. The templates are a fixed list (broadcast: a few
thousand bigrams whatever the input). The text's bigrams are not shuffled, only
those that some template has; a pair's matches are grouped, at most as many as
one text holds.

Contract cases: NULL and empty texts match nothing; one row per distinct
(doc_id, text) and licence, the best window (the first one on ties), and one
licence for each place; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burnlens.llm.quality_rules import _let

THRESHOLD = 0.8
NOT_A_WORD = r"[^\p{L}\p{N}]+"

# Notices by which works state their licence.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or any later version",
    ),
    "LGPL": ("Licensed under the GNU Lesser General Public License",),
    "AGPL-3.0": ("Licensed under the GNU Affero General Public License, version 3",),
    "BSD": (
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "all-rights-reserved": ("All rights reserved.",),
}


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), NOT_A_WORD), "")


def _pairs(words: Column) -> Column:
    """The bigrams of a word array, in order."""
    return _let(words, lambda w: F.when(F.size(w) >= 2, F.transform(
        F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.concat(F.get(w, i), F.lit(" "), F.get(w, i + 1)))))


def needed(n: int, threshold: float = THRESHOLD) -> int:
    """Shared bigrams that a window of n needs for Dice = shared / n to reach the threshold."""
    return math.ceil(threshold * n - 1e-9)


def template_bigrams(docs: DataFrame, templates: dict[str, tuple[str, ...]], threshold: float) -> DataFrame:
    """template, license, size, need, bigram: a row per distinct bigram."""
    rows = [(k, name, t) for k, (name, t) in enumerate((name, t) for name, ts in templates.items() for t in ts)]
    src = docs.sparkSession.createDataFrame(rows, "template int, license string, notice string")
    listed = src.select("template", "license", F.array_distinct(_pairs(words_of(F.col("notice")))).alias("bigrams"))
    sized = listed.withColumn("size", F.size("bigrams"))
    return sized.select("template", "license", "size", F.ceil(F.lit(threshold) * F.col("size") - 1e-9).cast("int").alias("need"),
                        F.explode("bigrams").alias("bigram"))


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license, dice, start_word, n_words: the best window of each
    licence that a text holds."""
    known = template_bigrams(docs, TEMPLATES if templates is None else templates, threshold)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = (texts.select("doc_id", F.xxhash64("text").alias("text_key"), F.posexplode(_pairs(words_of(F.col("text")))).alias("at", "bigram"))
             .join(F.broadcast(known), "bigram"))
    # The size bound: fewer matches than needed can't reach the threshold.
    pairs = (found.groupBy("doc_id", "text_key", "template", "license", "size", "need")
             .agg(F.collect_list(F.struct("at", F.xxhash64("bigram").alias("bigram"))).alias("hits"))
             .where(F.size("hits") >= F.col("need")))

    def windows(hits: Column) -> Column:
        """(distinct shared bigrams, -start) of the window from each hit."""
        return F.transform(hits, lambda h, i: F.struct(
            F.size(F.array_distinct(F.transform(
                F.filter(F.slice(hits, i + 1, F.col("size")), lambda x: x["at"] < h["at"] + F.col("size")),
                lambda x: x["bigram"]))).alias("shared"),
            (-h["at"]).alias("start")))

    best = pairs.select("doc_id", "text_key", "license", "size", "need",
                        _let(F.array_sort(F.array_distinct("hits")), lambda hits: F.array_max(windows(hits))).alias("best"))
    dice = (F.col("best.shared") / F.col("size")).alias("dice")
    # Of the notices found at one place the closest is meant, the longest on ties, then the first by name.
    placed = (best.where(F.col("best.shared") >= F.col("need"))
              .groupBy("doc_id", "text_key", F.col("best.start").alias("start"))
              .agg(F.max(F.struct(dice, F.col("size"))).alias("b"), F.min(F.struct((-dice).alias("d"), (-F.col("size")).alias("s"), "license"))["license"].alias("license")))
    return (placed.groupBy("doc_id", "text_key", "license")
            .agg(F.max(F.struct(F.col("b.dice").alias("dice"), "start", F.col("b.size").alias("size"))).alias("b"))
            .select("doc_id", "license", F.col("b.dice").alias("dice"), (-F.col("b.start")).alias("start_word"), (F.col("b.size") + 1).alias("n_words")))

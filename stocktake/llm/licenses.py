"""License scans: phrases that name a license, and an exact set-similarity join of text blocks with license notices.

A block is a window of consecutive words, across line ends, that begins at a word of the notice and is as long as the notice's text
divided by THRESHOLD. It matches the notice if it holds at least THRESHOLD of the notice's distinct words (containment). Texts are
cut into overlapping stretches, each with all windows that begin in its own part and whatever these overlap; stretches are joined with
notices, and the windows of what is left are counted one by one. Words are ordered by their frequency in the whole corpus, rarest first. A stretch with a match must hold one of
the first |T| - need + 1 words of the notice T (prefix filter), at least `need` words (length filter), and must still be able to reach
`need` from the place of the shared word in both orders (positional filter); what is left is counted exactly. Where the matches of two
notices overlap and all the words of one match are part of the other, which holds a larger share, only the latter
counts: sister licenses differ by a word. `scan` can also take lines as blocks, each a bag of words of any length. Notices are a parameter, so their index has a known size and is broadcast.

Defined results: null and empty texts have no words and no labels; equal rows get equal results; a block matching several
notices counts once for each label; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktake.llm.common import ascii_lower, let, staged, table

THRESHOLD = 0.8
#: Anything that is not part of a word after lower-casing: ASCII but digits and small letters.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that name a license, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Notices that licenses ask for, by label.
NOTICES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software.",
    ],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}


def words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), BREAK), lambda w: w != "")


def templates(notices: dict[str, list[str]] = NOTICES, threshold: float = THRESHOLD) -> list[tuple[int, str, list[str], int]]:
    """(number, label, distinct words, words a block must share)."""
    out = []
    for label, texts in notices.items():
        for text in texts:
            cleaned = "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in text)
            own = sorted(set("".join(c.lower() if c.isascii() else c for c in cleaned).split()))
            out.append((len(out), label, own, math.ceil(round(threshold * len(own), 9))))
    return out


def windows(notices: dict[str, list[str]] = NOTICES, threshold: float = THRESHOLD) -> list[int]:
    """Words in a window of each notice, in the order of templates()."""
    n_words = [len("".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in text).split()) for texts in notices.values() for text in texts]
    return [math.ceil(round(n / threshold, 9)) for n in n_words]


def _stretches(found: Column, vocabulary: Column, step: int) -> Column:
    """For every `step` words the words of the notices (at, w) from one step before to two steps after: what may overlap a window that begins in it."""

    def cut(known: Column) -> Column:
        def stretch(begin: Column) -> Column:
            first = F.greatest(begin - step, F.lit(0))
            part = F.slice(known, first + 1, begin + 3 * step - first)
            return F.filter(F.transform(part, lambda w, i: F.struct((first + i).alias("at"), w.alias("w"))), lambda x: x["w"].isNotNull())

        begins = F.when(F.size(known) > 0, F.sequence(F.lit(0), F.size(known) - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
        return F.transform(begins, lambda begin: F.struct(begin.alias("begin"), stretch(begin).alias("marks")))

    return let(F.transform(found, lambda w: F.when(F.array_contains(vocabulary, w), w)), cut)


def _matches(marks: Column) -> Column:
    """Windows of a stretch that hold enough of the notice: label, share, words, and the places of the first and last of them."""

    def window(own: Column) -> Column:
        def one(x: Column) -> Column:
            inside = F.filter(own, lambda y: (y["at"] >= x["at"]) & (y["at"] < x["at"] + F.col("window")))
            return F.struct(F.array_distinct(F.transform(inside, lambda y: y["w"])).alias("words"), x["at"].alias("first"), F.element_at(inside, -1)["at"].alias("last"))

        return F.filter(F.transform(own, one), lambda x: F.size(x["words"]) >= F.col("need"))

    return F.transform(
        let(F.filter(marks, lambda x: F.array_contains(F.col("own"), x["w"])), window),
        lambda x: F.struct(F.col("label").alias("label"), (F.size(x["words"]) / F.col("size")).alias("held"), x["words"].alias("words"), x["first"].alias("first"), x["last"].alias("last")),
    )


def _places(found: Column, parts: list[str], label: str) -> Column:
    """Places (start, label) where the parts stand consecutively, from the place of their last word."""

    def start(w: Column, i: Column) -> Column:
        same = w == parts[-1]
        for back, part in enumerate(reversed(parts[:-1]), start=1):
            same = same & (F.get(found, i - back) == part)
        return F.when(same, i - (len(parts) - 1))

    hits = F.filter(F.transform(found, start), lambda x: x.isNotNull())
    return F.transform(hits, lambda x: F.struct(x.cast("long").alias("start"), F.lit(label).alias("label")))


def _phrases(found: Column) -> Column:
    return F.concat(*[_places(found, phrase.split(" "), label) for phrase, label in PHRASES.items()])


def scan(docs: DataFrame, notices: dict[str, list[str]] = NOTICES, threshold: float = THRESHOLD, across_lines: bool = False) -> DataFrame:
    """One row for each document: counts, phrase places, labels, and score (1 for a phrase, else the best containment). Blocks are lines, or,
    across_lines, windows of words."""
    spark = docs.sparkSession
    known = templates(notices, threshold)
    vocabulary = F.array(*[F.lit(w) for w in sorted({w for t in known for w in t[2]})])
    text = F.coalesce(F.col("text"), F.lit(""))
    nothing = F.array().cast("array<struct<start:bigint,label:string>>")
    last_words = sorted({p.split(" ")[-1] for p in PHRASES})
    named = F.lit(False)
    for w in last_words:
        named = named | F.contains(ascii_lower(text), F.lit(w))

    def counted(found: Column) -> Column:
        return F.struct(
            F.size(found).cast("long").alias("n_words"), F.when(named, _phrases(found)).otherwise(nothing).alias("places"),
            F.array_intersect(found, vocabulary).alias("hits"),
        )

    # A block cannot hold enough of a notice unless its whole text does, so only such texts keep their blocks.
    holds = F.lit(False)
    for _, _, own, need in known:
        holds = holds | (F.size(F.array_intersect(F.col("c.hits"), F.array(*[F.lit(w) for w in own]))) >= need)
    least = min((t[3] for t in known), default=1)
    lengths = windows(notices, threshold)
    step = max(lengths, default=1)
    if across_lines:
        blocks = F.filter(_stretches(words(text), vocabulary, step), lambda x: F.size(F.array_distinct(F.transform(x["marks"], lambda m: m["w"]))) >= least)
    else:
        blocks = F.filter(F.transform(F.split(text, "\n"), lambda x: F.array_intersect(words(x), vocabulary)), lambda x: F.size(x) >= least)
    seen = staged(
        docs.select("doc_id", F.col("text"), let(words(text), counted).alias("c")).select(
            "doc_id", F.monotonically_increasing_id().alias("row"), "c.*", F.when(holds, blocks).alias("blocks")
        ), "licenses",
    )
    # Frequencies of the notices' words in the whole corpus: as many rows as the notices have words.
    frequency = {r["w"]: r["n"] for r in seen.select(F.explode("hits").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    rank = {w: k for k, w in enumerate(sorted({w for t in known for w in t[2]}, key=lambda w: (frequency.get(w, 0), w)))}
    index = []
    for number, label, own, need in known:
        ordered = sorted(own, key=rank.get)
        index += [(w, number, label, k, len(ordered), need, lengths[number], ordered) for k, w in enumerate(ordered[: len(ordered) - need + 1])]
    index_df = spark.createDataFrame(index, "word string, number int, label string, at int, size int, need int, window int, own array<string>")
    ranks = F.array(*[F.lit(w) for w in sorted(rank, key=rank.get)])
    lines = seen.where(F.col("blocks").isNotNull()).select("row", F.posexplode("blocks").alias("line", "block"))
    # array_intersect keeps the order of its first argument: the block's words from rare to frequent.
    if across_lines:
        lines = lines.select("row", "line", F.col("block.begin").alias("begin"), F.col("block.marks").alias("marks"), F.col("block.marks.w").alias("block"))
    lines = lines.withColumn("block", F.array_intersect(ranks, F.col("block")))
    shared = lines.select("*", F.posexplode("block").alias("place", "word")).join(F.broadcast(index_df), "word")
    able = shared.where(
        (F.size("block") >= F.col("need")) & (F.least(F.col("at"), F.col("place")) + 1 + F.least(F.col("size") - F.col("at"), F.size("block") - F.col("place")) - 1 >= F.col("need"))
    )
    both = able.withColumn("words", F.array_intersect("block", "own")).where(F.size("words") >= F.col("need"))
    # A notice of the same words but fewer, like that of a sister license, is no match of its own.
    if across_lines:
        # A pair comes once for each shared word of the prefix; the rarest one stands for it.
        once = both.where(F.col("words")[0] == F.col("word")).select("row", "line", "begin", _matches(F.col("marks")).alias("xs")).where(F.size("xs") > 0)
        per_line = once.groupBy("row", "line", "begin").agg(F.flatten(F.collect_list("xs")).alias("xs"))
        own_part = F.filter("xs", lambda x: (x["first"] >= F.col("begin")) & (x["first"] < F.col("begin") + step))
        best = F.filter(own_part, lambda x: ~F.exists("xs", lambda y: (y["held"] > x["held"]) & (y["first"] <= x["last"]) & (y["last"] >= x["first"])
                                                      & (F.size(F.array_except(x["words"], y["words"])) == 0)))
    else:
        found = F.struct("label", (F.size("words") / F.col("size")).alias("held"), "words")
        per_line = both.select("row", "line", found.alias("x")).distinct().groupBy("row", "line").agg(F.collect_list("x").alias("xs"))
        best = F.filter("xs", lambda x: ~F.exists("xs", lambda y: (y["held"] > x["held"]) & (F.size(F.array_except(x["words"], y["words"])) == 0)))
    matched = per_line.select("row", F.explode(best).alias("x")).select("row", "x.label", "x.held")
    by_row = matched.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("held").alias("held"))
    starts, base = F.transform("places", lambda x: x["start"]), F.array_sort(F.array_distinct(F.transform("places", lambda x: x["label"])))
    out = seen.drop("blocks", "hits").join(by_row, "row", "left")
    return out.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.concat_ws(",", base).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union(base, F.coalesce("more", F.array().cast("array<string>"))))).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("held", F.lit(0.0))).alias("score"),
    )


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan all documents."""
    return scan(table(spark, sf_dir, "documents"), across_lines=True)

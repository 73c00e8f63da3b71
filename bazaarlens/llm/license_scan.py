"""License scan: diagonal voting of word k-grams against templates. DataFrame functions only."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from bazaarlens.llm.common import col, written

# fixed values: the words of a text once A-Z are lower-cased, the base phrases with their labels, and well-known notices with theirs
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))
NOTICES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software "
            "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
            "to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
            "permission notice appear in all copies."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must "
            "retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of "
            "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                 "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                 "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either "
              "version 2 of the License, or (at your option) any later version."),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
              "version 3 of the License, or (at your option) any later version."),
    ("lgpl-3", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, "
               "either version 3 of the License, or (at your option) any later version."),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
              "https://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
                  "source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide."),
)
# end of fixed values

K = 3  # words of a gram: as many as the shortest base phrase has
SIMILAR = 0.8  # share of a notice's words that a span must hold
MOST_GRAMS = 100_000  # of all templates: they are broadcast
MARK = -1  # stands for the document itself among the templates


@dataclass(frozen=True)
class Template:
    """Words to be found, how far apart diagonals may lie to count as neighbours, and the similarity asked for."""

    label: str
    words: tuple[str, ...]
    base: bool

    @property
    def gap(self) -> int:
        """Words that an edited copy may have more or less in one place; none for a base phrase."""
        return 0 if self.base else min(K, len(self.words) // 4)

    @property
    def least(self) -> float:
        return 1.0 if self.base else SIMILAR


def templates(phrases: tuple[tuple[str, str], ...] = PHRASES, notices: tuple[tuple[str, str], ...] = NOTICES) -> list[Template]:
    out = [Template(label, tuple(re.findall(WORD, text.lower())), base) for texts, base in ((phrases, True), (notices, False)) for label, text in texts]
    if any(len(t.words) < K for t in out):
        raise ValueError(f"a template has at least {K} words")
    if sum(len(t.words) for t in out) > MOST_GRAMS:
        raise ValueError("templates are broadcast: too many words")
    if not all(w.isascii() for t in out for w in t.words):
        raise ValueError("templates are ASCII: other letters keep their case in a text")
    return out


def words_of(text: Column) -> Column:
    """The words of a text, capitals A-Z lower-cased; other letters' case doesn't matter here, but two of them must not become ASCII."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    odd = text.contains("\u212a") | text.contains("\u0130")
    return F.regexp_extract_all(F.when(odd, F.translate(text, upper, lower)).otherwise(F.lower(text)), F.lit(WORD), F.lit(0))


def gram_table(spark: SparkSession, found: list[Template]) -> DataFrame:
    """(gram, template, place, gram_words) of all templates, and the mark's one row."""
    rows = [(k, at, list(t.words[at : at + K])) for k, t in enumerate(found) for at in range(len(t.words) - K + 1)]
    table = spark.createDataFrame([*rows, (MARK, 0, [""] * K)], "template int, place int, gram_words array<string>")
    return table.withColumn("gram", F.xxhash64(*[F.col("gram_words")[j] for j in range(K)]))


def votes(docs: DataFrame, found: list[Template], id_col: str, text_col: str) -> DataFrame:
    """(id, tk, n_words, template, diagonal, places, rows): the places of a template met on each diagonal, and a row per document as its mark.

    All rolling grams are joined by hash to the templates' places, equal hashes by their words, too.
    A diagonal is the word of the text at which the template would start. `rows` of
    the mark counts the rows equal in id and text; they vote as one.
    """
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    rows = docs.select(col(id_col).alias("id"), F.xxhash64(text).alias("tk"), words_of(text).alias("words")).withColumn("n_words", F.size("words").cast("long"))
    rolled = F.transform(F.slice("words", F.lit(1), F.greatest(F.col("n_words").cast("int") - (K - 1), F.lit(0))), lambda w, i: F.xxhash64(w, *[F.get("words", i + j) for j in range(1, K)]))
    mark = F.xxhash64(*[F.lit("")] * K)
    # outer, though no list is empty: else Spark adds a filter on its size ahead, in which the words are taken anew for each gram
    grams = rows.withColumn("grams", F.concat(rolled, F.array(mark))).select("id", "tk", "n_words", "words", F.posexplode_outer("grams").alias("at", "of"))
    table = F.broadcast(gram_table(docs.sparkSession, found))  # at most `MOST_GRAMS` short rows
    same = (F.col("template") == MARK) == (F.col("at") > F.col("n_words") - K)
    for j in range(K):
        same = same & ((F.col("template") == MARK) | F.get("words", F.col("at") + j).eqNullSafe(F.col("gram_words")[j]))
    met = grams.join(table, (F.col("of") == F.col("gram")) & same)
    diagonal = F.when(F.col("template") == MARK, 0).otherwise(F.col("at") - F.col("place"))
    return met.groupBy("id", "tk", "n_words", "template", diagonal.alias("diagonal")).agg(F.collect_set("place").alias("places"), F.count("*").alias("rows"))


def spans(voted: DataFrame, found: list[Template]) -> DataFrame:
    """(id, tk, n_words, rows, label, base, start, end, similarity): verified spans of words, the end exclusive; a row without label per document.

    Neighbouring diagonals of a template are merged. A span holds if the template's words met in it are
    its share `least` of the template's words, or of the span's, if those are more. Of notices that
    overlap, the most similar ones stay, several if they are equally so. Windows lie within a document.
    """
    spark = voted.sparkSession
    facts = spark.createDataFrame([(k, t.label, t.base, len(t.words), t.gap, t.least) for k, t in enumerate(found)], "template int, label string, base boolean, size int, gap int, least double")
    cases = voted.where(F.col("template") != MARK).join(F.broadcast(facts), "template")  # one row per template
    by = ["id", "tk", "n_words", "template"]
    row = Window.partitionBy(*by).orderBy("diagonal")
    fresh = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(row) > F.col("gap"), F.lit(True))
    merged = cases.withColumn("_new", fresh.cast("int")).withColumn("island", F.sum("_new").over(row))
    place = F.transform("places", lambda p: p + F.col("diagonal"))
    merged = merged.groupBy(*by, "island", "label", "base", "size", "least").agg(
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"), F.min(F.array_min(place)).alias("start"), (F.max(F.array_max(place)) + K).alias("end")
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + K - 1)))))
    held = merged.withColumn("similarity", covered / F.greatest(F.col("size"), F.col("end") - F.col("start"))).where(F.col("similarity") >= F.col("least"))
    # runs of overlapping notices: the most similar of each stay
    near = Window.partitionBy("id", "tk", "base").orderBy("start", "end", "template").rowsBetween(Window.unboundedPreceding, -1)
    apart = F.coalesce(F.col("start") >= F.max("end").over(near), F.lit(True)) | F.col("base")
    runs = held.withColumn("_new", apart.cast("int")).withColumn("run", F.sum("_new").over(near.rowsBetween(Window.unboundedPreceding, 0)))
    best = F.max("similarity").over(Window.partitionBy("id", "tk", "base", "run"))
    kept = runs.withColumn("best", best).where(F.col("similarity") == F.col("best"))
    none = F.lit(None)
    marks = voted.where(F.col("template") == MARK).select(
        "id", "tk", "n_words", "rows", none.cast("string").alias("label"), none.cast("boolean").alias("base"), none.cast("int").alias("start"), none.cast("int").alias("end"), none.cast("double").alias("similarity")
    )
    return marks.unionByName(kept.select("id", "tk", "n_words", F.lit(None).cast("long").alias("rows"), "label", "base", "start", "end", "similarity"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", found: list[Template] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans of each row.

    Base spans are the places where a phrase's words stand consecutively: a diagonal that all its grams
    vote for. Notices are found by `spans`, edited copies, too. score is the greatest similarity of a span, 1 for a
    base phrase, 0 without any; spans is the array of (start, end, label, base, similarity), in words.
    Null text: empty, no words. Every row has a result; rows equal in id and text have equal ones.
    The whole text is read once; what is shuffled is a row per document and per diagonal met.
    """
    found = templates() if found is None else found
    # written, as marks and spans both come from it: the texts are read once
    each = spans(written(votes(docs, found, id_col, text_col), "votes"), found)
    start = F.when(F.col("base"), F.col("start").cast("long"))
    span = F.when(F.col("label").isNotNull(), F.struct("start", "end", "label", "base", "similarity"))
    text = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    per = each.groupBy("id", "tk", "n_words").agg(
        F.max("rows").cast("int").alias("rows"), F.count_if("base").alias("n_base"), F.min(start).alias("first_word"), F.max(start).alias("last_word"),
        text(F.when(F.col("base"), F.col("label"))).alias("base_labels"), text(F.col("label")).alias("labels"),
        F.coalesce(F.max("similarity"), F.lit(0.0)).alias("score"), F.array_sort(F.collect_list(span)).alias("spans"),
    )
    out = per.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")

"""License scans: diagonal voting of word k-grams.

Templates are phrases and standard passages of licenses. All runs of K words of every document are
hashed and joined with the places of the templates' runs; equal hashes are checked word by word. A
match at word p of a document and word t of a template votes for the diagonal p - t. Votes of one
template that follow each other closely, on the same or neighbouring diagonals, are one span,
so that a few inserted or lost words do not break it; where a run stands several times in a template, the
diagonal with the most votes nearby has it. A span is verified by the share of the
template's runs that it has: all of them, on one diagonal, for phrases; `VERIFIED` for passages.

Licenses of a family share most of their words, so a passage must also show what tells it apart. Where it
names telling words, all of their runs must be there: a near miss of another license vetoes the label. Other
passages need a run that no template of another label has, and those without one must be whole. A
passage does not count where a verified passage of another label holds it. The passages that all
licenses of a family have in common are marked general: they give their label only to documents in which
no passage of the family says otherwise.

One pass over the texts, all in Spark's own functions: the texts are not shuffled, and only
matches and one row for each document are written. The templates are a fixed list of bounded
size, which is sent to all tasks.

Null and empty texts have no words, no labels and score 0. Repeated rows give one row each, null ids
too. Texts are whole; a document's matches are grouped by its row, not by its id. Extra
columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioloom.llm.common import stored

K = 3  # words in a run; no phrase is shorter
GAP = 12  # words without a vote inside a span
DRIFT = 4  # diagonals that a span may move between two votes
VERIFIED = 0.6  # share of a passage's runs that make it found

#: Phrases and their labels.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
_GNU = "License as published by the Free Software Foundation"
_CC = "licensed under a Creative Commons Attribution"
_GRANTED = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
            "fee is hereby granted")
#: Passages of public licenses, their labels, their telling words, and whether they are general.
PASSAGES = [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files, to deal in the Software without restriction", "mit", (), True),
    ("to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
     "copyright notice and this permission notice shall be included in all copies", "mit",
     ("to do so subject to the following conditions",), False),
    ("to permit persons to whom the Software is furnished to do so. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY "
     "OF ANY KIND", "mit-0", ("furnished to do so the software is provided",), False),
    ("Unless required by applicable law or agreed to in writing, software distributed under the License is "
     "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND", "apache-2", (), False),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met", "bsd", (), True),
    ("in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE "
     "COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS", "bsd-2", ("with the distribution this software is provided",), False),
    ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
     "products derived from this software", "bsd-3", ("may be used to endorse or promote products",), False),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     f"General Public {_GNU}", "gpl", ("the GNU General Public License",), True),
    (f"the terms of the GNU General Public {_GNU}, either version 2 of the License", "gpl-2",
     ("the GNU General Public License", "version 2 of the License"), False),
    (f"the terms of the GNU General Public {_GNU}, either version 3 of the License", "gpl-3",
     ("the GNU General Public License", "version 3 of the License"), False),
    (f"the terms of the GNU Lesser General Public {_GNU}", "lgpl", ("the GNU Lesser General Public License",), False),
    (f"the terms of the GNU Affero General Public {_GNU}", "agpl", ("the GNU Affero General Public License",), False),
    ("This Source Code Form is subject to the terms of the Mozilla Public License", "mpl-2", (), False),
    ("made available under the terms of the Eclipse Public License", "epl", ("the Eclipse Public License",), False),
    (_GRANTED, "isc", (), True),
    ("with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear "
     "in all copies", "isc", ("granted provided that the above copyright notice",), False),
    ("with or without fee is hereby granted. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES",
     "0bsd", ("hereby granted the software is provided",), False),
    (f"{_CC} NonCommercial", "cc-by-nc", ("Commons Attribution NonCommercial",), False),
    (f"{_CC} ShareAlike", "cc-by-sa", ("Commons Attribution ShareAlike",), False),
    (f"{_CC} NoDerivatives", "cc-by-nd", ("Commons Attribution NoDerivatives",), False),
    (f"{_CC} NonCommercial ShareAlike", "cc-by-nc-sa", ("Attribution NonCommercial ShareAlike",), False),
    (f"{_CC} NonCommercial NoDerivatives", "cc-by-nc-nd", ("Attribution NonCommercial NoDerivatives",), False),
    (_CC, "cc-by", (), False),
    ("has waived all copyright and related or neighboring rights", "cc0", (), False),
    ("All rights reserved. No part of this publication may be reproduced", "all-rights-reserved", (), False),
    ("This is free and unencumbered software released into the public domain", "unlicense", (), False),
]
#: The labels of families that have general passages, by family.
FAMILIES = {"mit": ("mit", "mit-0"), "bsd": ("bsd", "bsd-2", "bsd-3"), "gnu": ("gpl", "gpl-2", "gpl-3", "lgpl", "agpl"),
            "isc": ("isc", "0bsd")}


def words_of(text: Column) -> Column:
    """Runs of ASCII letters, digits and non-ASCII characters, with A-Z lowered.

    The two characters outside ASCII whose lower case is inside become another one first.
    """
    plain = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u00e9")),
                      F.lit("\u0130"), F.lit("\u00e9"))
    return F.array_remove(F.split(F.lower(plain), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def runs_of(words: Column) -> Column:
    """All K words in a row, as an array of structs in their order."""
    count = F.greatest(F.size(words) - (K - 1), F.lit(0))
    zipped = F.arrays_zip(*(F.slice(words, F.lit(i + 1), count) for i in range(K)))
    return zipped.cast("array<struct<" + ",".join(f"w{i}:string" for i in range(K)) + ">>")


def template_words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def runs_in(text: str, size: int) -> list[tuple[str, ...]]:
    words = template_words(text)
    return [tuple(words[i:i + size]) for i in range(len(words) - size + 1)]


def passage(given: tuple) -> tuple:
    """(text, label, telling words, general) of a passage, of which the last two may be left out."""
    return (*given, *((), False)[len(given) - 2:])


def family_of(label: str) -> str:
    return next((family for family, labels in FAMILIES.items() if label in labels), label)


def template_runs(spark, phrases=PHRASES, passages=PASSAGES) -> DataFrame:
    """(template, label, family, phrase, general, runs, musts, at, own, must, telling, k0.., code) for every run of
    every template.

    own: no template of another label has the run; telling: the template has such a run; must: the run is of
    telling words, of which the template has `musts`."""
    templates = [(True, text, label, (), False) for text, label in phrases] + [(False, *passage(p)) for p in passages]
    rows = []
    for number, (phrase, text, label, words, general) in enumerate(templates):
        runs = runs_in(text, K)
        if not runs:
            raise ValueError(f"a template needs {K} words: {text}")
        others = {run for _, t, name, *_ in templates if name != label for run in runs_in(t, K)}
        musts = {run for w in words for run in runs_in(w, K)}
        if not musts <= set(runs):
            raise ValueError(f"telling words are not in the template: {text}")
        own, must = [run not in others for run in runs], [run in musts for run in runs]
        rows += [(number, label, family_of(label), phrase, general, len(runs), sum(must), i, own[i], must[i], any(own), *run)
                 for i, run in enumerate(runs)]
    names = ", ".join(f"k{i} string" for i in range(K))
    table = spark.createDataFrame(
        rows, "template int, label string, family string, phrase boolean, general boolean, runs int, musts int, at int, "
              f"own boolean, must boolean, telling boolean, {names}")
    return table.withColumn("code", F.xxhash64(*(f"k{i}" for i in range(K))))


ABOUT = ("template", "label", "family", "phrase", "general", "runs", "musts", "telling")


def votes(docs: DataFrame, templates: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row for each document, with a null `at`, and one for each match of a run."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"),
                       words_of(F.col(text).cast("string")).alias("words"))
    # The row that stands for the document goes through the join like a run without words.
    nothing = F.struct(*(F.lit(None).cast("string").alias(f"w{i}") for i in range(K)))
    single = rows.select(
        "row", "doc_id", F.size("words").cast("long").alias("n_words"),
        F.posexplode(F.concat(F.array(nothing), runs_of(F.col("words")))).alias("place", "run"))
    coded = single.select("row", "doc_id", "n_words", (F.col("place") - 1).cast("long").alias("place"), "run",
                          F.when(F.col("place") > 0, F.xxhash64(*(F.col(f"run.w{i}") for i in range(K)))).alias("code"))
    same = coded["code"] == templates["code"]
    for i in range(K):
        same &= F.col(f"run.w{i}") == F.col(f"k{i}")
    joined = coded.join(F.broadcast(templates), same, "left")
    return joined.where(F.col("at").isNotNull() | (F.col("place") < 0)).select(
        "row", "doc_id", "n_words", "place", *ABOUT, "at", "own", "must")


def spans(found: DataFrame) -> DataFrame:
    """(row, template, label, family, phrase, general, share, told, first_word, last_word) of every span, verified or not.

    told: it has all telling words, or else a run that tells the template from those of other labels; a template
    with neither is whole."""
    voted = found.where("at IS NOT NULL").withColumn("diagonal", F.col("place") - F.col("at"))
    phrases = voted.where("phrase").groupBy("row", *ABOUT, "diagonal").agg(
        F.count("*").alias("hit"), F.lit(0).alias("must_hit"), F.max("own").alias("own"),
        F.min("place").alias("first_word"), F.max("place").alias("last"))
    # A word run that stands several times in the template votes for several diagonals: the one with company stays.
    around = Window.partitionBy("row", "template").orderBy("diagonal").rangeBetween(-DRIFT, DRIFT)
    best = Window.partitionBy("row", "template", "place").orderBy(F.desc("company"), "at")
    single = voted.where("NOT phrase").withColumn("company", F.count("*").over(around)).withColumn(
        "nth", F.row_number().over(best)).where("nth = 1")
    order = Window.partitionBy("row", "template").orderBy("place")
    near = ((F.col("place") - F.lag("place").over(order) <= GAP)
            & (F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) <= DRIFT))
    marked = single.withColumn("new", F.when(F.coalesce(near, F.lit(False)), 0).otherwise(1))
    numbered = marked.withColumn("span", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    passages = numbered.groupBy("row", *ABOUT, "span").agg(
        F.count_distinct("at").alias("hit"), F.count_distinct(F.when(F.col("must"), F.col("at"))).alias("must_hit"),
        F.max("own").alias("own"), F.min("place").alias("first_word"), F.max("place").alias("last"))
    whole = F.col("hit") == F.col("runs")
    return phrases.drop("diagonal").unionByName(passages.drop("span")).select(
        "row", "template", "label", "family", "phrase", "general", (F.col("hit") / F.col("runs")).alias("share"),
        F.when(F.col("musts") > 0, F.col("must_hit") == F.col("musts")).when(F.col("telling"), F.col("own")).otherwise(
            whole).alias("told"), "first_word", (F.col("last") + K - 1).alias("last_word"))


def held_passages(spark, phrases=PHRASES, passages=PASSAGES) -> DataFrame:
    """(template, holder): passages and those of another label that hold all their words."""
    known = [(len(phrases) + i, *passage(p)[:2]) for i, p in enumerate(passages)]
    pairs = [(i, j) for i, t, a in known for j, h, b in known
             if a != b and len(t_words := template_words(t)) < len(template_words(h))
             and tuple(t_words) in runs_in(h, len(t_words))]
    return spark.createDataFrame(pairs, "template int, holder int")


def without_general(sure: DataFrame) -> DataFrame:
    """sure without general passages where others of their family say another label."""
    said = F.collect_set(F.when(~F.col("general") & ~F.col("phrase"), F.col("label"))).over(Window.partitionBy("row", "family"))
    return sure.withColumn("said", said).where(
        ~F.col("general") | (F.size("said") == 0) | F.array_contains("said", F.col("label"))).drop("said")


def without_held(sure: DataFrame, held: DataFrame) -> DataFrame:
    """sure without the spans of passages that lie in a span of a passage that holds them."""
    over = sure.where("NOT phrase").select(
        F.col("row"), F.col("template").alias("holder"), F.col("first_word").alias("from"), F.col("last_word").alias("to")
    ).join(F.broadcast(held), "holder").select(
        F.col("row").alias("over_row"), F.col("template").alias("over_template"), "from", "to")
    return sure.join(over, (F.col("row") == F.col("over_row")) & (F.col("template") == F.col("over_template"))
                     & ~F.col("phrase") & (F.col("first_word") <= F.col("to")) & (F.col("last_word") >= F.col("from")), "left_anti")


def scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", phrases=PHRASES, passages=PASSAGES,
         verified: float = VERIFIED) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word (of phrases), base_labels, labels, score.

    first_word and last_word are the smallest and largest start of a phrase. The score is the
    largest verified share of a template, 0 without one.
    """
    spark = docs.sparkSession
    found = stored(votes(docs, template_runs(spark, phrases, passages), doc_id, text), "votes")
    sure = spans(found).where(F.when(F.col("phrase"), F.col("share") == 1.0).otherwise(
        (F.col("share") >= verified) & F.col("told")))
    sure = without_general(without_held(sure, held_passages(spark, phrases, passages)))
    named = lambda where: F.array_join(F.array_sort(F.collect_set(F.when(where, F.col("label")))), ",")
    base = F.col("phrase")
    by_row = sure.groupBy("row").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("first_word"))).alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).alias("last_word"), named(base).alias("base_labels"),
        named(F.lit(True)).alias("labels"), F.max("share").alias("score"))
    return found.where("at IS NULL").select("row", "doc_id", "n_words").join(by_row, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))

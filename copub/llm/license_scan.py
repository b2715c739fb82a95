"""License phrases found by diagonal voting, with DataFrame functions only.

Every template (a phrase or notice) is a list of words.  All rolling word k-grams of the texts
are joined by hash to the templates' positions, k being 3, or a shorter template's length.  A gram at word
``i`` of a text that stands at position ``j`` of a template votes for the diagonal ``i - j``;
votes are kept only where the words themselves agree.  Votes are aggregated by
diagonal, as a set of template positions (bits of a long).

- An exact template is found where one diagonal has all its positions.
- Other templates may have words changed, added or left out, which moves the rest of the notice to
  a neighbouring diagonal: diagonals that follow each other within ``REACH`` are merged, and the
  merged span is verified: it must hold ``SHARE`` of the template's positions, and be no longer than
  the template and a half.

Templates are few and of bounded length (checked), so their table is broadcast.  Texts are read
once: votes and one marker row per document are written and then shuffled by a row number.  All that is gathered
for one key are the votes of one document.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tables
from .decontaminate import words

GRAM = 3
REACH = 3  # words by which a following diagonal may lie further
SHARE = 0.75  # of a template's positions, for templates that need not match exactly
MOST_TEMPLATES = 10_000  # broadcast bound: as many templates of 64 grams or less

# Fixed values: (phrase, label) that must match word for word.
EXACT = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
# Opening words of well-known notices and their labels.
NOTICES = [
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl-notice"),
    ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", "lgpl-notice"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


PLACE = "struct<template:int,label:string,exact:boolean,n:int,length:int,j:int>"


def positions(spark: SparkSession, exact: list[tuple[str, str]], notices: list[tuple[str, str]]) -> dict[int, DataFrame]:
    """By gram length: (gram, places), the places being structs of a template and a position in it."""
    if len(exact) + len(notices) > MOST_TEMPLATES:
        raise ValueError(f"at most {MOST_TEMPLATES} templates")
    found: dict[int, dict[str, list]] = {}
    for number, (phrase, label) in enumerate([*exact, *notices]):
        w = _WORD.findall(phrase.translate(_LOWER))
        k = min(GRAM, len(w))
        n = len(w) - k + 1
        if not w or n > 64:
            raise ValueError(f"a template has 1 to {64 + GRAM - 1} words: {phrase!r}")
        for j in range(n):
            place = {"template": number, "label": label, "exact": number < len(exact), "n": n, "length": len(w), "j": j}
            found.setdefault(k, {}).setdefault(" ".join(w[j : j + k]), []).append(place)
    kind = f"array<struct<gram:string,places:array<{PLACE}>>>"
    by_length = {}
    for k, grams in found.items():
        text = json.dumps([{"gram": gram, "places": places} for gram, places in grams.items()])
        by_length[k] = spark.range(1).select(F.inline(F.from_json(F.lit(text), kind)))
    return by_length


def votes(docs: DataFrame, exact: list[tuple[str, str]], notices: list[tuple[str, str]]) -> DataFrame:
    """(row, doc_id, n_words, i, place): the grams that agree with a template, and a marker (i = -1) per row."""
    grams = positions(docs.sparkSession, exact, notices)
    longest = max(grams, default=1)
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), words(F.col("text")).alias("w"))
    ahead = [F.slice("w", i + 1, F.greatest(F.size("w") - i, F.lit(0))).alias(f"w{i}") for i in range(longest)]
    # one element more than words: the marker
    padded = F.arrays_zip(F.sequence(F.lit(-1), F.size("w") - 1).alias("i"), *(F.concat(F.array(F.lit(None).cast("string")), a).alias(f"w{i}") for i, a in enumerate(ahead)))
    spots = base.select("row", "doc_id", F.size("w").cast("long").alias("n_words"), F.explode(padded).alias("s")).select("row", "doc_id", "n_words", "s.*")
    found = []
    for k, table in sorted(grams.items()):
        whole = F.col(f"w{k - 1}").isNotNull()  # else the text ends inside the gram
        parts = F.split("gram", " ")
        named = table.select(F.xxhash64(*(parts[i] for i in range(k))).alias(f"hash{k}"), F.col("gram").alias(f"gram{k}"), F.col("places").alias(f"places{k}"))
        hashed = F.when(whole, F.xxhash64(*(f"w{i}" for i in range(k))))
        spots = spots.withColumn(f"hash{k}", hashed).join(F.broadcast(named), f"hash{k}", "left")
        found.append(F.when(F.col(f"gram{k}") == F.concat_ws(" ", *(f"w{i}" for i in range(k))), F.col(f"places{k}")))
    none = F.array().cast(f"array<{PLACE}>")
    places = F.concat(none, *(F.coalesce(f, none) for f in found))
    kept = spots.where(" or ".join(["i = -1", *(f"places{k} is not null" for k in grams)]))
    return kept.select("row", "doc_id", "n_words", "i", F.explode_outer(places).alias("place")).where("i = -1 or place is not null")


def spans(voted: DataFrame, share: float = SHARE, reach: int = REACH) -> DataFrame:
    """(row, label, exact, start, stop, share): verified places of templates, words [start, stop).

    ``share`` is the part of the template's positions that the place holds.
    """
    on = voted.where("place is not null").select("row", "place.*", "i", (F.col("i") - F.col("j")).alias("diagonal"))
    bits = F.bit_or(F.expr("shiftleft(1L, j)")).alias("bits")
    keys = ["row", "template", "label", "exact", "n", "length"]
    # the words of a vote's gram: shorter templates have shorter grams
    gram = F.col("length") - F.col("n") + 1
    lines = on.groupBy(*keys, "diagonal").agg(bits, F.min("i").alias("low"), F.max(F.col("i") + gram).alias("high"))
    whole = lines.where(F.col("exact") & (F.bit_count("bits") == F.col("n")))
    whole = whole.select("row", "label", "exact", F.col("low").alias("start"), F.col("high").alias("stop"), F.lit(1.0).alias("share"))
    by_diagonal = Window.partitionBy("row", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(by_diagonal)
    begins = F.when(gap.isNull() | (gap > reach), 1).otherwise(0)
    marked = lines.where(~F.col("exact")).withColumn("begins", begins)
    marked = marked.withColumn("group", F.sum("begins").over(by_diagonal))
    merged = marked.groupBy(*keys, "group").agg(F.bit_or("bits").alias("bits"), F.min("low").alias("start"), F.max("high").alias("stop"))
    held = (F.bit_count("bits") / F.col("n")).alias("share")
    near = merged.where((F.bit_count("bits") >= F.lit(share) * F.col("n")) & (F.col("stop") - F.col("start") <= F.col("length") * 1.5))
    return whole.unionByName(near.select("row", "label", "exact", "start", "stop", held))


def scan(
    docs: DataFrame, exact: list[tuple[str, str]] = EXACT, notices: list[tuple[str, str]] = NOTICES, share: float = SHARE, reach: int = REACH
) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, places, score.

    Words are those of the lower-cased text, cut at ASCII other than letters and digits.
    ``n_base`` counts the places of the exact phrases, overlapping ones too; ``first_word`` and
    ``last_word`` are their smallest and largest start (null: none).  ``base_labels`` and ``labels`` (the notices' too)
    are distinct, sorted and joined by commas.  ``places`` has label, start, stop and share of every
    verified place, sorted.  ``score`` is the largest share of a place, 0 without one.  Null
    and wordless texts have no words and no places.  Repeated rows and rows without id each give
    a row; an empty table gives none.  Columns other than doc_id and text are ignored.
    """
    # read twice below: the markers, and the votes
    voted = tables.written(votes(docs, exact, notices), "license-votes")
    marks = voted.where("i = -1").select("row", "doc_id", "n_words", F.lit(None).cast("struct<label:string,start:int,stop:int,share:double>").alias("place"), F.lit(False).alias("exact"))
    placed = spans(voted, share, reach).select(
        "row", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_words"), F.struct("label", "start", "stop", "share").alias("place"), "exact"
    )
    start, label = F.col("place.start").cast("long"), F.col("place.label")
    base = F.col("exact")

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(labels)), ",")

    return (
        marks.unionByName(placed)
        .groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.count_if(base).alias("n_base"),
            F.min(F.when(base, start)).alias("first_word"), F.max(F.when(base, start)).alias("last_word"),
            joined(F.when(base, label)).alias("base_labels"), joined(label).alias("labels"),
            F.array_sort(F.collect_list("place")).alias("places"), F.coalesce(F.max("place.share"), F.lit(0.0)).alias("score"),
        )
        .drop("row")
    )

"""License scan by diagonal voting, in DataFrame functions only.

Every rolling word 2-gram of a text is joined by hash to the positions that the gram has in the templates (notices and phrases). A hit
votes for the diagonal `position in the text - position in the template`. Neighbouring diagonals of a template, which insertions and
deletions cause, are merged into one candidate span, and a span is verified: its hits are equal in words, not only by hash, and they
must cover enough of the template within a stretch that isn't much longer than it. Two words is the gram that also finds the shortest
phrase; the templates are a fixed table of a few hundred rows, which is what makes the broadcast safe.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The base phrases of the contract and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Notices by label; whole phrases of common licences.
NOTICES = [
    ("lgpl", "GNU Lesser General Public License"),
    ("agpl", "GNU Affero General Public License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "GPL-3.0-or-later"),
    ("gpl", "GPL-2.0-only"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License"),
    ("apache", "Apache-2.0"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "Released under the MIT License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "BSD License"),
    ("bsd", "BSD-3-Clause"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("mpl", "Mozilla Public License"),
    ("epl", "Eclipse Public License"),
    ("cc-by-nc", "CC BY-NC"),
    ("cc-by-sa", "CC BY-SA"),
    ("cc-by-nd", "CC BY-ND"),
    ("cc-by", "Creative Commons Attribution"),
    ("cc0", "CC0 1.0 Universal"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("proprietary", "All rights reserved"),
]
#: Share of a notice's words that hits must cover; steps between diagonals that still merge; a span's length over the notice's.
COVER, STEP, STRETCH = 0.8, 2, 1.3
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-case words of a text: runs of letters, digits and characters beyond ASCII.

    Beyond A to Z, `lower` never makes or removes a separator, and the one foreign letter that it turns into a letter of A to Z alone is the sign of the kelvin,
    which no phrase or notice without a k is touched by; it takes half the time of a translation of A to Z.
    """
    return F.filter(F.split(F.lower(text), _SEPARATORS), lambda w: w != "")


def grams(w: Column) -> Column:
    """Rolling 2-grams, and one empty gram ahead of them that keeps a row for a text without any hit."""
    runs = F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.concat(F.get(w, i), F.lit(" "), F.get(w, i + 1)))
    return F.concat(F.array(F.lit("")), F.when(F.size(w) >= 2, runs).otherwise(F.array().cast("array<string>")))


def templates(spark: SparkSession, notices=None, base=None) -> DataFrame:
    """(template, label, is_base, size, t_pos, t_gram, hash): a row for each gram of each template, and template -1 for the empty gram."""
    base = BASE if base is None else base
    rows = [(-1, None, False, 0, -1, "")]
    listed = [(label, text, True) for text, label in base.items()] + [(label, text, False) for label, text in (NOTICES if notices is None else notices)]
    for k, (label, text, is_base) in enumerate(listed):
        w = [x for x in re.split(_SEPARATORS, text.lower()) if x]
        rows += [(k, label, is_base, len(w), i, f"{w[i]} {w[i + 1]}") for i in range(len(w) - 1)]
    fields = ["template", "label", "is_base", "size", "t_pos", "t_gram"]
    literal = F.array(*[F.struct(*[F.lit(x).alias(name) if x is not None else F.lit(None).cast("string").alias(name) for name, x in zip(fields, row, strict=True)]) for row in rows])
    return spark.range(1).select(F.inline(literal)).withColumn("hash", F.xxhash64("t_gram"))  # constants of the plan


def spans(docs: DataFrame, notices=None, base=None) -> DataFrame:
    """(row_id, doc_id, n_words, template, label, is_base, first_word, last_word, cover) of every verified span; template -1 once for every row of docs.

    row_id tells repeated ids apart. Null texts have no words.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.monotonically_increasing_id().alias("row_id"), words(F.col("text")).alias("w"))
    rows = rows.select("doc_id", "row_id", F.size("w").alias("n_words"), F.posexplode(grams(F.col("w"))).alias("d_pos", "gram")).withColumn("hash", F.xxhash64("gram"))
    known = F.broadcast(templates(docs.sparkSession, notices, base))
    hits = rows.join(known, (rows["hash"] == known["hash"]) & (rows["gram"] == known["t_gram"])).select("doc_id", "row_id", "n_words", "template", "label", "is_base", "size", "t_pos", (F.col("d_pos") - 1 - F.col("t_pos")).alias("diagonal"))
    key = ["row_id", "doc_id", "n_words", "template", "label", "is_base", "size"]
    votes = hits.groupBy(*key, "diagonal").agg(F.collect_set("t_pos").alias("seen"), F.min("t_pos").alias("lo"), F.max("t_pos").alias("hi"))
    # a base phrase must stand in full on one diagonal; other templates merge neighbouring diagonals whose hits follow one another
    order = Window.partitionBy("row_id", "template").orderBy("diagonal")
    start, end = F.col("diagonal") + F.col("lo"), F.col("diagonal") + F.col("hi") + 1
    apart = F.col("is_base") | (F.col("diagonal") - F.lag("diagonal").over(order) > STEP) | (start > F.lag(end).over(order) + F.col("size"))
    votes = votes.withColumn("cluster", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    # of a cluster that is too wide, each diagonal with those so near above it that together they can't be: a full diagonal among them
    extra = F.floor(F.col("size") * (STRETCH - 1)).cast("int")
    longest = max((len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)) for _, text in (NOTICES if notices is None else notices)), default=0)
    near = Window.partitionBy("row_id", "template").orderBy("diagonal").rangeBetween(0, int(longest * (STRETCH - 1)))
    vote = F.struct("diagonal", "cluster", "seen", start.alias("first_word"), end.alias("last_word"))
    votes = votes.withColumn("run", F.filter(F.collect_list(vote).over(near), lambda v: (v["cluster"] == F.col("cluster")) & (v["diagonal"] <= F.col("diagonal") + extra)))

    def span(found):
        seen = F.array_distinct(F.flatten(F.transform(found, lambda v: v["seen"])))
        return F.struct(seen.alias("seen"), F.array_min(F.transform(found, lambda v: v["first_word"])).alias("first_word"), F.array_max(F.transform(found, lambda v: v["last_word"])).alias("last_word"))

    merged = votes.groupBy(*key, "cluster").agg(F.array_distinct(F.flatten(F.collect_list("seen"))).alias("seen"), F.min(start).alias("first_word"), F.max(end).alias("last_word"), F.collect_list(span(F.col("run"))).alias("runs"))
    fits = (F.col("template") < 0) | F.col("is_base") | (F.col("last_word") - F.col("first_word") + 1 <= F.ceil(F.col("size") * STRETCH))
    merged = merged.withColumn("span", F.explode(F.when(fits, F.array(F.struct("seen", "first_word", "last_word"))).otherwise(F.col("runs")))).select(*key, "span.*")
    covered = F.size(F.array_union(F.col("seen"), F.transform("seen", lambda i: i + 1)))  # a gram covers two words
    merged = merged.withColumn("cover", F.when(F.col("template") >= 0, covered / F.col("size")).otherwise(0.0))
    exact = F.size("seen") == F.col("size") - 1
    wide = F.col("last_word") - F.col("first_word") + 1 <= F.ceil(F.col("size") * STRETCH)
    return merged.where((F.col("template") < 0) | F.when(F.col("is_base"), exact).otherwise((F.col("cover") >= COVER) & wide)).select("row_id", "doc_id", "n_words", "template", "label", "is_base", "first_word", "last_word", "cover")


def scan(docs: DataFrame, notices=None, base=None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row of docs.

    score is the largest share of a template that a verified span covers, 0 without one. Null and empty texts have no words, no places
    and empty label lists; repeated rows are counted apart; other columns are ignored.
    """
    at = F.when(F.col("is_base"), F.col("first_word"))
    return (
        spans(docs, notices, base).groupBy("row_id", "doc_id", "n_words")
        .agg(
            F.count(at).cast("long").alias("n_base"),
            F.min(at).cast("long").alias("first_word"),
            F.max(at).cast("long").alias("last_word"),
            F.array_join(F.array_sort(F.collect_set(F.when(F.col("is_base"), F.col("label")))), ",").alias("base_labels"),
            F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
            F.max("cover").alias("score"),
        )
        .select("doc_id", F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    )

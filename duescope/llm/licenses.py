"""License passages by diagonal voting.

Every rolling word triple of every document is joined by hash (and compared as text) with the
positions of the same triple in the templates. A hit votes for the diagonal "document position
minus template position"; a copy of a template fills one diagonal. Diagonals of a document and
template that lie next to each other (words inserted or left out) are merged, and the merged span
is verified by the share of the template's words that it covers.

Base phrases are templates too: a phrase stands wherever a diagonal has all its triples.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duescope.llm.common import WORD, row_key
from duescope.llm.textstats import spread_words
from duescope.storage import stored

K = 3  # words of a triple; no template is shorter
SLACK = 8  # words by which neighbouring diagonals may differ
GAP = 40  # words between the spans of neighbouring diagonals
MISSING, EXACT = 0.3, 2  # share of a template's words that a span may miss, less so many words: short ones must be whole

# Phrases and their labels, and wording of public licenses.
BASE = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "licensed under the GNU General Public License"),
    ("gpl-3", "GNU General Public License, version 3"),
    ("gpl-2", "GNU General Public License, version 2"),
    ("lgpl", "GNU Lesser General Public License"),
    ("agpl", "GNU Affero General Public License"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "all rights reserved"),
]


def _words(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def templates(spark: SparkSession, base: list[tuple[str, str]] = BASE, more: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Triples of the templates (ASCII texts of three words or more) with their positions.

    The table is stored, so Spark knows its size and picks the join by it: it is broadcast while
    it is under spark.sql.autoBroadcastJoinThreshold, else both sides are shuffled."""
    rows = []
    for t, (label, text) in enumerate([*base, *more]):
        w = _words(text)
        if len(w) < K or not text.isascii():
            raise ValueError(f"a template needs {K} ASCII words: {text!r}")
        rows += [(t, label, t < len(base), len(w), i, " ".join(w[i:i + K])) for i in range(len(w) - K + 1)]
    made = spark.createDataFrame(rows, "template int, label string, base boolean, size int, at int, gram string")
    return stored(made.coalesce(1).withColumn("hash", F.xxhash64("gram")))


def words(text: Column) -> Column:
    """Words of a text. All letters are lower-cased, with the one non-ASCII letter whose lower
    case is ASCII put aside: words with other letters than ASCII never match a template, and
    those of ASCII are as if A-Z alone were lower-cased."""
    lowered = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("Å")))
    return F.filter(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def hits(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """row_key, template columns, `at` and `diagonal` of every triple that stands in both."""
    rows = docs.select(row_key(docs, ["doc_id", "text"]).alias("row_key"), words(docs["text"]).alias("w"))
    triples = F.when(F.size("w") >= K, F.transform(
        F.sequence(F.lit(0), F.size("w") - K), lambda i: F.concat_ws(" ", *[F.get("w", i + k) for k in range(K)])))
    placed = rows.select("row_key", F.posexplode(triples).alias("pos", "triple"))
    t = grams.alias("t")
    joined = placed.join(t, (F.xxhash64("triple") == F.col("t.hash")) & (F.col("triple") == F.col("t.gram")))
    return joined.select("row_key", "template", "label", "base", "size", "at", (F.col("pos") - F.col("at")).alias("diagonal")).distinct()


def spans(found: DataFrame) -> DataFrame:
    """Verified spans: row_key, label, base, first, last, cover."""
    votes = found.groupBy("row_key", "template", "label", "base", "size", "diagonal").agg(
        F.count("*").alias("votes"), F.min("at").alias("lo"), F.max("at").alias("hi"), F.collect_set("at").alias("ats"))
    votes = votes.withColumns({"first": F.col("diagonal") + F.col("lo"), "last": F.col("diagonal") + F.col("hi") + (K - 1)})
    whole = votes.where(F.col("base") & (F.col("votes") == F.col("size") - (K - 1))).select(
        "row_key", "label", "base", "first", "last", F.lit(1.0).alias("cover"))
    # diagonals within SLACK of the next one are a band, whatever stray diagonals start between them
    beside = Window.partitionBy("row_key", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(beside) > SLACK
    bands = votes.where(~F.col("base")).withColumn("new", F.coalesce(apart, F.lit(True)).cast("int"))
    bands = bands.withColumn("band", F.sum("new").over(beside.rowsBetween(Window.unboundedPreceding, 0)))
    order = Window.partitionBy("row_key", "template", "band").orderBy("first", "diagonal")
    far = F.col("first") - F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1)) > GAP
    groups = bands.withColumn("new", F.coalesce(far, F.lit(True)).cast("int"))
    groups = groups.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = groups.groupBy("row_key", "template", "label", "base", "size", "band", "run").agg(
        F.min("first").alias("first"), F.max("last").alias("last"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("ats"))
    merged = merged.withColumn("covered", spread_words(F.col("ats"), K))
    verified = merged.where(F.col("size") - F.col("covered") <= F.greatest(F.lit(0), F.floor(F.col("size") * MISSING) - EXACT))
    verified = verified.select("row_key", "label", "base", "first", "last", (F.col("covered") / F.col("size")).alias("cover"))
    return whole.unionByName(verified)


def scanned(docs: DataFrame, grams: DataFrame | None = None) -> DataFrame:
    """doc_id, row_key, n_words, n_base, first_word, last_word, base_labels, labels, spans, score
    for every row of `docs` (doc_id, text).

    base_labels and labels are comma-joined, sorted and distinct; spans holds the verified spans
    in order; score is the best cover (1 for a base phrase, 0 without a span). Null and empty
    texts have no words. Repeated rows get equal results. An empty table gives an empty result.
    Other columns are ignored.
    """
    grams = templates(docs.sparkSession) if grams is None else grams
    per_text = stored(spans(hits(docs, grams))).groupBy("row_key").agg(
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.array_sort(F.collect_list(F.struct("first", "last", "label", "cover"))).alias("spans"), F.max("cover").alias("score"))
    rows = docs.select("doc_id", row_key(docs, ["doc_id", "text"]).alias("row_key"), F.size(words(docs["text"])).cast("long").alias("n_words"))
    none = {"n_base": 0, "base_labels": "", "labels": "", "score": 0.0}
    return rows.join(per_text, "row_key", "left").select(
        "doc_id", "row_key", "n_words",
        *[F.coalesce(c, F.lit(none[c])).alias(c) if c in none else F.col(c) for c in per_text.columns if c != "row_key"])

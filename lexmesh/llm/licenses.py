"""License scans by diagonal voting, in DataFrame functions only.

Rolling word k-gram hashes of all texts are joined to the places of the same k-grams in license
templates. A match at text place p and template place q votes for the diagonal p - q; diagonals up to
SLACK apart within a text and template are merged, so that a few inserted or missing words don't split
a notice, and a merged span counts when it covers at least COVERAGE of the template's words within
STRETCH times its length. Base phrases are counted at every place besides.

The templates are fixed text, those of this module or a list of the caller's, so the broadcast side is bounded
(under 1,000 k-grams here).

Nulls: a null text is empty. Rows with the same doc_id and text are one text: each gets the same result.
Rows without a doc_id are matched by their text. Empty tables give empty results; other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import NOT_ALNUM, ascii_lower, let, split_words

K, SLACK, COVERAGE, STRETCH = 4, 3, 0.7, 1.5

#: The base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices as their licenses ask to state them.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]


def _hashes(words: Column, k: int) -> Column:
    last = F.size(words) - k
    gram = lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(k)))
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), gram)).otherwise(F.array().cast("array<bigint>"))


def templates(spark: SparkSession, k: int = K, notices: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(template, label, n_template, q, gram): every k-gram place of every template, notices being (label, text)."""
    lits = F.array(*(F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(text).alias("text")) for i, (label, text) in enumerate(notices)))
    rows = spark.range(1).select(F.explode(lits).alias("t")).select("t.template", "t.label", let(split_words(ascii_lower(F.col("t.text")), NOT_ALNUM), lambda w: F.struct(F.size(w).alias("n"), _hashes(w, k).alias("h"))).alias("w"))
    return rows.select("template", "label", F.col("w.n").alias("n_template"), F.posexplode("w.h").alias("q", "gram"))


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("text_hash"), split_words(ascii_lower(text), NOT_ALNUM).alias("w"))


def spans(docs: DataFrame, k: int = K, notices: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(doc_id, text_hash, label, first_word, last_word, coverage): verified notices."""
    grams = _texts(docs).select("doc_id", "text_hash", F.posexplode(let(F.col("w"), lambda w: _hashes(w, k))).alias("p", "gram"))
    votes = grams.join(F.broadcast(templates(docs.sparkSession, k, notices)), "gram").withColumn("diagonal", F.col("p") - F.col("q"))
    text = ["doc_id", "text_hash", "template", "label", "n_template"]
    lines = votes.groupBy(*text, "diagonal").agg(F.collect_set("q").alias("q"), F.min("p").alias("lo"), F.max("p").alias("hi"))
    order = Window.partitionBy(*text).orderBy("diagonal")
    new = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > SLACK).cast("int"), F.lit(1))
    merged = lines.withColumn("new", new).withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = merged.groupBy(*text, "run").agg(F.array_distinct(F.flatten(F.collect_list("q"))).alias("q"), F.min("lo").alias("first_word"), (F.max("hi") + k - 1).alias("last_word"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("q", lambda q: F.sequence(q, q + k - 1)))))
    found = merged.withColumn("coverage", covered / F.col("n_template"))
    return found.filter((F.col("coverage") >= COVERAGE) & (F.col("last_word") - F.col("first_word") + 1 <= STRETCH * F.col("n_template"))).select("doc_id", "text_hash", "label", "first_word", "last_word", "coverage")


def _places(words: Column, phrase: str) -> Column:
    """Where the phrase's words stand; texts without its rarest word are passed over at once."""
    parts = phrase.split()
    here = lambda i: (F.get(words, i) == parts[0]) & (F.get(words, i + 1) == parts[1]) & (F.get(words, i + 2) == parts[2] if len(parts) > 2 else F.lit(True))
    last = F.size(words) - len(parts)
    all_in = F.lit(True)
    for p in parts:
        all_in = all_in & F.array_contains(words, p)
    return F.when((last >= 0) & all_in, F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), here)).otherwise(F.array().cast("array<int>"))


def scan(docs: DataFrame, k: int = K, notices: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    of_words = lambda w: F.struct(F.size(w).alias("n"), *(_places(w, p).alias(label) for p, label in PHRASES.items()))
    base = _texts(docs).select("doc_id", "text_hash", let(F.col("w"), of_words).alias("b"))
    at = F.concat(*(F.col(f"b.`{label}`") for label in PHRASES.values()))
    labels = F.array_compact(F.array(*(F.when(F.size(f"b.`{label}`") > 0, F.lit(label)) for label in PHRASES.values())))
    base = base.select("doc_id", "text_hash", F.col("b.n").cast("long").alias("n_words"), let(at, lambda x: F.struct(F.size(x).cast("long").alias("n"), F.array_min(x).cast("long").alias("lo"), F.array_max(x).cast("long").alias("hi"))).alias("at"), labels.alias("base"))
    found = spans(docs, k, notices).groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.collect_set("label").alias("more"), F.max("coverage").alias("coverage"))
    joined = base.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    every = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", F.array().cast("array<string>")))))
    return joined.select(
        "doc_id",
        "n_words",
        F.col("at.n").alias("n_base"),
        F.col("at.lo").alias("first_word"),
        F.col("at.hi").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.greatest(F.least(F.round(F.coalesce("coverage", F.lit(0.0)), 6), F.lit(1.0)), F.when(F.col("at.n") > 0, 1.0).otherwise(0.0)).alias("score"),
    )

"""License scan by diagonal voting (DataFrame operations only).

Templates are short license texts.  Every rolling word k-gram of every document
is joined to the template positions that hold it (``K`` = 2, the length of the
shortest phrase).  A match at document word i and template word j votes for the
diagonal i - j; votes are partial aggregates by (document, template, diagonal).
Each diagonal is merged with its neighbours (words put in: up to a slack of
``GAP`` plus a tenth of the template's k-grams) and verified: together they must
hold at least ``COVER`` of the template's k-grams.  All votes of such a band lie
within the template's length plus the slack, and every band of that width is
looked at, so repeats of the template's own words beside it hide nothing.  The
words are compared at the join, so no hash is trusted.

Base phrases are templates as well; a phrase stands where one diagonal has all
of its votes.

Defined cases: null or word-free texts have no words and no labels (empty
strings, score 0); repeated rows each get their row; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import row_key, stage, table
from .words import gram_hashes, words

K = 2
GAP = 2
COVER = 0.8
BROADCAST_ROWS = 100_000       # template k-grams; more are joined by a shuffle

# Phrases that the base labels stand for.
BASE = [
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
]

# Opening words of public license texts and notices.
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("creative-commons", "this work is licensed under a creative commons attribution"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
]


def template_grams(spark: SparkSession, base=None, templates=None) -> DataFrame:
    """(tid, label, base, grams, at, hash, first, second): the k-grams of the
    templates with their positions; ``grams`` is the template's number of them."""
    rows = [(label, text, True) for label, text in (BASE if base is None else base)]
    rows += [(label, text, False) for label, text in (TEMPLATES if templates is None else templates)]
    t = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "tid int, label string, text string, base boolean")
    t = t.select("tid", "label", "base", words("text").alias("w"))
    grams = F.slice(gram_hashes("w", K), F.lit(1), F.size("w") - (K - 1))
    t = t.select("tid", "label", "base", "w", (F.size("w") - (K - 1)).alias("grams"), F.posexplode_outer(grams).alias("at", "hash"))
    return t.select("tid", "label", "base", "grams", "at", "hash", F.slice("w", F.col("at") + 1, K).alias("gram"))


def spans(docs: DataFrame, grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, found): one row (id, key, n_words) per document row, and the verified
    spans (id, key, label, base, start, stop, score), one per document content."""
    text = row_key(docs).select("id", "key", words("text").alias("w"))
    text = text.select("id", "key", "w", gram_hashes("w", K).alias("grams_of_doc"))
    own = F.array(F.lit(None).cast("long"))
    spread = (text.select("id", "key", "w", F.posexplode_outer(F.concat(own, F.col("grams_of_doc"))).alias("pos", "hash"))
              .withColumn("pos", F.col("pos") - 1))
    grams = stage(grams, "templates")
    table_ = F.broadcast(grams) if grams.count() <= BROADCAST_ROWS else grams
    match = (spread.join(table_, "hash", "left")
             .filter((F.col("pos") == -1) | (F.slice("w", F.greatest("pos", F.lit(0)) + 1, K) == F.col("gram")))
             .select("id", "key", F.size("w").cast("long").alias("n_words"), "pos", "tid", "at"))
    match = stage(match, "votes")
    votes = (match.filter("tid is not null").groupBy("id", "key", "tid", (F.col("pos") - F.col("at")).alias("diagonal"))
             .agg(F.collect_set("at").alias("at")))
    votes = votes.join(F.broadcast(grams.select("tid", "label", "base", "grams").distinct()), "tid")
    phrase = (votes.filter(F.col("base") & (F.size("at") == F.col("grams")))
              .select("id", "key", "label", "base", F.col("diagonal").alias("start"),
                      (F.col("diagonal") + F.col("grams") + K - 1).alias("stop"), F.lit(1.0).alias("score")))

    # a diagonal and its neighbours up to the template's slack: votes of all of them
    slack = GAP + F.floor(F.col("grams") / 10).cast("int")
    longest = grams.filter(~F.col("base")).agg(F.max("grams")).first()[0] or 0
    near = Window.partitionBy("id", "key", "tid").orderBy("diagonal").rangeBetween(0, GAP + longest // 10)
    band = F.filter(F.collect_list(F.struct("diagonal", "at")).over(near), lambda x: x["diagonal"] - F.col("diagonal") <= F.col("slack"))
    merged = (votes.filter(~F.col("base")).withColumn("slack", slack).withColumn("band", band)
              .withColumn("held", F.size(F.array_distinct(F.flatten(F.transform("band", lambda x: x["at"]))))))
    score = F.col("held") / F.col("grams")
    ends = F.transform("band", lambda x: x["diagonal"] + F.array_max(x["at"]) + K)
    starts = F.transform("band", lambda x: x["diagonal"] + F.array_min(x["at"]))
    longer = (merged.filter(score >= COVER).select("id", "key", "label", "base", F.array_min(starts).alias("start"),
                                                   F.array_max(ends).alias("stop"), score.alias("score")))
    rows = match.filter("pos = -1").select("id", "key", "n_words")
    return rows, phrase.unionByName(longer)


def scan(docs: DataFrame, grams: DataFrame | None = None) -> DataFrame:
    """One row per document row: (id, key, n_words, n_base, first_word, last_word,
    base_labels, labels, score)."""
    rows, found = spans(docs, template_grams(docs.sparkSession) if grams is None else grams)
    start = F.when(F.col("base"), F.col("start").cast("long"))
    label = F.when(F.col("base"), F.col("label"))
    marks = found.groupBy(F.col("id").alias("_i"), F.col("key").alias("_k")).agg(
        F.count(start).alias("n_base"), F.min(start).alias("first_word"), F.max(start).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(label)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("score").alias("score"))
    return (rows.join(marks, F.col("id").eqNullSafe(F.col("_i")) & (F.col("key") == F.col("_k")), "left").drop("_i", "_k")
            .fillna({"n_base": 0, "base_labels": "", "labels": "", "score": 0.0}))


def q_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id").drop("key")


QUERIES = {"op7_license_scan": q_license_scan}
ORACLES: dict = {}

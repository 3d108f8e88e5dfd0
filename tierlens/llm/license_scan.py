"""Operator 8, license scans by diagonal voting: all rolling word k-gram hashes of the documents are joined
to the positions of the same k-grams in license templates, votes are counted by offset diagonal (document
position minus template position), neighbouring diagonals are merged, and each merged span is verified.

Short phrases use 2-grams and must match whole on one diagonal; long notices use 5-grams, may shift by up
to ``SLACK`` words between diagonals (an inserted or lost word) and count when their verified k-grams cover
``MIN_COVER`` of the template. The template table is a constant of this module, so its broadcast is bounded.
Hashing, join and word comparison run in one span over each document's words; only hits are shuffled.

Defined results: null or empty text has no words, no places, empty labels, null first and last word and
score 0; repeated rows repeat their result; extra columns are ignored; places may overlap and all count.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import alnum_words, cut, row_key

SLACK, MIN_COVER, SHORT_K, LONG_K = 3, 0.6, 2, 5

# The contract's phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
# Phrases and opening sentences of public license notices.
NOTICES = (
    ("bsd license", "bsd"),
    ("mozilla public license", "mpl"),
    ("lesser general public license", "lgpl"),
    ("affero general public license", "agpl"),
    ("licensed under cc by", "cc-by"),
    ("licensed under cc by nc", "cc-by-nc"),
    ("creative commons attribution", "cc-by"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "mit"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
)


def template_grams(spark: SparkSession, base=BASE, notices=NOTICES) -> DataFrame:
    """(tpl, label, is_base, k, n_grams, tpos, gram): the rolling k-grams of every template."""
    rows = []
    for tpl, (text, label) in enumerate([*base, *notices]):
        w = re.findall(r"[a-z0-9]+", text.lower())
        k = SHORT_K if len(w) < 8 else LONG_K
        rows += [(tpl, label, tpl < len(base), k, len(w) - k + 1, i, " ".join(w[i : i + k])) for i in range(len(w) - k + 1)]
    return spark.createDataFrame(rows, "tpl int, label string, is_base boolean, k int, n_grams int, tpos int, gram string")


def votes(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """(doc_id, rk, tpl, label, is_base, k, n_grams, tpos, pos): every k-gram place a document shares with a template.

    Every k-gram begins with a 2-gram, so one rolling hash of two words at each place finds candidates of any k,
    and the whole k-gram is compared word by word."""
    lead = lambda a, b: F.xxhash64(a, F.coalesce(b, F.lit("")))
    parts = F.split("gram", " ")
    grams = grams.withColumn("h", lead(F.get(parts, F.lit(0)), F.get(parts, F.lit(1))))
    base = docs.select("doc_id", row_key(F.col("text")).alias("rk"), alnum_words(F.col("text")).alias("ws"))
    # outer: else Spark adds a filter on the array's size and splits each text twice
    at = base.select("doc_id", "rk", "ws", F.posexplode_outer("ws").alias("pos", "w"))
    at = at.withColumn("h", lead(F.col("w"), F.get("ws", F.col("pos") + 1)))
    same = F.array_join(F.slice("ws", F.col("pos") + 1, F.col("k")), " ") == F.col("gram")
    hit = at.join(F.broadcast(grams), "h").filter(same & F.col("w").isNotNull())
    return hit.select("doc_id", "rk", "tpl", "label", "is_base", "k", "n_grams", "tpos", "pos")


def spans(votes_: DataFrame) -> DataFrame:
    """(doc_id, rk, tpl, label, is_base, start, end, cover): spans that pass verification."""
    keys = ["doc_id", "rk", "tpl", "label", "is_base", "k", "n_grams"]
    diag = votes_.withColumn("diag", F.col("pos") - F.col("tpos")).groupBy(*keys, "diag").agg(F.collect_set("tpos").alias("tposes"), F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    by = Window.partitionBy("doc_id", "rk", "tpl").orderBy("diag")
    slack = F.when(F.col("k") == LONG_K, F.lit(SLACK)).otherwise(F.lit(0))
    far = F.col("diag") - F.lag("diag").over(by) > slack
    diag = diag.withColumn("run", F.sum(F.when(far | F.lag("diag").over(by).isNull(), 1).otherwise(0)).over(by))
    merged = diag.groupBy(*keys, "run").agg(F.size(F.array_distinct(F.flatten(F.collect_list("tposes")))).alias("n"), F.min("diag").alias("first"), F.min("lo").alias("start"), (F.max("hi") + F.col("k")).alias("end"))
    merged = merged.withColumn("cover", F.col("n") / F.col("n_grams"))
    need = F.when(F.col("k") == LONG_K, F.lit(MIN_COVER)).otherwise(F.lit(1.0))
    return merged.filter(F.col("cover") >= need).select("doc_id", "rk", "tpl", "label", "is_base", "start", "end", "cover")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: words, base places and their first and last start, labels and score."""
    found = cut(spans(votes(docs, template_grams(docs.sparkSession))), "spans")
    base = F.col("is_base")
    per = found.groupBy(F.col("doc_id").alias("_d"), F.col("rk").alias("_k"), "tpl", "label", "is_base", "start", "end").agg(F.max("cover").alias("cover"))
    per = per.groupBy("_d", "_k").agg(
        F.sum(base.cast("long")).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("cover").alias("score"),
    )
    out = docs.select("doc_id", row_key(F.col("text")).alias("rk"), F.size(alnum_words(F.col("text"))).cast("long").alias("n_words"))
    out = out.join(per, F.expr("doc_id <=> _d and rk = _k"), "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )

"""License scans by diagonal voting.

All rolling word pairs of the documents are hash-joined to the pairs of license
templates.  A hit at word ``i`` of the document and word ``t`` of the template votes
for the diagonal ``i - t``.  Full votes on one diagonal are a place of the whole
template.  For longer notices, neighbouring diagonals (words put in or left out, in one
place or several) are merged, as many as a verified stretch may span, from every diagonal
on.  A merged stretch is verified: the share of the template's pairs found in it, over a
stretch not much longer than the template.  Of verified stretches that overlap, such as
notices that differ in the version alone, the best stay: by falling share, a stretch stays
unless it overlaps a better one that stayed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from surgewatch.llm.common import ascii_lower, cut

K = 2
#: Least verified similarity; longest stretch per pair of the template.
SIMILARITY, STRETCH = 0.8, 1.5
DELIMITERS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Base phrases and their labels (fixed values).
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices and the labels that the diagonals add (fixed texts of public licenses).
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache-2.0",
    "licensed under the gnu general public license version 2": "gpl-2.0",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
    "public license as published by the free software foundation": "gpl-notice",
    "released under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files": "mit-text",
    "redistribution and use in source and binary forms with or without modification are permitted provided that "
    "the following conditions are met": "bsd",
    "licensed under cc by 4 0": "cc-by-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by nd 4 0": "cc-by-nd-4.0",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
}


def template_pairs(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """``(template, label, base, t, gram, n)``: the word pairs of each template; each has K words or more."""
    rows = [(k, label, k < len(phrases), t, " ".join(ws[t:t + K]), len(ws) - K + 1)
            for k, (text, label) in enumerate([*phrases.items(), *notices.items()])
            for ws in [text.split()] for t in range(len(ws) - K + 1)]
    return spark.createDataFrame(rows, "template int, label string, base boolean, t int, gram string, n int")


def _words(text):
    return F.array_remove(F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), DELIMITERS), "")


def scan_licenses(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES,
                  similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``text_id``, ``n_words``, ``n_base`` (places of all phrases),
    ``first_word``, ``last_word`` (their smallest and largest start), ``base_labels``, ``labels`` and ``score``
    (the best verified similarity, 1 with a base place, 0 without anything).

    Null and empty texts have no words.  Overlapping places count each; repeated
    rows keep their rows and get the same result; null ids are values like any
    other.  Empty table: no rows.  Other columns are not read.
    """
    spark, text = docs.sparkSession, F.col(text_col)
    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_id"), text.alias("text"))
    grams = base.select("doc_id", "text_id", _words(F.col("text")).alias("w")).filter(F.size("w") >= K).select(
        "doc_id", "text_id", F.posexplode(F.expr(
            "transform(array(w), v -> transform(sequence(0, size(v) - 2), i -> concat(v[i], ' ', v[i + 1])))[0]")).alias("i", "gram"))
    # templates are a constant of this module or a parameter: a few hundred pairs
    votes = cut(grams.withColumn("h", F.xxhash64("gram")).join(
        F.broadcast(template_pairs(spark, phrases, notices).withColumn("h", F.xxhash64("gram"))), ["h", "gram"])
        .groupBy("doc_id", "text_id", "template", "label", "base", "n", (F.col("i") - F.col("t")).alias("diagonal"))
        .agg(F.collect_set("t").alias("seen")))  # at most a template's pairs
    doc = ["doc_id", "text_id"]
    places = votes.filter("base and size(seen) = n").groupBy(*doc).agg(
        F.count("*").alias("n_base"), F.min("diagonal").alias("first_word"), F.max("diagonal").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("base_labels"),
        F.collect_set("label").alias("found"))
    slack = max([int((STRETCH - 1) * (len(t.split()) - K + 1)) for t in notices] or [0])
    line = Window.partitionBy(*doc, "template").orderBy("diagonal")
    near = (votes.filter("not base").withColumn("slack", F.floor((STRETCH - 1) * F.col("n")))
            .withColumn("around", F.sum(F.size("seen")).over(line.rangeBetween(-slack, slack)))
            .filter(F.col("around") >= similarity * F.col("n")))
    # the stretch from each diagonal on: at most slack + 1 diagonals, each with at most a template's pairs
    merged = near.withColumn("own", F.filter(
        F.collect_list(F.struct("diagonal", "seen")).over(line.rangeBetween(0, slack)),
        lambda v: v["diagonal"] - F.col("diagonal") <= F.col("slack"))).select(
        *doc, "template", "label", "n", F.size(F.array_distinct(F.flatten("own.seen"))).alias("votes"),
        F.array_min(F.transform("own", lambda v: v["diagonal"] + F.array_min(v["seen"]))).alias("start"),
        F.array_max(F.transform("own", lambda v: v["diagonal"] + F.array_max(v["seen"]))).alias("stop"))
    order = Window.partitionBy(*doc).orderBy("start", "template", "stop")
    # groups of stretches that hang together, and in each the best first: a stretch stays if no better one that stayed overlaps it
    verified = (merged.withColumn("similarity", F.col("votes") / F.col("n"))
                .filter((F.col("similarity") >= similarity) & (F.col("stop") - F.col("start") + 1 <= STRETCH * F.col("n")))
                .withColumn("before", F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1)))
                .withColumn("place", F.sum(F.when(F.col("start") <= F.col("before"), 0).otherwise(1)).over(
                    order.rowsBetween(Window.unboundedPreceding, 0)))
                .groupBy(*doc, "place", "start", "stop", (-F.col("similarity")).alias("worse"))
                .agg(F.collect_set("label").alias("labels"))
                .groupBy(*doc, "place").agg(F.sort_array(F.collect_list(F.struct("worse", "start", "stop", "labels"))).alias("all"))
                .select(*doc, F.explode(F.expr("""
                    aggregate(all, slice(all, 1, 0), (kept, x) -> if(
                        exists(kept, k -> k.start <= x.stop and x.start <= k.stop and k.worse < x.worse), kept, kept || array(x)))""")).alias("x"))
                .select(*doc, F.explode("x.labels").alias("label"), (-F.col("x.worse")).alias("similarity"))
                .groupBy(*doc).agg(F.collect_set("label").alias("more"), F.max("similarity").alias("best")))
    both = places.alias("p").join(verified.alias("v"), F.expr("p.doc_id <=> v.doc_id and p.text_id = v.text_id"), "full").select(
        F.coalesce("p.doc_id", "v.doc_id").alias("_d"), F.coalesce("p.text_id", "v.text_id").alias("_t"), "n_base", "first_word",
        "last_word", "base_labels", F.array_join(F.array_sort(F.array_union(
            F.coalesce("found", F.array().cast("array<string>")), F.coalesce("more", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
    counted = base.select("doc_id", "text_id", F.size(_words(F.col("text"))).cast("long").alias("n_words"))
    return counted.join(cut(both), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_id") == F.col("_t")), "left").select(
        "doc_id", "text_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long"), F.col("last_word").cast("long"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


__all__ = ["PHRASES", "NOTICES", "template_pairs", "scan_licenses"]

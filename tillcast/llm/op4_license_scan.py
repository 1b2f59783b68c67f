"""License scan, in DataFrame functions only: which license templates a document holds, and where.

Words are runs of letters, digits and anything that is not ASCII, A-Z lower-cased; shingles are five
consecutive words, or all words of a shorter template. For each template length, windows of that many
words cover a text in steps of an eighth of it. MinHash bands of a window retrieve templates: with
`BANDS` bands of two values a window at Jaccard 0.6, which is what three quarters of a template make,
is found with probability above 0.9999. A hit is verified by exact containment: the share of the
template's shingles that stand in the window, widened by one step to both sides.

Every template shingle has one of a few anchor words, so windows without one hold no shingle, and are
not made. The template table is a parameter; its size is checked, as it is broadcast.

Defined cases: null and empty texts, and an empty template table, give no rows; rows with the same
doc_id are one document, as are all rows with a null one; equal containments go to the earliest window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.registry import query, table
from tillcast.sources.staging import staged

SHINGLE = 5
BANDS = 24
CONTAINED = 0.75
MAX_TEMPLATES = 10_000

#: names and notices of public licenses, fixed values
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("mit", "Released under the MIT License."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("all-rights", "All rights reserved."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mit-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


def _lowered(text: Column) -> Column:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, letters, letters.lower())


def _words(text: Column) -> Column:
    return F.array_remove(F.split(_lowered(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _shingles(words: Column) -> Column:
    last = F.greatest(F.size(words) - SHINGLE, F.lit(0))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(words, i, SHINGLE))))


def _bands(shingles: Column) -> Column:
    def least(k: Column) -> Column:
        return F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, k)))

    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, least(2 * b), least(2 * b + 1)))


def scan_licenses(documents: DataFrame, templates: DataFrame) -> DataFrame:
    """(doc_id, license, containment, start_word), one row per document and license that it holds."""
    known = staged(templates.where("license IS NOT NULL").select("license", _words(F.col("text")).alias("w")).where(F.size("w") > 0).distinct())
    size = known.limit(MAX_TEMPLATES + 1).count()
    if size > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} license templates")
    known = known.select("license", F.size("w").alias("len"), _shingles(F.col("w")).alias("t"), "w")
    lengths = sorted(r["len"] for r in known.select("len").distinct().collect())

    words = documents.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    every = sorted({a for length in lengths for a in _anchors(known.where(F.col("len") == length))})
    words = staged(words.where(_holds_any(every)).select("doc_id", _words(F.col("text")).alias("w")))
    found = None
    for length in lengths:
        step = max(1, (length - SHINGLE + 1) // 8)
        anchors = _anchors(known.where(F.col("len") == length))
        last = F.greatest(F.size("w") - length, F.lit(0))
        held = words.where(F.size("w") > 0).withColumn("at", F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.get("w", i).isin(anchors)))
        around = F.flatten(F.transform("at", lambda p: F.sequence(F.greatest(p - length + 1, F.lit(0)), p)))
        starts = F.filter(F.array_distinct(around), lambda i: (i <= last) & ((i % step == 0) | (i == last)))
        windows = held.select("doc_id", "w", F.explode(starts).alias("start"))
        wide = F.slice("w", F.greatest(F.col("start") - step, F.lit(0)) + 1, length + F.least(F.col("start"), F.lit(step)) + step)
        cut = windows.select("doc_id", "start", F.slice("w", F.col("start") + 1, length).alias("x"), wide.alias("wide"))
        # shorter templates are one shingle of their own length
        k = min(length, SHINGLE)
        s = F.transform(F.sequence(F.lit(1), F.greatest(F.size("wide") - k, F.lit(0)) + 1), lambda i: F.xxhash64(F.slice("wide", i, k)))
        cut = cut.select("doc_id", "start", s.alias("s"), _shingles(F.col("x")).alias("xs"))
        banded = cut.select("doc_id", "start", "s", F.explode(_bands(F.col("xs"))).alias("b"))
        own = known.where(F.col("len") == length).select("license", "t", F.explode(_bands(F.col("t"))).alias("tb"))
        hits = banded.join(F.broadcast(own), F.col("b") == F.col("tb"))
        share = F.size(F.array_intersect("t", "s")) / F.size("t")
        part = hits.select("doc_id", "license", share.alias("containment"), F.col("start").alias("start_word")).where(F.col("containment") >= CONTAINED)
        found = part if found is None else found.union(part)
    if found is None:
        return documents.sparkSession.createDataFrame([], "doc_id long, license string, containment double, start_word int")
    best = F.min(F.struct((-F.col("containment")).alias("c"), "start_word")).alias("m")
    return found.groupBy("doc_id", "license").agg(best).select("doc_id", "license", (-F.col("m.c")).alias("containment"), "m.start_word")


def _anchors(known: DataFrame) -> list[str]:
    """Words of which every shingle of these templates has one; long words come first."""
    anchors: set[str] = set()
    for row in known.select("w").orderBy("w").collect():
        for i in range(max(1, len(row["w"]) - SHINGLE + 1)):
            piece = row["w"][i : i + SHINGLE]
            if not anchors & set(piece):
                anchors.add(max(piece, key=lambda x: (len(x), x)))
    return sorted(anchors)


def _holds_any(anchors: list[str]) -> Column:
    """Whether a text may have one of these words; it is lower-cased once for all of them."""

    def held(text: Column) -> Column:
        out = F.lit(False)
        for word in anchors:
            out = out | text.contains(word)
        return out

    return F.exists(F.array(_lowered(F.col("text"))), held)


@query("op4_license_scan")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    templates = spark.createDataFrame(TEMPLATES, "license string, text string")
    return scan_licenses(table(spark, sf, "documents"), templates)

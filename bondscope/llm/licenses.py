"""License statements found by MinHash bands over overlapping windows of words."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bondscope.llm.common import LOWER, UPPER, stored

#: Fixed texts of common statements.
STATEMENTS = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("GPL-3.0", "This program is free software licensed under the GNU General Public License version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: A tag in source files names each license of the list, too.
TAGGED = tuple((name, f"SPDX-License-Identifier: {name}") for name in sorted({name for name, _ in STATEMENTS}))
SHINGLE = 2
BAND_BITS = 8
LEAST_LENGTH = 16
CONTAINED = 0.9


def words(text: Column) -> Column:
    parts = F.split(F.translate(text, UPPER, LOWER), r"[^a-z0-9\x{80}-\x{10FFFF}]+")
    return F.filter(parts, lambda w: w != "")


def shingles(tokens: Column) -> Column:
    """Hashes of SHINGLE consecutive words, from each position."""
    return F.transform(
        F.sequence(F.lit(0), F.size(tokens) - SHINGLE), lambda i: F.xxhash64(*[F.get(tokens, i + k) for k in range(SHINGLE)]))


def bands(hashes: Column) -> Column:
    """One-permutation MinHash: the least hash of each of 2^BAND_BITS ranges that has any.

    Sets hold template shingles only. A shingle of a template leads its band unless a smaller
    one of the window is in the same range: with W of them, a chance of W / 2^BAND_BITS at
    most. A template of n shingles inside is missed with that chance to the power n: below
    1e-3 for 4 shingles with 32 others, less for longer ones.
    """
    return F.map_values(F.map_from_entries(F.aggregate(
        F.array_sort(hashes), F.array().cast("array<struct<band:bigint,least:bigint>>"),
        lambda out, h: F.when(
            F.get(out, F.size(out) - 1)["band"] == F.shiftright(h, 64 - BAND_BITS), out
        ).otherwise(F.concat(out, F.array(F.struct(F.shiftright(h, 64 - BAND_BITS).alias("band"), h.alias("least"))))))))


def scanned(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """doc_id, n_licenses and licenses (sorted names) of every row of ``docs`` (doc_id, text).

    ``templates`` has license and text, and at least SHINGLE words. Template lengths are
    rounded up to a power of two L, LEAST_LENGTH at least; windows of 2 L words start every L
    words, so that each occurrence lies within a window. Shingles of no template cannot be in
    an intersection and are left out before windows are cut. Windows that share a MinHash
    band with a template are compared by exact shingle containment. Null, empty or short
    texts have no licenses; rows that repeat, also with a null id, are separate and alike; no
    rows give no rows. Texts are read whole. Further columns are ignored.
    """
    known = templates.select("license", words(F.col("text")).alias("w")).where(F.size("w") >= SHINGLE)
    known = stored(known.select(
        "license", F.greatest(F.lit(LEAST_LENGTH), F.pow(F.lit(2.0), F.ceil(F.log2(F.size("w"))))).cast("int").alias("length"),
        F.array_distinct(shingles(F.col("w"))).alias("wanted")), "templates")
    # Templates are small; Spark broadcasts the stored tables only below its own size limit.
    vocabulary = stored(known.select("length", F.explode("wanted").alias("hash")).distinct(), "vocabulary")
    retrieved = stored(known.select("license", "length", "wanted", F.explode(bands(F.col("wanted"))).alias("least")), "retrieved")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("key", F.xxhash64("doc_id", "text"))
    tokens = rows.where("text IS NOT NULL").select("doc_id", "key", words(F.col("text")).alias("w")).where(F.size("w") >= SHINGLE)
    hits = tokens.select("doc_id", "key", F.posexplode(shingles(F.col("w"))).alias("at", "hash")).join(vocabulary, "hash")
    # A position lies in the window that starts at or before it and in the one before that.
    first = F.floor(F.col("at") / F.col("length"))
    windows = hits.select("doc_id", "key", "length", "hash", F.explode(F.array(first, first - 1)).alias("window")).groupBy(
        "doc_id", "key", "length", "window").agg(F.collect_set("hash").alias("found"))
    met = windows.select("doc_id", "key", "length", "found", F.explode(bands(F.col("found"))).alias("least")).join(
        retrieved, ["length", "least"])
    inside = F.size(F.array_intersect("found", "wanted")) >= F.ceil(F.size("wanted") * CONTAINED)
    found = met.where(inside).groupBy("doc_id", "key").agg(F.array_sort(F.collect_set("license")).alias("licenses"))
    found = found.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "licenses")
    listed = rows.select("doc_id", "key").join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    return listed.select(
        "doc_id", F.coalesce(F.size("licenses"), F.lit(0)).cast("long").alias("n_licenses"),
        F.coalesce(F.array_join("licenses", ","), F.lit("")).alias("licenses"))

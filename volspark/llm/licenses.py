"""License scan: MinHash bands retrieve templates for text windows, containment verifies.

Words: lower case, runs of letters and digits. Shingles: five words. A template
of t shingles belongs to the class of the smallest power of two c >= t; texts
are covered by windows of 2c shingles, one every c shingles, so an occurrence
lies whole in some window.

MinHash has ``BANDS`` bands of one row each: a window and a template collide in
a band when their least values under its permutation are equal. At containment
0.8 their Jaccard similarity is at least 0.8 (c + 1)/2 / (2c + 0.1c) > 0.19, so a
band misses with chance below 0.81 and all of them below 1e-11.

Signatures are evaluated lazily: a collision needs the template's least shingle
of that band in the window, so band values are looked up at shingles that are
the least of some template and band, and only there the window's own least
value is computed. Windows with a collision are verified on the shingle texts:
the share of the template's distinct shingles that the window has.

Everything is DataFrame functions. The templates and their signatures are a
bounded parameter (at most ``MAX_TEMPLATE_SHINGLES`` shingles each); texts are
never exploded by word and never shuffled.

Defined results: null or wordless text has no license; templates of fewer than
five words are rejected (ValueError); repeated rows give repeated results; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from volspark.llm.expressions import let

# fixed values: notices by which works name their license
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
     "file except in compliance with the License. You may obtain a copy of the License at"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-header", "This program is free software: you can redistribute it and/or modify it under the terms of "
     "the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, "
     "or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("BSD-grant", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met"),
)

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 128
MAX_TEMPLATE_SHINGLES = 1024
WORD = r"[^\p{L}\p{N}]+"


def words_of(text: Column) -> Column:
    """The words of a text."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), WORD), lambda w: w != "")


def shingles_of(words: Column) -> Column:
    """The texts of all runs of ``SHINGLE`` words."""
    return F.when(F.size(words) < SHINGLE, F.array().cast("array<string>")).otherwise(F.transform(
        F.sequence(F.lit(1), F.size(words) - SHINGLE + 1),
        lambda i: F.array_join(F.slice(words, i, SHINGLE), " ")))


def _permuted(value: Column, band: Column) -> Column:
    """The value's place under a band's permutation (xxHash64 of both)."""
    return F.xxhash64(value, band)


def signatures(spark: SparkSession, templates=TEMPLATES) -> list:
    """Rows (shingle hash, band, template, class, t): where each template's band value is attained."""
    frame = spark.createDataFrame([(name, text) for name, text in templates], "name string, text string")
    rows = frame.select("name", F.array_distinct(shingles_of(words_of(F.col("text")))).alias("s"))
    sizes = {r.name: r.t for r in rows.select("name", F.size("s").alias("t")).collect()}
    for name, size in sizes.items():
        if not 1 <= size <= MAX_TEMPLATE_SHINGLES:
            raise ValueError(f"template {name}: {size} shingles of {SHINGLE} words")
    bands = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band")
    least = (rows.select("name", "s", bands)
             .select("name", "band", F.explode(F.transform("s", lambda x: F.xxhash64(x))).alias("h"))
             .groupBy("name", "band").agg(F.min_by("h", _permuted(F.col("h"), F.col("band"))).alias("h")))
    return [(r.h, r.band, r.name, 1 << (sizes[r.name] - 1).bit_length(), sizes[r.name])
            for r in least.collect()]


def matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES,
            containment: float = CONTAINMENT) -> DataFrame:
    """(id, found) of every document; ``found``: array<struct(license, first_word, words, containment)>.

    One entry per verified window and template, in text order; ``first_word``
    and ``words`` delimit the window.
    """
    spark = docs.sparkSession
    signed = signatures(spark, templates)
    anchors = sorted({row[0] for row in signed})
    # at most BANDS rows per template: (hash) -> collisions to test there
    lookup = F.create_map(*[x for h in anchors for x in (
        F.lit(h), F.array(*[F.struct(F.lit(b).alias("band"), F.lit(n).alias("license"), F.lit(c).alias("c"))
                            for own, b, n, c, _ in signed if own == h]))])
    texts = F.create_map(*[x for name, text in templates for x in (
        F.lit(name), F.array_distinct(shingles_of(words_of(F.lit(text)))))])

    def windows_at(hashes: Column, at: Column) -> Column:
        """Colliding (license, start, c) of the windows that hold the anchor at position ``at``."""
        def test(row: Column) -> Column:
            last = F.floor(at / row["c"]).cast("int") * row["c"]
            starts = F.filter(F.array(last - row["c"], last), lambda s: s >= 0)

            def collides(start: Column) -> Column:
                own = _permuted(F.get(hashes, at), row["band"])
                window = F.slice(hashes, start + 1, 2 * row["c"])
                return F.array_min(F.transform(window, lambda h: _permuted(h, row["band"]))) == own

            return F.transform(F.filter(starts, collides), lambda start: F.struct(
                start.alias("start"), row["license"].alias("license"), row["c"].alias("c")))

        return F.flatten(F.transform(F.element_at(F.col("lookup"), F.get(hashes, at)), test))

    def candidates(hashes: Column) -> Column:
        marked = F.transform(hashes, lambda h, i: F.when(h.isin(anchors), i))
        return F.array_distinct(F.flatten(F.transform(
            F.filter(marked, lambda i: i.isNotNull()), lambda i: windows_at(hashes, i))))

    def verified(words: Column, found: Column) -> Column:
        def share(x: Column) -> Column:
            template = F.element_at(F.col("texts"), x["license"])
            window = shingles_of(F.slice(words, x["start"] + 1, 2 * x["c"] + SHINGLE - 1))
            return F.size(F.array_intersect(template, window)) / F.size(template)

        scored = F.transform(found, lambda x: F.struct(
            x["start"].alias("first_word"), x["license"].alias("license"),
            F.least(2 * x["c"] + SHINGLE - 1, F.size(words) - x["start"]).alias("words"),
            share(x).alias("containment")))
        return F.array_sort(F.filter(scored, lambda x: x["containment"] >= containment))

    rows = docs.select(F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("w"))
    hashed = F.transform(shingles_of(F.col("w")), lambda s: F.xxhash64(s))
    none = F.array().cast("array<struct<first_word:int,license:string,words:int,containment:double>>")
    rows = rows.select("id", "w", lookup.alias("lookup"), texts.alias("texts"), let(hashed, candidates).alias("c"))
    return rows.select("id", F.when(F.size("c") > 0, verified(F.col("w"), F.col("c"))).otherwise(none).alias("found"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """(id, licenses, n_windows, containment): per document the sorted license names, comma-joined,
    the number of verified windows and the best containment (0 without a license)."""
    found = matches(docs, id_col, text_col, templates)
    names = F.array_sort(F.array_distinct(F.transform("found", lambda x: x["license"])))
    best = F.array_max(F.transform("found", lambda x: x["containment"]))
    return found.select("id", F.array_join(names, ",").alias("licenses"),
                        F.size("found").cast("long").alias("n_windows"),
                        F.coalesce(best, F.lit(0.0)).alias("containment"))

"""Operator 10: license scans by MinHash bands over text windows and exact containment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import read, stored

SHINGLE, BANDS, CONTAINED = 5, 32, 0.75
#: Words of a window by the words of the templates it is for: a template fills at least a quarter
#: of its window's shingles wherever it lies, as windows begin every quarter of their length.
#: Longer templates take windows that go on doubling.
WINDOWS = (8, 16, 32, 64, 128, 256)
#: Shingles of templates up to which they stand in the plan, and rows up to which a table is broadcast.
LITERALS, BROADCAST_ROWS = 5_000, 1_000_000

#: Phrases of public licences, by SPDX name.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    ),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-4.0": ("This work is licensed under a Creative Commons Attribution 4.0 International License.",),
    "CC-BY-SA-4.0": ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",),
    "BSD-3-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "), " "), "")


def _shingles(words: str) -> Column:
    """Hashes of all runs of five words of an array column, in order."""
    n = F.size(words)
    runs = F.transform(F.sequence(F.lit(0), F.greatest(n - SHINGLE, F.lit(0))), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(SHINGLE)]))
    return F.when(n >= SHINGLE, runs).otherwise(F.array().cast("array<bigint>"))


def template_table(spark: SparkSession, templates: dict[str, tuple[str, ...]] | DataFrame) -> DataFrame:
    """template, license, window, hashes of the templates (a dict, or rows of license and text); those of fewer than five words are left out."""
    if isinstance(templates, dict):
        templates = spark.createDataFrame([(name, t) for name, ts in templates.items() for t in ts], "license string, text string")
    df = templates.select(F.xxhash64("license", "text").alias("template"), "license", _words(F.col("text")).alias("w")).where(F.size("w") >= SHINGLE).distinct()
    sizes, longest = list(WINDOWS), df.agg(F.max(F.size("w"))).first()[0] or 0
    while sizes[-1] * 3 // 4 < longest:
        sizes.append(sizes[-1] * 2)
    window = F.lit(sizes[-1])
    for size in reversed(sizes):
        window = F.when(F.size("w") <= size * 3 // 4, F.lit(size)).otherwise(window)
    return df.select("template", "license", window.alias("window"), F.array_distinct(_shingles("w")).alias("hashes"))


def _bands(hashes: Column) -> Column:
    """(band, least hash) of the window's shingles under each of the hash functions."""
    return F.array(*[F.struct(F.lit(b).alias("band"), F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(b)))).alias("least")) for b in range(BANDS)])


def _window(size: int):
    return lambda start: F.struct(F.lit(size).alias("window"), start.alias("start"), F.slice("hashes", start + 1, size - SHINGLE + 1).alias("part"))


def _near(hashed: DataFrame, sizes: list[int], known: list[int]) -> DataFrame:
    """doc_id, window, start, part: the windows of all sizes that share a shingle with ``known``, which stand in the plan."""
    all_hashes = F.array(*[F.lit(h) for h in known])
    cut = []
    for size in sizes:
        starts = F.sequence(F.lit(0), F.greatest(F.size("hashes") - 1, F.lit(0)), F.lit(size // 4))
        cut.append(F.transform(starts, _window(size)))
    near = F.filter(F.flatten(F.array(*cut)), lambda x: F.arrays_overlap(x["part"], all_hashes))
    # not a filter before: Spark would push it down and split each text again for every shingle
    return hashed.select("doc_id", F.inline(F.when(F.arrays_overlap("hashes", all_hashes), near)))


def _near_by_join(hashed: DataFrame, sizes: list[int], known: DataFrame) -> DataFrame:
    """The same windows where ``known`` (h) is a table: shingles meet it in a join, and say which windows hold them.

    Only places of shingles that a template has move; documents with any are read again for
    their windows, which are written.
    """
    few = known.count() <= BROADCAST_ROWS
    # outer generators: from others Spark infers filters and pushes them down, where each shingle would split its text again
    hits = hashed.select("doc_id", F.posexplode_outer("hashes").alias("place", "h")).join(F.broadcast(known) if few else known, "h", "left_semi")
    steps = F.array(*[F.struct(F.lit(size).alias("window"), F.lit(size // 4).alias("step"), F.lit(size - SHINGLE).alias("reach")) for size in sizes])
    each = hits.select("doc_id", "place", F.inline(steps))
    first = F.greatest(F.ceil((F.col("place") - F.col("reach")) / F.col("step")), F.lit(0))
    starts = each.select("doc_id", "window", F.explode(F.transform(F.sequence(first, F.floor(F.col("place") / F.col("step"))), lambda k: (k * F.col("step")).cast("int"))).alias("start")).distinct()
    wanted = stored(starts.groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_list(F.struct("window", "start")).alias("at")), "windows")
    mine = hashed.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS // 100 else wanted, F.col("doc_id").eqNullSafe(F.col("_doc")))
    part = lambda x: F.struct(x["window"].alias("window"), x["start"].alias("start"), F.slice("hashes", x["start"] + 1, x["window"] - SHINGLE + 1).alias("part"))
    return stored(mine.select("doc_id", F.inline_outer(F.transform("at", part))).where(F.size("part") > 0), "windows")


def license_scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] | DataFrame | None = None, key: str = "doc_id", text: str = "text", literals: int = LITERALS) -> DataFrame:
    """Find license texts in every whole text.

    Texts are cut into overlapping windows; a window and a template that share the least hash
    in one of 32 bands are compared, and the window holds the template if it has 75 % of its
    five-word shingles. A template fills a quarter of some window's shingles at least, so a band
    meets with probability 1/4 and all 32 miss with 1 in 10,000. Windows that share no shingle
    with any template cannot meet one in a band; they are left out before the bands are
    computed, without moving a text: by the shingles in the plan, or, where the templates have
    more than ``literals``, by a join with their table.

    ``templates`` are texts by license, or a table (license, text) of any length. Returns doc_id,
    license, contained (highest share), first_word, windows, one row for each document and
    license found. Null and empty texts hold none; a null key is reported as null; repeated rows
    count as one document; a very long text is scanned whole; templates of one license that a
    window holds alike count once, with the highest share and the first place; an empty table, of
    documents or of templates, gives an empty result; other columns are ignored. Built from
    DataFrame functions only.
    """
    spark = docs.sparkSession
    known = stored(template_table(spark, TEMPLATES if templates is None else templates), "templates")
    sizes = sorted(r[0] for r in known.select("window").distinct().collect())  # they double: a few
    if not sizes:
        kind = docs.schema[key].dataType.simpleString()
        return spark.createDataFrame([], f"doc_id {kind}, license string, contained double, first_word int, windows long")
    shingles = known.select(F.explode("hashes").alias("h")).distinct()
    some = [r[0] for r in shingles.limit(literals + 1).collect()]
    hashed = docs.select(F.col(key).alias("doc_id"), _words(F.col(text)).alias("w")).select("doc_id", _shingles("w").alias("hashes"))
    windows = _near(hashed, sizes, sorted(some)) if len(some) <= literals else _near_by_join(hashed, sizes, shingles)
    keyed = windows.select("doc_id", "window", "start", "part", F.inline(_bands(F.col("part"))))
    bands = known.select("template", "license", "window", F.inline(_bands(F.col("hashes"))))
    # where templates are many, their shingles wait until a band has met
    if len(some) <= literals:
        bands = known.select("template", "license", "window", F.col("hashes").alias("wanted"), F.inline(_bands(F.col("hashes"))))
    met = keyed.join(F.broadcast(bands) if bands.count() <= BROADCAST_ROWS else bands, ["window", "band", "least"])
    if len(some) > literals:
        met = stored(met.dropDuplicates(["doc_id", "window", "start", "template", "part"]), "met").join(known.select("template", F.col("hashes").alias("wanted")), "template")
    share = F.size(F.array_intersect("part", "wanted")) / F.size("wanted")
    held = met.select("doc_id", "license", "start", share.alias("contained")).where(F.col("contained") >= CONTAINED)
    return held.groupBy("doc_id", "license").agg(
        F.max("contained").alias("contained"), F.min("start").alias("first_word"), F.countDistinct("start").alias("windows")
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses in all documents."""
    return license_scan(read(spark, sf_dir, "documents"))


QUERIES = {"op10_license_scan": op10_license_scan}
ORACLE: dict[str, str] = {}

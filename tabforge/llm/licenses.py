"""License scan with DataFrame functions alone.

Words are lower-cased runs of letters and digits (inner dots and hyphens stay).
Every text window of six words, stepping by one, is a set of two five-word
shingles; template windows are cut alike. A band is one MinHash: the smaller of
the two seeded hashes. A window inside a copied notice equals a template window,
so every band collides; a notice of just five words shares one shingle with the
two windows that hold it, and a band misses both with probability 1/3, so
``bands`` = 8 retrieve it with probability 1 - 3**-8 > 0.9998. A notice below
five words is one shingle of all its words, and its windows have that length.

Templates are a table (a dict or a DataFrame), hashed by the expressions that
hash the texts. A band can only equal a template's if one of the window's
shingles is the template's, so a bitmap of the templates' shingles, eight bits or
more for each, lets few other windows through; what passes is joined with the
template table by band and by shingle, broadcast up to ``BROADCAST_ROWS`` of its
rows. A text's words are zipped with themselves shifted, so that an exploded
window carries its own six words and never the text; no text is shuffled.

Verification is exact and local: a template's shingles in a text form stretches,
which end where the next one is farther away than the template is long. A stretch
counts if a band retrieved a window in it and it holds ``containment`` or more of
the template's shingles. Of stretches of one family that overlap in a text
(versions of a licence share most words) the best contained one stays; ties go to
more shingles, then to the smaller name.

Defined results: a null or empty text, or one without any template, gives no
row; repeated rows (same id and text) give one row for each license; an empty
table gives no rows; templates without a word are left out.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Public notices and standard headers by SPDX-like names.
TEMPLATES = {
    "AGPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "BSD-3-Clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC0-1.0": "has waived all copyright and related or neighboring rights to this work",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-2.1-or-later": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "LGPL-3.0-or-later": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.",
    "MIT": "Released under the MIT License",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "Proprietary": "All rights reserved",
    "Unlicense": "This is free and unencumbered software released into the public domain",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
}
#: Rows of the template table (a band or shingle each) that may be broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 200_000
_SHINGLE = -1  # the band number of a shingle itself


def family_of(name: str) -> str:
    """Licences whose notices are versions of each other: the name without its version; the GNU ones are one family."""
    stem = re.split(r"-\d", name, maxsplit=1)[0]
    return "GNU" if stem in ("GPL", "LGPL", "AGPL") else stem


def words(text: Column) -> Column:
    """Lower-cased words without outer punctuation."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"([\p{L}\p{N}](?:[\p{L}\p{N}.\-]*[\p{L}\p{N}])?)"), F.lit(1))


def _shingle(parts: list[Column]) -> Column:
    """Hash of these words; null beyond the end of the text."""
    return F.when(parts[-1].isNotNull(), F.xxhash64(*parts))


def _band(first: Column, second: Column | None, band: int) -> Column:
    one = F.xxhash64(first, F.lit(band))
    return one if second is None else F.when(second.isNull(), one).otherwise(F.least(one, F.xxhash64(second, F.lit(band))))


def _windows(texts: DataFrame, sizes: list[int], size: int) -> DataFrame:
    """The columns of ``texts`` without its words ``w``; ``at``, and ``h`` with the shingles of each size and the next one."""
    # the explode takes the zip itself: an inferred filter on a named array would tokenise twice
    shifted = F.arrays_zip("w", *[F.slice("w", i + 1, F.size("w")).alias(f"w{i}") for i in range(1, size + 1)])
    along = [c for c in texts.columns if c != "w"]
    at = texts.select(*along, F.posexplode(shifted).alias("at", "c"))
    word = [F.col("c.w"), *[F.col(f"c.w{i}") for i in range(1, size + 1)]]
    hashed = F.struct(*[_shingle(word[:k]).alias(f"h{k}") for k in sizes], _shingle(word[1:]).alias("next"))
    # an array of one struct: what reads the hashes below doesn't compute them again
    return at.select(*along, "at", F.explode(F.array(hashed)).alias("h"))


def _marks(k: int, size: int, bands: int) -> list[Column]:
    """(k, band, value) of a window: its bands, and its first shingle."""
    first = F.col(f"h.h{k}")
    second = F.col("h.next") if k == size else None
    values = [(j, _band(first, second, j)) for j in range(bands if k == size else 1)] + [(_SHINGLE, first)]
    return [F.struct(F.lit(k).alias("k"), F.lit(j).alias("band"), v.alias("value")) for j, v in values]


def template_table(spark: SparkSession, templates: dict[str, str] | DataFrame, size: int, bands: int) -> DataFrame:
    """(license, family, k, n shingles, length in words, band, value), each once. A DataFrame has license, text and, if not by name, family."""
    if isinstance(templates, dict):
        rows = [F.struct(F.lit(n).alias("license"), F.lit(t).alias("text"), F.lit(family_of(n)).alias("family")) for n, t in templates.items()]
        table = spark.range(1).select(F.inline(F.array(*rows)))
    else:
        stem = F.regexp_replace("license", r"-\d.*$", "")
        family = F.when(stem.isin("GPL", "LGPL", "AGPL"), F.lit("GNU")).otherwise(stem)
        table = templates.select("license", "text", F.col("family") if "family" in templates.columns else family.alias("family"))
    cut = table.select("license", "family", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    cut = cut.select("license", "family", F.size("w").alias("length"), F.least(F.size("w"), F.lit(size)).alias("own"), "w")
    parts = [F.when(F.col("own") == k, F.array(*_marks(k, size, bands))) for k in range(1, size + 1)]
    found = (_windows(cut, list(range(1, size + 1)), size).where(F.col("at") <= F.col("length") - F.col("own"))
             .select("license", "family", "length", F.explode(F.coalesce(*parts)).alias("m"))
             .select("license", "family", "length", "m.*").distinct())
    n = (found.where(F.col("band") == _SHINGLE).groupBy(F.col("license").alias("_license")).agg(F.count("*").alias("n")))
    return found.join(n, F.col("license") == F.col("_license")).drop("_license")


def _cell(value: Column, log2: int) -> Column:
    return F.shiftrightunsigned(value, 64 - log2)


def _bitmap(shingles: DataFrame, log2: int) -> Column:
    """A literal array of ``2**log2`` bits with those of the shingles set (at most ``2**(log2 - 6)`` longs of the driver)."""
    cells = shingles.select(_cell(F.col("value"), log2).alias("cell"))
    bit = F.expr("shiftleft(1L, cast(cell & 63 AS int))")
    filled = dict(map(tuple, cells.groupBy(F.shiftright("cell", 6).alias("at")).agg(F.bit_or(bit).alias("bits")).collect()))
    return F.split(F.lit(",".join(str(filled.get(i, 0)) for i in range(1 << (log2 - 6)))), ",").cast("array<long>")


def scan_licenses(df: DataFrame, templates: dict[str, str] | DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                  size: int = 5, bands: int = 8, containment: float = 0.8) -> DataFrame:
    """One row per document and license found: id, license, containment, first_word (of the first retrieved window, from 0)."""
    known = template_table(df.sparkSession, TEMPLATES if templates is None else templates, size, bands)
    number = {r["k"]: r["n"] for r in known.where(F.col("band") == _SHINGLE).groupBy("k").agg(F.count("*").alias("n")).collect()}
    if not number:
        return df.select(F.col(id_col), F.lit("").alias("license"), F.lit(0.0).alias("containment"), F.lit(0).alias("first_word")).limit(0)
    total = sum(number.values())
    log2 = min(20, max(12, (8 * total - 1).bit_length()))
    bits = _bitmap(known.where(F.col("band") == _SHINGLE), log2)
    sizes = sorted(number)

    def maybe(value: Column) -> Column:
        cell = _cell(value, log2)
        return F.coalesce(F.getbit(F.get(bits, F.shiftright(cell, 6).cast("int")), cell.bitwiseAND(F.lit(63)).cast("int")) == 1, F.lit(False))

    docs = df.select(F.col(id_col).alias("_id"), F.xxhash64(id_col, text_col).alias("_key"), words(F.col(text_col)).alias("w"))
    rows = _windows(docs, sizes, size)
    passed = F.lit(False)
    for k in sizes:
        passed |= maybe(F.col(f"h.h{k}"))
    if size in number:  # a window whose second shingle alone is a template's has its bands, too
        passed |= F.col(f"h.h{size}").isNotNull() & maybe(F.col("h.next"))
    marks = F.array(*[m for k in sizes for m in _marks(k, size, bands)])
    found = rows.where(passed).select("_id", "_key", "at", F.explode(marks).alias("m")).select("_id", "_key", "at", "m.*").where("value is not null")
    if total * (bands + 1) <= BROADCAST_ROWS:
        known = F.broadcast(known)
    hit = (found.join(known, ["k", "band", "value"])
           .groupBy("_id", "_key", "license", "family", "k", "n", "length", "at")
           .agg(F.max(F.col("band") != _SHINGLE).alias("retrieved"), F.max(F.when(F.col("band") == _SHINGLE, F.col("value"))).alias("shingle")))

    # stretches: a document's hits of one template, in order
    own = Window.partitionBy("_id", "_key", "license").orderBy("at")
    new = F.coalesce(F.col("at") - F.lag("at").over(own) > F.col("length"), F.lit(True)).cast("int")
    stretch = (hit.withColumn("new", new).withColumn("stretch", F.sum("new").over(own))
               .groupBy("_id", "_key", "license", "family", "n", "stretch")
               .agg(F.min(F.when(F.col("retrieved"), F.col("at"))).alias("first_word"), F.min("at").alias("low"),
                    F.max(F.col("at") + F.col("k")).alias("high"), F.countDistinct("shingle").alias("held"))
               .withColumn("containment", F.col("held") / F.col("n"))
               .where(F.col("first_word").isNotNull() & (F.col("containment") >= containment)))
    # overlapping stretches of one family
    kin = Window.partitionBy("_id", "_key", "family").orderBy("low", "high", "license")
    before = F.max("high").over(kin.rowsBetween(Window.unboundedPreceding, -1))
    placed = stretch.withColumn("new", F.coalesce(F.col("low") >= before, F.lit(True)).cast("int")).withColumn("place", F.sum("new").over(kin))
    best = Window.partitionBy("_id", "_key", "family", "place").orderBy(F.desc("containment"), F.desc("held"), "license")
    return (placed.withColumn("nth", F.row_number().over(best)).where("nth = 1")
            .groupBy("_id", "_key", "license").agg(F.max("containment").alias("containment"), F.min("first_word").alias("first_word"))
            .select(F.col("_id").alias(id_col), "license", F.round("containment", 6).alias("containment"), "first_word"))

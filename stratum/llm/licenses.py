"""License scans: MinHash bands over overlapping windows of a text retrieve templates, shingle containment decides.

Shingles are five words. Templates fall into classes by their number of shingles, up to 1, 2, 4, 8 and so on. Each class
has windows long enough to hold any of its templates whole wherever it begins, on a grid of its own. Band ``j`` of a set
of shingles is the one whose hash comes first under permutation ``j`` (exclusive or with a constant). The number of bands
makes a window that holds ``min_containment`` of a template miss it with a probability of at most ``MISS``.

A band can only agree where the template's own first shingle stands in the window. So texts are searched for these
shingles first, and bands are worked out for the windows around them: what is found is what the bands of all windows
would find. Everything is DataFrame expressions; a text's hits are handled within its row, and what leaves the row is a
bounded stretch of hashes around each hit.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
MIN_CONTAINMENT = 0.8
MISS = 1e-6
MAX_TEMPLATES = 1000
MAX_SHINGLES = 512

# Notices of public licenses.
TEMPLATES = {
    "MIT (statement)": "Released under the MIT License.",
    "Apache-2.0 (statement)": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 (statement)": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 (statement)": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 (statement)": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0 (statement)": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MPL-2.0 (notice)": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "GPL-3.0 (notice)": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "Apache-2.0 (notice)": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
    "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law "
    'or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF '
    "ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "MIT (permission)": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
    "furnished to do so, subject to the following conditions:",
    "BSD (conditions)": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:",
    "GPL-2.0 (notice)": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "LGPL-2.1 (notice)": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
    "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "LGPL-3.0 (notice)": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "AGPL-3.0 (notice)": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC (permission)": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Unlicense (statement)": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
    "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
    "non-commercial, and by any means.",
    "BSD (endorsement)": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.",
    "BSD (disclaimer)": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
    "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING "
    "IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
}


# --- classes --------------------------------------------------------------------------------------------------------


def grid(shingles: int) -> tuple[int, int]:
    """Length and stride of the windows for templates of up to ``shingles`` (a power of two)."""
    stride = max(1, shingles // 4)
    return shingles + stride - 1, stride


def bands(shingles: int, min_containment: float = MIN_CONTAINMENT, miss: float = MISS) -> int:
    """Bands for a class: the least similar pair of a matching window and a template decides."""
    window, _ = grid(shingles)
    least = 1.0
    for size in range(shingles // 2 + 1, shingles + 1):
        shared = math.ceil(min_containment * size - 1e-9)
        least = min(least, shared / (window + size - shared))
    return 1 if least == 1 else math.ceil(math.log(miss) / math.log(1 - least))


def _classes(largest: int) -> list[int]:
    return [1 << k for k in range((max(largest, MAX_SHINGLES) - 1).bit_length() + 1)]


def _constant(band: int) -> int:
    """The permutation of a band: 64 bits drawn from its number."""
    value = (band + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1
    value = (value ^ value >> 31) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1
    value ^= value >> 29
    return value - (1 << 64) if value >> 63 else value


# --- shingles -------------------------------------------------------------------------------------------------------


def words(text: Column) -> Column:
    """Runs of letters and digits in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), 0)


def shingles(hashed: Column) -> Column:
    """The hash of every five in a row of an array of words' hashes; none for fewer."""
    n = F.size(hashed) - SHINGLE + 1
    tail = lambda k: F.slice(hashed, k + 1, n)
    out = tail(0)
    for k in range(1, SHINGLE):
        out = F.zip_with(out, tail(k), lambda a, b: F.xxhash64(a, b))
    return F.when(n > 0, out).otherwise(F.array().cast("array<long>"))


def _worked_out(rows: DataFrame, **columns: Column) -> DataFrame:
    """The rows with more columns, each worked out once.

    As a generator of one row these expressions cannot be moved into the filters and lambda functions that use them,
    where Spark would work them out again for every element.
    """
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def hashed_words(text: Column) -> Column:
    return F.transform(words(F.coalesce(text, F.lit(""))), lambda w: F.xxhash64(w))


def _first_of(hashes: Column, constant: Column) -> Column:
    """What comes first under the permutation."""
    return F.array_min(F.transform(hashes, lambda h: h.bitwiseXOR(constant))).bitwiseXOR(constant)


def default_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES.items()), "license string, text string")


def _sized(templates: DataFrame) -> DataFrame:
    """Each template's different shingles, and their number."""
    hashed = _worked_out(templates.select("license", "text"), hashed=hashed_words(F.col("text")))
    return _worked_out(hashed, template=F.array_distinct(shingles(F.col("hashed")))).withColumn("size", F.size("template"))


def _groups(templates: DataFrame) -> list[DataFrame]:
    """Templates that have a shingle, some ``MAX_TEMPLATES`` at a time; those above ``MAX_SHINGLES`` class by class."""
    top = F.greatest(F.lit(MAX_SHINGLES), F.pow(F.lit(2), F.ceil(F.log2("size"))).cast("int"))
    usable = _sized(templates).where(F.col("size") > 0).select("license", "text", top.alias("top"))
    out = []
    for row in usable.groupBy("top").count().orderBy("top").collect():
        parts = math.ceil(row["count"] / MAX_TEMPLATES)
        part = F.pmod(F.xxhash64("license", "text"), F.lit(parts))
        out += [usable.where((F.col("top") == row["top"]) & (part == k)) for k in range(parts)]
    return out or [templates.limit(0)]


def _template_bands(templates: DataFrame, min_containment: float, strict: bool) -> tuple[DataFrame, int]:
    """One row per template and band: its first shingle, and the windows to look at. Also the length of the longest window."""
    sized = _sized(templates).select("license", "template", "size")
    row = sized.agg(F.count(F.lit(1)), F.coalesce(F.min("size"), F.lit(1)), F.coalesce(F.max("size"), F.lit(1))).first()
    if strict and (row[0] > MAX_TEMPLATES or row[1] < 1 or row[2] > MAX_SHINGLES):
        raise ValueError(f"templates are at most {MAX_TEMPLATES}, of {SHINGLE} words to {MAX_SHINGLES} shingles, unless strict=False")
    table = [(top, *grid(top), band, _constant(band)) for top in _classes(row[2]) if row[1] <= top < 2 * row[2] for band in range(bands(top, min_containment))]
    classes = sized.sparkSession.createDataFrame(table, "top int, length int, stride int, band int, constant long")
    rows = sized.join(F.broadcast(classes), (F.col("size") <= F.col("top")) & (2 * F.col("size") > F.col("top")))
    longest = grid(next(top for top in _classes(row[2]) if top >= row[2]))[0]
    return rows.select("license", "template", "length", "stride", "constant", _first_of(F.col("template"), F.col("constant")).alias("first")), longest


# --- operator -------------------------------------------------------------------------------------------------------


def scan(docs: DataFrame, templates: DataFrame | None = None, min_containment: float = MIN_CONTAINMENT, strict: bool = True) -> DataFrame:
    """Templates in documents: ``doc_id, license, containment, first_word, n_words``, one row per document and template.

    ``containment`` is the share of the template's different shingles in the best window (the earliest one among
    equals), which begins at word ``first_word`` (from 0) and ends with the text or after ``n_words`` words. Words are
    runs of letters and digits in lower case.

    A missing text, or one of fewer than five words, holds nothing. Repeated rows, of the same id and text, give one set
    of matches. Rows without doc_id take part. Extra columns are not looked at. Templates are rows ``license, text`` of
    at least five words and at most ``MAX_SHINGLES`` shingles, and at most ``MAX_TEMPLATES``; others are an error. Without
    ``strict`` there may be any number of any length, as of whole license texts; those of fewer than five words or
    without a text match nothing. An empty table of either kind gives no row.
    """
    templates = (default_templates(docs.sparkSession) if templates is None else templates).select("license", "text")
    parts = [_matches(docs, part, min_containment, strict) for part in ([templates] if strict else _groups(templates))]
    kept = functools.reduce(DataFrame.unionByName, parts)
    best = F.max(F.struct("containment", (-F.col("window")).alias("back"), "length")).alias("best")
    return kept.groupBy("doc_id", "key", "license").agg(best).select(
        "doc_id", "license", "best.containment", (-F.col("best.back")).alias("first_word"),
        (F.col("best.length") + SHINGLE - 1).alias("n_words"))


def _matches(docs: DataFrame, templates: DataFrame, min_containment: float, strict: bool) -> DataFrame:
    """All windows of documents that hold a template."""
    keys, reach = _template_bands(templates, min_containment, strict)
    found = [r[0] for r in keys.select("first").distinct().collect()]
    texts = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
    split = _worked_out(texts, words=hashed_words(F.col("text"))).select("doc_id", "key", "words")
    hashed = _worked_out(split, hashes=shingles(F.col("words"))).select("doc_id", "key", "hashes")
    numbered = F.transform("hashes", lambda h, i: F.struct(i.alias("at"), h.alias("first")))
    hits = F.filter(numbered, lambda hit: hit["first"].isin(found))
    start = lambda hit: F.greatest(F.lit(0), hit["at"] - reach + 1)
    near = F.transform(hits, lambda hit: F.struct(
        hit["at"].alias("at"), start(hit).alias("start"), hit["first"].alias("first"),
        F.slice(F.col("hashes"), start(hit) + 1, hit["at"] - start(hit) + reach).alias("around")))
    near = hashed.select("doc_id", "key", F.inline(near))
    # All windows on the grid of the template's class that hold the hit.
    at = near.join(F.broadcast(keys), "first")
    low = F.greatest(F.lit(0), F.ceil((F.col("at") - F.col("length") + 1) / F.col("stride")).cast("int"))
    high = F.floor(F.col("at") / F.col("stride")).cast("int")
    windows = at.withColumn("cell", F.explode(F.sequence(low, high))).withColumn("window", F.col("cell") * F.col("stride"))
    windows = windows.withColumn("held", F.slice("around", F.col("window") - F.col("start") + 1, F.col("length")))
    windows = windows.where(_first_of(F.col("held"), F.col("constant")) == F.col("first"))
    shared = F.size(F.array_intersect("held", "template")) / F.size("template")
    return windows.select("doc_id", "key", "license", "window", "length", shared.alias("containment")).where(
        F.col("containment") >= min_containment)

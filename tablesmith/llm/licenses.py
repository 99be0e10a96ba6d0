"""License scans with DataFrame and SQL functions: MinHash bands over text windows, then exact shingle containment."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesmith.llm.common import text_of

#: Words of a shingle: the shortest notices have three words.
SHINGLE = 3
#: Share of a template's shingles that a window must hold, and the chance that a band then leads to it.
CONTAINED, FOUND = 0.8, 0.999
#: Templates of one pass over the documents; a larger library takes more passes.
TEMPLATES = 64

#: Notices by which public licenses are granted, under their usual short names.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-2.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("ISC", "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    ("Zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
]


def bands(words: int, contained: float = CONTAINED, found: float = FOUND) -> int:
    """Bands of one row that lead from a window of twice a template's words to the template with the chance `found`."""
    shared, window = contained * (words - SHINGLE + 1), 2 * words - SHINGLE + 1
    similarity = shared / (window + (1 - contained) * (words - SHINGLE + 1))
    return math.ceil(math.log(1 - found) / math.log(1 - similarity))


def _shingled(texts: DataFrame) -> DataFrame:
    """With `hashes`: the hash of SHINGLE words from each word on; words are runs of letters and digits in lower case."""
    row = ", ".join(f"words[i + {k}]" for k in range(SHINGLE))
    none = "cast(array() as array<bigint>)"
    made = f"if(size(words) < {SHINGLE}, {none}, transform(sequence(0, size(words) - {SHINGLE}), i -> xxhash64({row})))"
    # The words are bound within the expression, as a filter on the hashes moves below the column that it reads.
    return texts.withColumn("hashes", F.expr(f"transform(array(split(lower(text), '[^\\\\p{{L}}\\\\p{{N}}]+')), words -> {made})[0]"))


def _index(spark: SparkSession, templates: list[tuple[str, str]], first: int) -> DataFrame:
    """A row for each template and band: (template_id, license, n, shingles, band, value), value the band's MinHash shingle."""
    trimmed = [(first + k, license_, " ".join(text.split()).strip(" .,;:!?\"'()")) for k, (license_, text) in enumerate(templates)]
    shingled = _shingled(spark.createDataFrame(trimmed, "template_id int, license string, text string"))
    sized = shingled.select("template_id", "license", F.array_distinct("hashes").alias("shingles"), (F.size("hashes") + SHINGLE - 1).alias("n"))
    counts = {r["n"]: bands(r["n"]) for r in sized.select("n").distinct().collect() if r["n"] >= SHINGLE}
    if not counts:
        raise ValueError(f"no template has {SHINGLE} words")
    how_many = reduce(lambda c, x: c.when(F.col("n") == x[0], x[1]), counts.items(), F.when(F.lit(False), 0))
    banded = sized.filter(F.size("shingles") > 0).withColumn("band", F.explode(F.sequence(F.lit(1), how_many)))
    return banded.withColumn("value", F.expr("array_min(transform(shingles, s -> struct(xxhash64(s, band) as h, s))).s"))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """License notices in docs(doc_id, text, ...): (doc_id, license, n_windows, containment, start_word, end_word).

    A template of n words is looked for in windows of 2n words at every n words, so that any passage of n words lies
    whole in one of them. A window is a candidate if it shares a MinHash with the template in one of its bands, whose
    number makes that FOUND likely for windows that hold CONTAINED of the template's three-word shingles; it counts if
    it does hold so many. As a window that collides in a band holds the template's MinHash shingle, only windows round
    such shingles are formed, which changes nothing in the result. A row stands for a document and license: how many
    windows hold it, the largest containment, and the words (from 0, end exclusive) from the first shared shingle to
    the last in the first such window.

    Null is the empty text; texts of fewer than three words match nothing. Very long texts are scanned whole. Rows that
    repeat a doc_id are one document. Extra columns are ignored; an empty table gives no rows. Templates must have
    three words or more. They go to the tasks in blocks of TEMPLATES, a pass over the documents each.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    parts = [_found(texts, _index(docs.sparkSession, templates[i : i + TEMPLATES], i)) for i in range(0, len(templates), TEMPLATES)]
    best = F.max(F.struct("containment", (-F.col("start_word")).alias("from"), (-F.col("template_id")).alias("template"), "end_word"))
    rows = reduce(DataFrame.unionAll, parts).groupBy("doc_id", "license").agg(F.countDistinct("template_id", "at").alias("n_windows"), best.alias("best"))
    return rows.select("doc_id", "license", "n_windows", "best.containment", (-F.col("best.from")).alias("start_word"), "best.end_word")


def _found(texts: DataFrame, index: DataFrame) -> DataFrame:
    values = sorted({r["value"] for r in index.select("value").collect()})
    reach = 2 * index.agg(F.max("n")).first()[0]
    literal = "array(" + ", ".join(f"{v}L" if v > -(1 << 63) else "(-9223372036854775807L - 1L)" for v in values) + ")"
    hashed = _shingled(texts).filter(F.expr(f"arrays_overlap(hashes, {literal})"))
    places = F.expr(f"filter(transform(hashes, (x, i) -> if(array_contains({literal}, x), i, -1)), i -> i >= 0)")
    around = F.expr(f"transform(places, i -> struct(i as place, hashes[i] as value, greatest(i - {reach}, 0) as low, slice(hashes, greatest(i - {reach}, 0) + 1, {2 * reach}) as near))")
    hits = hashed.withColumn("places", places).select("doc_id", F.explode(around).alias("hit")).select("doc_id", "hit.*")
    met = hits.join(F.broadcast(index), "value").withColumn("at", F.explode(F.expr("filter(array(place div n * n, (place div n - 1) * n), a -> a >= 0)")))
    size = f"2 * n - {SHINGLE - 1}"
    window = met.withColumn("window", F.expr(f"slice(near, cast(at - low + 1 as int), {size})")).filter(f"place < at + {size}")
    collide = window.filter(F.expr("array_min(transform(window, s -> xxhash64(s, band))) = xxhash64(value, band)"))
    shared = collide.dropDuplicates(["doc_id", "template_id", "at"]).withColumn("shared", F.size(F.array_intersect("window", "shingles")))
    held = shared.withColumn("containment", F.col("shared") / F.size("shingles")).filter(F.col("containment") >= CONTAINED)
    spots = held.withColumn("spots", F.expr("filter(transform(window, (s, i) -> if(array_contains(shingles, s), i, -1)), i -> i >= 0)"))
    start, end = F.col("at") + F.array_min("spots"), F.col("at") + F.array_max("spots") + SHINGLE
    return spots.select("doc_id", "license", "template_id", F.col("at").cast("long").alias("at"), "containment", start.cast("long").alias("start_word"), end.cast("long").alias("end_word"))

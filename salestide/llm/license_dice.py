"""Licence scanning by Dice coefficient over word bigrams.

A text is cut into units (its lines, its paragraphs and the whole text);
each is normalised (lower case, runs of other characters than a-z0-9 to one
space) and compared with licence templates: 2 * shared / (bigrams of the unit
+ bigrams of the template), over sets of adjacent word pairs.  Templates
whose size rules the threshold out are pruned before any comparison, and a
text is only cut up if it holds a word without which no template can reach
the threshold.  DataFrame functions only; no shuffle.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
    "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. ")
_BSD_TAIL = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR "
    "ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED "
    "TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
    "POSSIBILITY OF SUCH DAMAGE.")

# Well-known licence notices (SPDX id, notice).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
     "file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
     "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
     "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
     "language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
     "and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
     "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
     "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
     "furnished to do so, subject to the following conditions: The above copyright notice and this "
     "permission notice shall be included in all copies or substantial portions of the Software."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of "
     "the GNU General Public License as published by the Free Software Foundation, either version 3 of "
     "the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the "
     "LICENSE file."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
     "without fee is hereby granted, provided that the above copyright notice and this permission notice "
     "appear in all copies."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
     "International License."),
    # the titles of the long licences, a paragraph of their own in the full texts
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    # whole bodies
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + "3. Neither the name of the copyright holder nor the names of its "
     "contributors may be used to endorse or promote products derived from this software without specific "
     "prior written permission. " + _BSD_TAIL),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def normalised(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).strip()


def bigrams(text: str) -> list[str]:
    words = normalised(text).split(" ")
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def size_bounds(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Sizes of sets whose Dice coefficient with a set of ``n`` can reach the threshold."""
    return (math.ceil(n * threshold / (2 - threshold) - 1e-9),
            math.floor(n * (2 - threshold) / threshold + 1e-9))


def anchor_words(templates=TEMPLATES, threshold: float = THRESHOLD) -> list[str]:
    """Words one of which every match must hold: fewer bigrams of a template
    are free of them than a match shares at least."""
    chosen: list[str] = []
    for _, text in templates:
        grams = bigrams(text)
        least = math.ceil(threshold * (len(grams) + size_bounds(len(grams), threshold)[0]) / 2 - 1e-9)
        free = [g for g in grams if not set(g.split()) & set(chosen)]
        while len(free) >= least:
            words = sorted({w for g in free for w in g.split()},
                           key=lambda w: (-sum(w in g.split() for g in free) * (len(w) > 5), -len(w), w))
            chosen.append(words[0])
            free = [g for g in free if words[0] not in g.split()]
    return chosen


def _norm(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def _has_anchor(c: Column, words: list[str]) -> Column:
    test = c.contains(words[0])
    for w in words[1:]:
        test = test | c.contains(w)
    return test


def license_matches(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, license (best match, ties to the
    template listed first; null if none), dice (of it; 0 if none), licenses
    (all matched ids, sorted, comma-joined), n_matches (of them).

    Null and empty texts match nothing; null ids and repeated rows are kept;
    an empty table gives no rows; other columns are ignored.
    """
    anchors = anchor_words(templates, threshold)
    grams = [bigrams(t) for _, t in templates]
    bounds = [size_bounds(len(g), threshold) for g in grams]
    table = F.array(*[F.struct(
        F.lit(-i).alias("rank"), F.lit(name).alias("id"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"),
        F.array(*[F.lit(x) for x in g]).alias("grams"))
        for i, ((name, _), g, (lo, hi)) in enumerate(zip(templates, grams, bounds))])
    least, most = min(lo for lo, _ in bounds), max(hi for _, hi in bounds)

    text = F.coalesce(F.col(text_col), F.lit(""))
    lower = docs.select(F.col(id_col).alias("doc_id"), F.lower(text).alias("t"))
    units = F.array_distinct(F.concat(F.split("t", "\n", -1), F.split("t", "\n[ \t]*\n", -1), F.array("t")))
    words = F.transform(F.filter(units, lambda u: _has_anchor(u, anchors)), lambda u: F.split(_norm(u), " ", -1))
    pairs = F.transform(
        F.filter(words, lambda w: F.size(w) > least),
        lambda w: F.array_distinct(F.transform(
            F.slice(w, 1, F.size(w) - 1), lambda x, i: F.concat_ws(" ", x, w[i + 1]))))
    sized = F.filter(pairs, lambda p: (F.size(p) >= least) & (F.size(p) <= most))

    def against(p):
        fit = F.filter(table, lambda t: (F.size(p) >= t["lo"]) & (F.size(p) <= t["hi"]))
        return F.transform(fit, lambda t: F.struct(
            (F.lit(2.0) * F.size(F.array_intersect(p, t["grams"])) / (F.size(p) + F.size(t["grams"])))
            .alias("dice"), t["rank"].alias("rank"), t["id"].alias("id")))

    found = F.filter(F.flatten(F.transform(sized, against)), lambda m: m["dice"] >= threshold)
    none = F.array().cast("array<struct<dice:double,rank:int,id:string>>")
    hits = lower.select("doc_id", F.when(_has_anchor(F.col("t"), anchors), found).otherwise(none).alias("m"))
    best = F.array_max("m")
    ids = F.array_sort(F.array_distinct(F.transform("m", lambda m: m["id"])))
    return hits.select("doc_id", best["id"].alias("license"),
                       F.coalesce(best["dice"], F.lit(0.0)).alias("dice"),
                       F.array_join(ids, ",").alias("licenses"), F.size(ids).cast("long").alias("n_matches"))

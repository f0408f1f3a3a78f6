"""Licence scan: TF-IDF cosine of lines, blocks and files to licences, then inheritance by directory.

Everything runs in DataFrame operations. Weights use the document frequency, over all files, of
each word of the templates; a word outside them weighs as one that no file has. A line can only
reach the threshold against a template if it holds one of the template's heavier words (the
others together have a squared weight below the squared threshold, and the cosine is at most
the norm of the shared part), so lines without such a word are not scored.

Lines are compared with the notices of ``TEMPLATES``. Words of consecutive lines, in windows of a
template's length that start every eighth of it, and whole files are compared with those and with
``BLOCKS``: headers, full texts of the short licences, openings of the long ones. Only files that
hold enough of a template's weight to reach the threshold are scored. Scores are computed inside
the row, from words coded as numbers: no word of a line or window is shuffled.
Templates of fewer than ``LEAST_WINDOW`` words are compared with lines and files alone. A match of
``LONG`` words or more comes before a shorter one.

A licence file is one named like it, one with an opening of a licence, or one of which licence
lines, or a block, make up ``FILE_SHARE`` of the words. Files without a licence line of their own take that of the nearest directory, their own
or one above, that holds a licence file.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import stored

THRESHOLD = 0.75
FILE_SHARE = 0.25
LEAST_WINDOW = 5
LONG = 20
FILE_NAMES = r"(?i)^(licen[cs]e|copying|unlicense|notice)([._-].*)?$"
SPLIT = r"[^\p{L}\p{N}]+"

# The usual notices of common licences, by SPDX name.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License "
                   "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation, "
                "either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated this work to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("LicenseRef-AllRightsReserved", "All rights reserved."),
)


_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
    "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
    "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
    "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. ")
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. ")
_BSD_TAIL = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_GNU_HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General Public "
    "License as published by the Free Software Foundation, either version {1} of the License, or (at your option) any "
    "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
    "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0}General Public License for "
    "more details. You should have received a copy of the GNU {0}General Public License along with this program. If not, "
    "see <https://www.gnu.org/licenses/>.")
_GNU_OPENING = (
    "GNU {0}GENERAL PUBLIC LICENSE Version {1}, {2} Copyright (C) {3} Free Software Foundation, Inc. Everyone is permitted "
    "to copy and distribute verbatim copies of this license document, but changing it is not allowed.")

# Openings of texts too long to be held here whole.
OPENINGS = (
    ("GPL-3.0", _GNU_OPENING.format("", 3, "29 June 2007", 2007)),
    ("GPL-2.0", _GNU_OPENING.format("", 2, "June 1991", "1989, 1991")),
    ("LGPL-3.0", _GNU_OPENING.format("LESSER ", 3, "29 June 2007", 2007)),
    ("AGPL-3.0", _GNU_OPENING.format("AFFERO ", 3, "19 November 2007", 2007)),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
                   "REPRODUCTION, AND DISTRIBUTION 1. Definitions."),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal "
                "entity that creates, contributes to the creation of, or owns Covered Software."),
)
# Titles, headers and full texts, by SPDX name.
BLOCKS = OPENINGS + (
    ("MIT", "MIT License"),
    ("MIT", "Licensed under the MIT License. See LICENSE file in the project root for full license information."),
    ("MIT", _MIT),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_NAMES + _BSD_TAIL),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
            "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
            "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
            "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
            "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
            "USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("GPL-3.0", _GNU_HEADER.format("", 3)),
    ("GPL-2.0", _GNU_HEADER.format("", 2)),
    ("LGPL-3.0", _GNU_HEADER.format("Lesser ", 3)),
    ("AGPL-3.0", _GNU_HEADER.format("Affero ", 3)),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                  "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
                  "binary, for any purpose, commercial or non-commercial, and by any means."),
)


def template_words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def vocabulary(templates=TEMPLATES) -> list[str]:
    return sorted({w for _, text in templates for w in template_words(text)})


def weigh(templates, files: int, holding: dict[str, int]) -> tuple[dict[str, float], list[tuple], list[str]]:
    """idf by word, (template, licence, word, weight) rows, and the words that a match needs one of."""
    idf = {w: math.log((1 + files) / (1 + holding.get(w, 0))) + 1 for w in vocabulary(templates)}
    rows, needed = [], set()
    for i, (licence, text) in enumerate(templates):
        raw = {w: n * idf[w] for w, n in Counter(template_words(text)).items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        rest = 1.0
        for w, v in sorted(raw.items(), key=lambda x: (-x[1], x[0])):
            rows.append((i, licence, w, v / norm))
            if rest >= THRESHOLD ** 2 - 1e-9:
                needed.add(w)
            rest -= (v / norm) ** 2
    return idf, rows, sorted(needed)


def _words(text):
    return F.filter(F.split(F.lower(text), SPLIT), lambda w: w != "")


def _literals(rows: list[tuple], schema: str):
    """A small frame out of literals, one row per template."""
    from pyspark.sql import SparkSession

    names = [c.split()[0] for c in schema.split(",")]
    structs = F.array(*(F.struct(*(
        (F.array(*map(F.lit, v)).cast("array<long>") if isinstance(v, list) else F.lit(v)).alias(n)
        for n, v in zip(names, row))) for row in rows))
    return SparkSession.getActiveSession().range(1).select(F.inline(structs))


def _table(values: list, kind: str):
    """A constant array, looked up by position."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def _coded(words, vocabulary_):
    """Words as numbers: the place in the vocabulary, from 1 on, or a negative hash outside it."""
    return F.transform(words, lambda w: F.coalesce(
        F.nullif(F.array_position(vocabulary_, w), F.lit(0).cast("long")),
        -1 - F.shiftrightunsigned(F.xxhash64(w), 1)))


class _Scorer:
    """Cosines of coded words with templates, as expressions inside a row."""

    def __init__(self, words: list[str], templates: tuple, files: int, holding: dict[str, int]):
        idf, self.weights, self.needed = weigh(templates, files, holding)
        self.other = math.log(1 + files) + 1
        self.n = len(templates)
        weight = [idf.get(w, self.other) for w in words]
        product = [[0.0] * self.n for _ in words]
        place = {w: i for i, w in enumerate(words)}
        for t, _, w, value in self.weights:
            product[place[w]][t] = idf[w] * value
        self.squares = _table([v * v for v in weight], "array<double>")
        self.products = _table(product, "array<array<double>>")

    def norm(self, codes):
        """Length of a unit's vector: a word seen for the k-th time adds 2k - 1 of its squared weight."""
        start = F.struct(F.lit(0).cast("long").alias("word"), F.lit(0).alias("k"), F.lit(0.0).alias("total"))

        def add(state, c):
            k = F.when(state["word"] == c, state["k"] + 1).otherwise(1)
            square = F.when(c > 0, F.element_at(self.squares, c.cast("int"))).otherwise(self.other ** 2)
            return F.struct(c.alias("word"), k.alias("k"), (state["total"] + square * (2 * k - 1)).alias("total"))

        return F.aggregate(F.array_sort(codes), start, add, lambda state: F.sqrt(state["total"]))

    def matches(self, codes, norm, wanted, threshold: float):
        """Array of (template, score) of the ``wanted`` templates that reach the threshold."""
        known = F.filter(codes, lambda c: c > 0)

        def score(t):
            product = F.aggregate(known, F.lit(0.0), lambda total, c: total + F.get(
                F.element_at(self.products, c.cast("int")), t))
            return F.struct(t.alias("template"), F.round(product / norm, 6).alias("score"))

        return F.filter(F.transform(wanted, score), lambda m: m["score"] >= threshold)


def _line_matches(docs: DataFrame, scorer: _Scorer, templates: tuple, threshold: float) -> DataFrame:
    """(path, mark, short, s, licence, licence_words, opening) of files with licence lines."""
    need = F.array(*(F.lit(c).cast("long") for c in scorer.needed_codes))
    lines = docs.select("path", "mark", F.posexplode("lines").alias("line", "codes")).where(F.arrays_overlap("codes", need))
    every = F.sequence(F.lit(0), F.lit(scorer.n - 1))
    scored = lines.withColumn("norm", scorer.norm(F.col("codes"))).select(
        "path", "mark", "line", F.size("codes").alias("n"),
        F.explode(scorer.matches(F.col("codes"), F.col("norm"), every, threshold)).alias("match"))
    names = F.array(*(F.lit(licence) for licence, _ in templates))
    best = F.struct((-F.col("match.score")).alias("s"), F.get(names, F.col("match.template")).alias("licence"))
    # A line of a repeated row counts once.
    matched = scored.groupBy("path", "mark", "line").agg(F.min(best).alias("best"), F.max("n").alias("n"))
    return matched.groupBy("path", "mark").agg(F.min("best").alias("best"), F.sum("n").alias("licence_words")).select(
        "path", "mark", F.lit(1).alias("short"), "best.s", "best.licence", "licence_words", F.lit(False).alias("opening"))


def _block_matches(docs: DataFrame, scorer: _Scorer, blocks: tuple, notices: int, threshold: float) -> DataFrame:
    """(path, mark, short, s, licence, licence_words, opening) of windows, titles and files that match.

    Units are made and scored inside the row, each against the templates its file may match;
    only matches leave it.
    """
    sizes = [len(template_words(text)) for _, text in blocks]
    openings = range(notices, notices + len(OPENINGS))
    shape = F.broadcast(_literals(
        [(t, n, max(1, n // 8), t in openings, blocks[t][0], scorer.heaviest[t]) for t, n in enumerate(sizes)],
        "template int, size int, step int, opening boolean, licence string, first array<long>"))
    docs = docs.where(F.size("near") > 0)
    whole = docs.select("path", "mark", "near", F.flatten("lines").alias("codes"))

    # A window needs one of its template's heaviest words.
    size, step = F.col("size"), F.col("step")
    hits = F.filter(F.transform("codes", lambda c, at: F.when(F.array_contains("first", c), at)), lambda at: at.isNotNull())
    starts = F.array_distinct(F.flatten(F.transform("hits", lambda at: F.sequence(
        F.greatest(F.lit(0).cast("long"), F.floor((at - size) / step) + 1), F.floor(at / step)))))
    windows = whole.select("path", "mark", "near", F.explode("near").alias("template"), "codes").join(shape, "template") \
        .where(size >= LEAST_WINDOW).withColumn("hits", hits) \
        .select("path", "mark", "near", "size", "step", "codes", F.explode(starts).alias("start")) \
        .select("path", "mark", F.lit("window").alias("kind"), "near", size.alias("n"),
                F.slice("codes", (F.col("start") * step + 1).cast("int"), size).alias("codes"))
    titles = docs.where(F.exists("near", lambda t: t.isin([i for i, n in enumerate(sizes) if n < LEAST_WINDOW]))).select(
        "path", "mark", "near", F.explode("lines").alias("codes")).where(
        F.size("codes").between(1, 2 * LEAST_WINDOW)).select(
        "path", "mark", F.lit("line").alias("kind"), "near", F.size("codes").alias("n"), "codes")
    every = whole.select("path", "mark", F.lit("file").alias("kind"), "near", F.size("codes").alias("n"), "codes")
    scored = windows.unionByName(titles).unionByName(every).withColumn("norm", scorer.norm(F.col("codes"))).select(
        "path", "mark", "kind", "n",
        F.explode(scorer.matches(F.col("codes"), F.col("norm"), F.col("near"), threshold)).alias("match"))
    found = scored.select("path", "mark", "kind", "n", "match.template", "match.score").join(shape, "template") \
        .where((F.col("kind") != "window") | (size >= LEAST_WINDOW))
    return found.groupBy("path", "mark").agg(
        F.min(F.struct(F.when(size >= LONG, 0).otherwise(1).alias("short"), (-F.col("score")).alias("s"), "licence")).alias("best"),
        F.max("n").cast("long").alias("licence_words"), F.max("opening").alias("opening")).select(
            "path", "mark", "best.short", "best.s", "best.licence", "licence_words", "opening")


def _candidates(rows: DataFrame, words: list[str], vocabulary_, of_lines: _Scorer, of_blocks: _Scorer,
                threshold: float) -> DataFrame:
    """(path, mark, near, lines): files that may match, as coded lines, with the block templates in reach.

    A cosine is at most the norm of what is shared, so a file is near a template only if the
    words they share carry the squared threshold of the template's weight.
    """
    limit = threshold ** 2 - 1e-9
    place = {w: i for i, w in enumerate(words)}
    shares = [[0.0] * of_blocks.n for _ in words]
    of_blocks.heaviest = [[] for _ in range(of_blocks.n)]
    rest = [1.0] * of_blocks.n
    for t, _, w, value in of_blocks.weights:  # by template, the heaviest words first
        shares[place[w]][t] = value * value
        if rest[t] >= limit:
            of_blocks.heaviest[t].append(place[w] + 1)
        rest[t] -= value * value
    of_lines.needed_codes = [place[w] + 1 for w in of_lines.needed]
    share_of = _table(shares, "array<array<double>>")
    sums = F.aggregate("held", F.array_repeat(F.lit(0.0), of_blocks.n), lambda total, w: F.zip_with(
        total, F.element_at(share_of, F.array_position(vocabulary_, w).cast("int")), lambda a, b: a + b))
    near = F.filter(F.transform(sums, lambda s, i: F.when(s >= limit, i)), lambda i: i.isNotNull())

    def any_of(scorer):
        return F.arrays_overlap("held", F.array(*(F.lit(w) for w in scorer.needed)))

    found = rows.select("path", "text", F.array_intersect(_words(F.col("text")), vocabulary_).alias("held"))
    found = found.where(any_of(of_lines) | any_of(of_blocks)) \
        .select("path", "text", any_of(of_lines).alias("line"), near.alias("near")).where("line or size(near) > 0")
    return stored(found.select(
        "path", F.xxhash64("text").alias("mark"), "near",
        F.transform(F.split("text", "\n"), lambda line: _coded(_words(line), vocabulary_)).alias("lines")))


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", templates=TEMPLATES,
         threshold: float = THRESHOLD) -> DataFrame:
    """One row per distinct file (path and text): path, mark, licence, score, origin, from_dir.

    ``mark`` is a hash of the text, to tell texts under one path apart. ``licence`` is that of
    the line or block with the highest cosine (long blocks first, then the first name) with ``origin`` ``header``, or the
    nearest directory's with ``origin`` ``inherited`` and ``from_dir``; null if there is none.
    A null path is the empty path, a null or empty text has no licence line; repeated rows
    count once; no files give no rows.
    """
    rows = files.select(F.coalesce(F.col(f"`{path_col}`").cast("string"), F.lit("")).alias("path"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    blocks = (*templates, *BLOCKS)
    listed = vocabulary(blocks)
    words = F.array(*(F.lit(w) for w in listed))
    split = _words(F.col("text"))
    held = stored(rows.select("path", F.xxhash64("text").alias("mark"), F.size(split).alias("words"),
                              F.array_intersect(split, words).alias("held")))
    holding = {r["word"]: r["n"] for r in held.select(F.explode("held").alias("word")).groupBy("word")
               .agg(F.count("*").alias("n")).collect()}
    files = held.count()
    of_lines, of_blocks = _Scorer(listed, templates, files, holding), _Scorer(listed, blocks, files, holding)
    docs = _candidates(rows, listed, words, of_lines, of_blocks, threshold)
    by_line = _line_matches(docs, of_lines, templates, threshold)
    by_block = _block_matches(docs, of_blocks, blocks, len(templates), threshold)
    own = stored(by_line.unionByName(by_block).groupBy("path", "mark").agg(
        F.min(F.struct("short", "s", "licence")).alias("best"), F.max("licence_words").alias("licence_words"),
        F.max("opening").alias("opening")).select(
            "path", "mark", F.col("best.licence").alias("licence"), (-F.col("best.s")).alias("score"),
            "licence_words", "opening"))

    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    sizes = held.select("path", "mark", "words").distinct()
    licence_files = own.join(sizes, ["path", "mark"]).where(
        F.element_at(F.split("path", "/"), -1).rlike(FILE_NAMES) | F.col("opening")
        | (F.col("licence_words") >= FILE_SHARE * F.col("words")))
    folders = licence_files.groupBy(folder.alias("from_dir")).agg(
        F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("best")).select(
        "from_dir", F.col("best.licence").alias("inherited"), (-F.col("best.s")).alias("inherited_score"))

    parts = F.split("dir", "/")
    above = held.select(folder.alias("dir")).distinct().select(
        "dir", F.explode(F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(F.concat(
            F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(
                F.slice(parts, F.lit(1), n), "/"))))).alias("from_dir"))
    nearest = above.distinct().join(folders, "from_dir").groupBy("dir").agg(
        F.max(F.struct(F.length("from_dir").alias("depth"), "from_dir", "inherited", "inherited_score")).alias("near")) \
        .select("dir", "near.from_dir", "near.inherited", "near.inherited_score")
    every = held.select("path", "mark").distinct().withColumn("dir", folder)
    found = every.join(own.drop("licence_words", "opening"), ["path", "mark"], "left").join(stored(nearest), "dir", "left")
    mine = F.col("licence").isNotNull()
    return found.select(
        "path", "mark", F.coalesce("licence", "inherited").alias("licence"),
        F.coalesce("score", "inherited_score").alias("score"),
        F.when(mine, "header").when(F.col("inherited").isNotNull(), "inherited").alias("origin"),
        F.when(~mine, F.col("from_dir")).alias("from_dir"))

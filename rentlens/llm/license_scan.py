"""Licence scan: headers, licence files and statements compared with licence templates by sparse TF-IDF cosine, then inherited down the directories.

A text is compared in three ways: whole, as its paragraphs (blocks between blank lines, where a line of nothing but
comment marks is blank) and as its statements (lines and sentences). Templates are the SPDX line, the usual statements,
the standard header and, of the short licences, the full text, each whole and by paragraph; whole texts and paragraphs are
compared with these last alone, as a statement does not stand for a block around it. Vectors have weight
(1 + ln tf) · idf per term; document frequencies are counted over the templates, where a term of no template is never seen, so a score
depends on neither the table's size nor its other rows. A text has the licence of its most similar template if that
reaches ``MIN_SCORE``; other licences stay unknown. Only parts with one of the ``key_terms`` of their templates are
scored: a part without any of them has a score below ``MIN_SCORE`` with every template, so this loses nothing.

A file whose name says so (LICENSE, COPYING, NOTICE), or whose first statement or paragraph is one, is a licence file
and speaks for its directory; a file without an own licence inherits from the
nearest directory above it that has one, by joins on paths. Only DataFrame functions are used. Broadcast are the
templates and their terms, which are fixed values.

Defined cases: a null text counts as empty; files of one path are one file; of equal scores the licence first in the
alphabet counts, of a directory's licence files the one with the best score, then the first path; a path without a slash
lies in the top directory ``""``; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.llm.common import empty_if_null, materialise, shuffle_partitions

MIN_SCORE = 0.6
MARKS = r"""[\x20\x09-\x0D/*#;%<>"'!-]"""
STATEMENT_END = r"[.!?][\x20\x09-\x0D]+|\n"
PARAGRAPH_END = rf"\n{MARKS}*\n"
#: What may stand before a file's head; possessive, so that it is read in one go however long it is.
BEFORE_HEAD = rf"^﻿?+[\x20\x09-\x0D]*+(?:#![^\n]*+\n)?+{MARKS}*+"
TERM = "[a-z0-9]+"
LICENSE_FILE = r"(?i)(^|/)(licen[sc]e|copying|notice)(\.[a-z]+)?$"

EVERYDAY = set("a all along an and any anyone are as at be but by can do even for from have if in into is it its may more must name no not of on one or other out see should so such that the this to used was will with you your".split())

# Licence names as SPDX writes them, with the licences' own words.
NAMES = ["Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense"]
STATEMENTS = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "You may not use this file except in compliance with the Apache License Version 2.0"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software under the terms of the GNU General Public License version 3 without any warranty"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted under the MIT License, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0"),
    ("Proprietary", "All rights reserved"),
    ("Proprietary", "Copyright, all rights reserved"),
]
_GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version {} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program. If not, see <https://www.gnu.org/licenses/>."""
_BSD_2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.
"""
_BSD_3 = """
3. Neither the name of the copyright holder nor the names of its
contributors may be used to endorse or promote products derived from
this software without specific prior written permission.
"""
_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
TEXTS = [
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""),
    ("BSD-2-Clause", _BSD_2 + _BSD_END),
    ("BSD-3-Clause", _BSD_2 + _BSD_3 + _BSD_END),
    ("GPL-2.0", _GPL.format(2)),
    ("GPL-3.0", _GPL.format(3)),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("LGPL-3.0", _GPL.format(3).replace("General Public", "Lesser General Public").replace("This program", "This library")),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means."""),
]


@functools.lru_cache(maxsize=1)
def templates() -> list[tuple[str, str]]:
    """(licence, text) of every template: SPDX lines, statements, texts, and those paragraphs of texts that one licence alone has."""
    out = [(n, f"SPDX-License-Identifier: {n}") for n in NAMES] + STATEMENTS + TEXTS
    owners: dict[str, set[str]] = {}
    for name, text in TEXTS:
        for part in text.split("\n\n"):
            owners.setdefault(part.strip(), set()).add(name)
    return out + [(name, part.strip()) for name, text in TEXTS for part in text.split("\n\n") if len(owners[part.strip()]) == 1 and part.strip() != text]


def parts(files: DataFrame) -> DataFrame:
    """``path, part, head, terms``: the statements, paragraphs and whole texts that hold a key term; ``head`` where nothing but blanks, comment marks and a ``#!`` line stands before."""
    text = empty_if_null("text")
    before = F.regexp_extract(text, BEFORE_HEAD, 0)
    # read again for each kind of part, so the few texts with a key term are written
    keyed = materialise(files.select("path", text.alias("text"), before.alias("before")).filter(F.lower("text").rlike(key_pattern())), "keyed")

    def pieces(rows: DataFrame, kind: str, end: str, keys: str) -> DataFrame:
        first = F.size(F.split("before", end)) - 1
        cut = rows.select("path", first.alias("_first"), F.posexplode(F.split("text", end)).alias("pos", "piece"))
        cut = cut.select("path", F.concat(F.lit(kind), F.col("pos")).alias("part"), (F.col("pos") == F.col("_first")).alias("head"), F.lower("piece").alias("piece"))
        return cut.filter(F.col("piece").rlike(keys))

    blocks = key_pattern(FIRST_BLOCK)
    some = keyed.filter(F.lower("text").rlike(blocks))
    whole = some.select("path", F.lit("w").alias("part"), F.lit(False).alias("head"), F.lower("text").alias("piece"))
    every = pieces(keyed, "s", STATEMENT_END, key_pattern()).unionByName(pieces(some, "p", PARAGRAPH_END, blocks)).unionByName(whole)
    return every.select("path", "part", "head", F.regexp_extract_all("piece", F.lit(TERM), F.lit(0)).alias("terms"))


@functools.lru_cache(maxsize=1)
def template_weights() -> tuple[list[tuple[str, float]], list[tuple[str, str, int, float]], float]:
    """(term, idf), (term, license, template, unit weight) and the idf of a term of no template; all fixed by ``templates``."""
    counts = [Counter(re.findall(TERM, text.lower())) for _, text in templates()]
    df = Counter(term for c in counts for term in c)
    unseen = math.log(1 + len(counts))
    idf = {term: unseen - math.log(1 + n) for term, n in df.items()}
    counts = [{term: 1 + math.log(n) for term, n in c.items()} for c in counts]
    weights = []
    for i, ((name, _), c) in enumerate(zip(templates(), counts)):
        norm = math.sqrt(sum((n * idf[term]) ** 2 for term, n in c.items()))
        weights += [(term, name, i, n * idf[term] / norm) for term, n in sorted(c.items())]
    return sorted(idf.items()), weights, unseen


#: Number of the first template that stands for a block of text; those before it are single statements.
FIRST_BLOCK = len(NAMES) + len(STATEMENTS)


@functools.lru_cache(maxsize=2)
def key_terms(first: int = 0) -> list[str]:
    """Terms of which every part that reaches ``MIN_SCORE`` with a template from number ``first`` on holds one.

    Of each template the rarest terms, everyday words last, until the weight of the others, which bounds the cosine of a
    part without any of these, is below ``MIN_SCORE``.
    """
    by_template: dict[int, list[tuple[float, str]]] = {}
    idf = dict(template_weights()[0])
    for term, _, i, unit in template_weights()[1]:
        if i >= first:
            by_template.setdefault(i, []).append((unit, term))
    keys = set()
    for terms in by_template.values():
        rest = 1.0
        for unit, term in sorted(terms, key=lambda t: (t[1] in EVERYDAY, -idf[t[1]], t[1])):
            if math.sqrt(max(rest, 0.0)) < MIN_SCORE - 1e-6:
                break
            keys.add(term)
            rest -= unit * unit
    return sorted(keys)


def any_of(words: Sequence[str]) -> str:
    """A pattern for the words with their common beginnings written once, so that a text's word is given up at its first unlike letter."""
    heads: dict[str, list[str]] = {}
    for w in words:
        heads.setdefault(w[:1], []).append(w[1:])
    branches = [c + any_of(rest) for c, rest in sorted(heads.items()) if c]
    if not branches:
        return ""
    body = branches[0] if len(branches) == 1 and "" not in heads else f"(?:{'|'.join(branches)})"
    return body + ("?" if "" in heads else "")


def key_pattern(first: int = 0) -> str:
    return f"(?:^|[^a-z0-9]){any_of(key_terms(first))}(?:$|[^a-z0-9])"


def scores(found: DataFrame) -> DataFrame:
    """``path, part, head, license, score``: the best template of each part. ``found`` is read once.

    Parts are dealt by path with their terms still together; terms are counted, weighed and compared inside these
    partitions, so that no row per term is shuffled or written.
    """
    spark = found.sparkSession
    terms, units, unseen = template_weights()
    idf = spark.createDataFrame(terms, "term string, idf double")
    weights = spark.createDataFrame(units, "term string, license string, template int, unit double")
    dealt = found.repartition(shuffle_partitions(spark), "path")
    counts = dealt.select("path", "part", "head", F.explode("terms").alias("term")).groupBy("path", "part", "head", "term").agg(F.count(F.lit(1)).alias("tf"))
    counts = counts.join(F.broadcast(idf), "term", "left").withColumn("v", (1 + F.ln("tf")) * F.coalesce("idf", F.lit(unseen)))
    # of a part's terms only those of templates, which are few, stay with its length
    known = F.collect_list(F.when(F.col("idf").isNotNull(), F.struct("term", "v"))).alias("known")
    vectors = counts.groupBy("path", "part").agg(F.max("head").alias("head"), F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("length"), known)
    fits = F.col("part").startswith("s") | (F.col("template") >= FIRST_BLOCK)
    own = vectors.select("path", "part", "head", "length", F.inline("known"))
    both = own.join(F.broadcast(weights), "term").filter(fits).groupBy("path", "part", "head", "length", "license", "template").agg(F.sum(F.col("v") * F.col("unit")).alias("dot"))
    both = both.withColumn("score", F.round(F.col("dot") / F.col("length"), 6))
    return both.groupBy("path", "part", "head").agg(F.min_by("license", F.struct(-F.col("score"), "license")).alias("license"), F.max("score").alias("score"))


def directory(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan_licenses(files: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``files`` (path, text) -> one row per distinct path: ``path, license, score, origin`` (own, inherited or null), ``from_path``."""
    best = scores(parts(files.select("path", "text"))).filter(F.col("score") >= min_score)
    own = best.groupBy("path").agg(
        F.min_by("license", F.struct(-F.col("score"), "license")).alias("license"), F.max("score").alias("score"), F.max("head").alias("head")
    )
    own = materialise(own, "own-licences")
    speaks = own.filter(F.col("head") | F.col("path").rlike(LICENSE_FILE)).withColumn("dir", directory(F.col("path")))
    of_dir = speaks.groupBy("dir").agg(F.min_by(F.struct("license", "score", "path"), F.struct(-F.col("score"), "path")).alias("given"))
    of_dir = materialise(of_dir.select(F.col("dir").alias("above"), "given.*").withColumnRenamed("path", "from_path"), "directory-licences")
    paths = files.select("path").distinct().withColumn("dir", directory(F.col("path")))
    # every directory once, with itself and all directories above it
    steps = F.split("dir", "/")
    above = F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, F.lit(1), i), "/")))
    chains = paths.select("dir").distinct().select("dir", F.explode(F.array_distinct(above)).alias("above"))
    nearest = chains.join(of_dir, "above").groupBy("dir").agg(F.max_by(F.struct("license", "score", "from_path"), F.length("above")).alias("given"))
    mine = own.select(F.col("path").alias("_path"), F.col("license").alias("_license"), F.col("score").alias("_score"))
    rows = paths.join(mine, F.col("path") == F.col("_path"), "left").join(nearest, "dir", "left")
    has = F.col("_license").isNotNull()
    return rows.select(
        "path",
        F.coalesce("_license", "given.license").alias("license"),
        F.coalesce("_score", "given.score").alias("score"),
        F.when(has, "own").when(F.col("given.license").isNotNull(), "inherited").alias("origin"),
        F.when(has, F.col("path")).otherwise(F.col("given.from_path")).alias("from_path"),
    )

"""Licences of files: sparse TF-IDF cosine to templates, then inheritance from the nearest ancestor directory (operator 9).

DataFrame functions only. Comment marks are taken off, and a text is read at five levels: whole (a licence file), blocks between
blank lines or code, paragraphs, sentences across wrapped lines, single lines. The units with a notice word become term vectors,
weighted by the inverse document frequency among the templates (short notices, full headers and full texts; the titles of the
texts that are too long to be held here), and are joined to the templates term by term. The best cosine at or above ``threshold``
on the widest level that has one names the licence a file declares, as a whole header tells licences apart that share sentences. A file that bears a licence file's name, or that consists of notices for at least
``mostly`` of its words, grants its licence to its directory. A file without a declaration takes the grant of the nearest
directory above it, found by a join of the folders with the paths of their ancestors. Equal units are scored once.

The templates are a fixed table of this module, so what is broadcast is bounded by it.

Defined results: a null or empty text declares nothing; a null path has no directory and inherits nothing; texts are read whole;
of equal cosines the first licence in alphabetical order counts; of several grants in a directory the one with the highest
cosine, then the first in alphabetical order; rows that share id and path but not the text stand for themselves; a unit that
denies a licence declares none; equal rows get equal results; an empty table gives an empty result; further columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyflow.llm.frames import let, written

# Customary notices, as the licences' own texts ask for them.
TEMPLATES = [
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work, CC0 public domain dedication"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("ISC", "Released under the ISC License."),
    ("LGPL-2.1", "under the terms of the GNU Lesser General Public License version 2.1"),
    ("LGPL-3.0", "under the terms of the GNU Lesser General Public License version 3"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

_GNU = (
    "{0} is free software{5} you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software Foundation{2} either version {3} of the License, or (at your option) any later version.",
    "{0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} for more details.",
    "You should have received a copy of the GNU {1} along with {4}{6}",
)
_SEE, _WRITE = ". If not, see <https://www.gnu.org/licenses/>.", "; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."
for _name, _title, _version, _dated in [
    ("AGPL-3.0", "Affero General Public License", "3", "Version 3, 19 November 2007"), ("GPL-2.0", "General Public License", "2", "Version 2, June 1991"), ("GPL-3.0", "General Public License", "3", "Version 3, 29 June 2007"),
    ("LGPL-2.1", "Lesser General Public License", "2.1", "Version 2.1, February 1999"), ("LGPL-3.0", "Lesser General Public License", "3", "Version 3, 29 June 2007"),
]:
    for _this, _it in [("This program", "this program"), ("This library", "this library")]:
        for _end in (_SEE, _WRITE):
            _header = [part.format(_this, _title, ",", _version, _it, ":", _end) for part in _GNU]
            TEMPLATES.append((_name, " ".join(_header)))
        TEMPLATES.append((_name, _header[0]))
    TEMPLATES.append((_name, f"GNU {_title} {_dated}"))

_MIT_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. '
    "IN NO EVENT SHALL THE AUTHORS {0}BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. '
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_PUBLIC = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
    "for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. "
    "We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. "
)
TEMPLATES += [
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 '
     'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
     "See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("BSD-2-Clause", "BSD 2-Clause License Copyright (c) All rights reserved. " + _BSD + _BSD_WARRANTY),
    ("BSD-3-Clause", "BSD 3-Clause License Copyright (c) All rights reserved. " + _BSD + _BSD_THIRD + _BSD_WARRANTY),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("ISC", "ISC License Copyright (c) Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
     'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, '
     "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("MIT", "MIT License Copyright (c) Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
     "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
     "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _MIT_WARRANTY.format("OR COPYRIGHT HOLDERS ")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Unlicense", _PUBLIC + _MIT_WARRANTY.format("") + " For more information, please refer to <https://unlicense.org>"),
]
SPDX = sorted({name for name, _ in TEMPLATES})
NOTICE = r"(?i)licen[cs]e|copyright|spdx-|public domain|permission (?:is|to)|redistribut|creative commons|endorse or promote"
# What turns a notice round.
DENIED = r"(?iU)\b(?:not|never|no longer|nicht|pas|no est[áa])\s+(?:\w+\s+){0,2}(?:re)?(?:licen[cs]ed|lizenziert|distributed|distribué|released|available|distribuido)\s+(?:\w+\s+){0,2}(?:under|unter|sous|bajo)\b"
FILE_NAME = r"(?i)(?:^|/)(?:licen[cs]e|copying|unlicense|notice)(?:[.\-_][^/]*)?$"


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def template_vectors(spark: SparkSession) -> DataFrame:
    """``template``, ``license``, ``term``, ``w``: unit vectors, weighted by tf x idf over the templates."""
    texts = TEMPLATES + [(s, f"SPDX-License-Identifier: {s}") for s in SPDX]
    fixed = [F.struct(F.lit(i).alias("template"), F.lit(name).alias("license"), F.lit(text).alias("text")) for i, (name, text) in enumerate(texts)]
    rows = spark.range(1).select(F.inline(F.array(*fixed)))
    each = rows.select("template", "license", F.explode(terms(F.col("text"))).alias("term")).groupBy("template", "license", "term").agg(F.count("*").alias("tf"))
    idf = each.groupBy("term").agg((F.log((len(texts) + 1) / (F.count("*") + 1)) + 1).alias("idf"))
    raw = each.join(idf, "term").withColumn("x", F.col("tf") * F.col("idf"))
    norm = raw.groupBy("template").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    return raw.join(norm, "template").select("template", "license", "term", "idf", (F.col("x") / F.col("norm")).alias("w"))


# Line comments; a line of code behind one, and what follows the end of a comment, begins a new block.
MARK = r"[ \t]*+(?:#|//|--|;|%)"
CODE_BEHIND = rf"(?m)(^{MARK}[^\n]*+\n)(?!{MARK})"
MARKS = r"(?m)^[ \t]*+(?:<!--+|/\*+|\*+/|\*+|//+!?|#+|--+|;+|%+|\"{3}|'{3}|(?:dnl|REM)\b)?+[ \t]*+|[ \t]*+(?:\*+/|--+>|\"{3}|'{3})[ \t]*+$"
WHOLE, BLOCK, PARAGRAPH, SENTENCE, LINE = range(5)


def notices(files: DataFrame, mostly: float) -> DataFrame:
    """``id``, ``path``, ``file``, ``share``, ``level``, ``place``, ``unit``, ``words``: the units of each level that hold a notice word.

    ``share`` is the part of all words that stands in lines and sentences with a notice word; ``unit`` is a digest of the words. A unit
    that says it is not licensed so declares nothing.
    """

    def units(texts: Column, level: int) -> Column:
        return F.transform(F.filter(texts, lambda t: t.rlike(NOTICE) & ~t.rlike(DENIED)), lambda t: F.struct(F.lit(level).alias("level"), F.array_join(terms(t), " ").alias("words")))

    def of_paragraph(paragraph: Column) -> Column:
        sentences, lines = F.split(F.regexp_replace(paragraph, r"\s+", " "), r"(?<=[.;!?]) "), F.split(paragraph, r"\n|(?<=[.;!?])\s+")
        none = F.slice(units(F.array(F.lit("")), SENTENCE), 1, 0)
        return F.concat(F.when(F.size(sentences) > 1, units(sentences, SENTENCE)).otherwise(none), F.when(F.size(lines) > 1, units(lines, LINE)).otherwise(none))

    def of_block(block: Column) -> Column:
        def inner(paragraphs: Column) -> Column:
            several = F.when(F.size(paragraphs) > 1, units(paragraphs, PARAGRAPH)).otherwise(F.slice(units(F.array(F.lit("")), PARAGRAPH), 1, 0))
            found = F.filter(paragraphs, lambda p: p.rlike(NOTICE))
            return F.concat(units(F.array(block), BLOCK), several, F.flatten(F.transform(found, of_paragraph)))

        return let(F.split(block, r"\n\s*\n"), inner)

    def of_text(x: Column) -> Column:
        blocks = F.split(F.regexp_replace(F.regexp_replace(x["text"], CODE_BEHIND, "$1\n"), r"\*/[ \t]*+\n", "*/\n\n"), r"\n[ \t\r]*+\n")
        found = F.transform(F.filter(blocks, lambda b: b.rlike(NOTICE)), lambda b: F.regexp_replace(b, MARKS, ""))
        whole = F.when(F.coalesce(x["path"].rlike(FILE_NAME), F.lit(False)) | (x["share"] >= mostly), F.array(F.regexp_replace(x["text"], MARKS, ""))).otherwise(F.array().cast("array<string>"))
        every = F.concat(units(whole, WHOLE), F.flatten(F.transform(found, of_block)))
        return F.transform(every, lambda u, place: F.struct(x["share"].alias("share"), u["level"].alias("level"), place.alias("place"), u["words"].alias("words")))

    def shared(text: Column) -> Column:
        noticed = F.filter(F.split(text, r"\n|(?<=[.;!?])\s+"), lambda t: t.rlike(NOTICE))
        return F.aggregate(noticed, F.lit(0), lambda n, t: n + F.size(terms(t))) / F.greatest(F.size(terms(text)), F.lit(1))

    given = F.struct("text", "path", shared(F.col("text")).alias("share"))
    each = files.where(F.col("text").rlike(NOTICE)).select("id", "path", "file", F.inline(let(given, of_text)))
    return each.select("id", "path", "file", "share", "level", "place", F.unhex(F.md5("words")).alias("unit"), "words")


def scored(units: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """``unit``, ``license``, ``score``: the best template of every distinct unit that reaches the threshold.

    Notices are the most repeated of all texts, so each distinct one is scored once. Its words travel as digests of eight bytes.
    """
    vectors = vectors.withColumn("h", F.xxhash64("term")).drop("term")
    rare = F.log(F.lit((len(TEMPLATES) + len(SPDX) + 1) / 1.0)) + 1  # a term of no template
    tf = units.select("unit", F.explode(F.transform(F.split("words", " "), lambda w: F.xxhash64(w))).alias("h")).groupBy("unit", "h").agg(F.count("*").alias("tf"))
    tf = tf.join(F.broadcast(vectors.groupBy("h").agg(F.first("idf").alias("idf"), F.collect_list(F.struct("template", "w")).alias("templates"))), "h", "left")
    x = F.col("tf") * F.coalesce("idf", rare)
    # the row of template -1 carries the square of the length
    square = F.array(F.struct(F.lit(-1).alias("template"), x.alias("w")))
    parts = F.transform(F.col("templates"), lambda t: F.struct(t["template"].alias("template"), t["w"].alias("w")))
    each = tf.select("unit", x.alias("x"), F.inline(F.concat(square, F.coalesce(parts, F.array().cast("array<struct<template:int,w:double>>")))))
    sums = each.groupBy("unit", "template").agg(F.sum(F.col("x") * F.col("w")).alias("dot"))
    names = F.broadcast(vectors.select("template", "license").distinct())
    ranked = sums.join(names, "template", "left").groupBy("unit")
    ranked = ranked.agg(F.max(F.when(F.col("template") == -1, F.sqrt("dot"))).alias("norm"), F.max(F.when(F.col("template") >= 0, F.struct(F.round("dot", 9).alias("dot"), _reversed("license").alias("k"), "license"))).alias("b"))
    return ranked.select("unit", F.col("b.license").alias("license"), F.round(F.col("b.dot") / F.col("norm"), 9).alias("score")).where(F.col("score") >= threshold)


def declared(files: DataFrame, threshold: float, mostly: float) -> DataFrame:
    """``id``, ``path``, ``file``, ``license``, ``score``, ``grants``: files that declare a licence."""
    vectors = written(template_vectors(files.sparkSession), "templates")
    found = written(notices(files, mostly), "notices")
    units = scored(found.groupBy("unit").agg(F.first("words").alias("words")), vectors, threshold)
    best = found.drop("words").join(units, "unit").groupBy("id", "path", "file")
    widest = F.max(F.struct((-F.col("level")).alias("wide"), "score", _reversed("license").alias("k"), "license")).alias("b")
    grants = F.col("path").rlike(FILE_NAME) | (F.col("share") >= mostly)
    return best.agg(widest, F.max("share").alias("share")).select("id", "path", "file", F.col("b.license").alias("license"), F.col("b.score").alias("score"), F.coalesce(grants, F.lit(False)).alias("grants"))


def _reversed(name: str) -> Column:
    """Sorts the other way round: of equal scores the first licence in the alphabet wins."""
    return F.transform(F.split(F.col(name), ""), lambda c: -F.ascii(c))


def _folder(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*?)/?[^/]*$", 1)


def _ancestors(folder: Column) -> Column:
    """A folder and those above it, nearest first, each with its distance."""
    return let(F.split(folder, "/"), lambda p: F.transform(F.sequence(F.lit(0), F.size(p)), lambda k: F.struct(k.alias("up"), F.array_join(F.slice(p, F.lit(1), F.size(p) - k), "/").alias("folder"))))


def scan(df: DataFrame, threshold: float = 0.6, mostly: float = 0.5, id_col: str = "id", path_col: str = "path", text_col: str = "text") -> DataFrame:
    """``id``, ``path``, ``license``, ``score``, ``origin`` (declared, inherited or none) for every row."""
    files = df.select(F.col(id_col).cast("long").alias("id"), F.col(path_col).cast("string").alias("path"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    files = files.withColumn("file", F.xxhash64("text"))  # rows that share id and path are told apart by their texts
    own = written(declared(files, threshold, mostly), "declared")
    granted = own.where("grants and path is not null").select(_folder(F.col("path")).alias("folder"), "license", "score")
    granted = granted.groupBy("folder").agg(F.max(F.struct("score", _reversed("license").alias("k"), "license")).alias("b")).select("folder", F.col("b.license").alias("theirs"))
    folders = files.where("path is not null").select(_folder(F.col("path")).alias("base")).distinct()
    above = folders.select("base", F.inline(_ancestors(F.col("base")))).join(granted, "folder")
    nearest = above.groupBy("base").agg(F.min_by("theirs", "up").alias("theirs"))
    own = own.drop("grants").withColumnsRenamed({"id": "oid", "path": "opath", "file": "ofile"})
    same = F.col("id").eqNullSafe(F.col("oid")) & F.col("path").eqNullSafe(F.col("opath")) & (F.col("file") == F.col("ofile"))
    out = files.select("id", "path", "file").join(own, same, "left").join(nearest, _folder(F.col("path")) == F.col("base"), "left")
    origin = F.when(F.col("license").isNotNull(), "declared").when(F.col("theirs").isNotNull(), "inherited").otherwise("none")
    return out.select("id", "path", F.coalesce("license", "theirs").alias("license"), "score", origin.alias("origin"))

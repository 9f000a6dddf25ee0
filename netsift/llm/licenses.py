"""Licence scans by canonical digest lookup, with DataFrame operations only.

A text is canonical after: lower case; copyright lines dropped; equivalent spellings made
one; punctuation to blanks; blanks collapsed. The SHA-256 digest of a canonical text is
hash-joined to the digests of known licence texts: the whole text must agree, so
no pattern is searched and a licence that is merely mentioned does not match.

Three units of a document are looked up: the whole text, its paragraphs (between empty
lines) and its lines. A fourth unit is runs of as many paragraphs as a known text has (``embedded``), which
finds a licence inside a longer text; runs begin only where a known text's first
paragraph stands. Copyright lines inside code comments are dropped like others.

``KNOWN`` is a fixed table of usual notices and of the full texts of MIT, ISC, BSD-2-Clause,
BSD-3-Clause, Zlib and the licences in ``licence_texts`` (Apache-2.0, Artistic-1.0, CC0-1.0,
GFDL-1.3, GPL-2.0, GPL-3.0, LGPL-2.1, LGPL-3.0, MPL-1.1, MPL-2.0, Unlicense); of the other
Creative Commons licences it has notices only. ``known_from_folder`` reads further texts
from a folder. Either is a table of some dozen rows, so broadcasting it is bounded.

Canonicalising runs once per document and keeps line breaks, and units are cut from its
result. A row per unit exists only until the join; what is shuffled are matches.

Edge cases: null texts and units that are empty when canonical match nothing; repeated rows
each count; several ids with the same text give a match each.
"""

from __future__ import annotations

from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

# Fixed values: (id, text) of known licences and notices.
KNOWN: list[tuple[str, str]] = [
    ("MIT", _MIT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("ISC", _ISC),
    ("ISC", "ISC License\n\n" + _ISC),
    ("BSD-2-Clause", "\n\n".join([_BSD_HEAD, _BSD_TAIL])),
    ("BSD-3-Clause", "\n\n".join([_BSD_HEAD, _BSD_THIRD, _BSD_TAIL])),
    ("Zlib", _ZLIB),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

# The full texts kept as files, named by licence.
KNOWN += sorted((f.name.removesuffix(".txt"), f.read_text()) for f in (files(__package__) / "licence_texts").iterdir())

# Spellings taken as one, after lower-casing.
EQUIVALENT: list[tuple[str, str]] = [
    ("licence", "license"), ("sub-license", "sublicense"), ("non-infringement", "noninfringement"),
    ("merchantibility", "merchantability"), ("organisation", "organization"), ("acknowledgement", "acknowledgment"),
    ("whilst", "while"), ("favour", "favor"), ("https:", "http:"), ("&", " and "), ("©", "(c)")]

# A line that only states a copyright, after lower-casing and equivalents.
COPYRIGHT_LINE = r"(?m)^[ \t]*(copyright|\(c\)|all rights reserved)[^\n]*$"

# Comment marks before a copyright notice.
COMMENT_MARK = r"(?m)^[ \t]*(?:#+|//+|/?\*+|--+|;+|%+)(?=[ \t]*(?:copyright|\(c\)|all rights reserved))"
BLANK_LINE = "\\n ?\\n"


def canonical(c: Column, comments: bool = False) -> Column:
    """Canonical text, line by line: line breaks stay, words of a line are single-spaced.
    ``comments``: copyright lines behind a comment mark are dropped like others."""
    c = F.lower(c)
    for a, b in EQUIVALENT:
        c = F.replace(c, F.lit(a), F.lit(b))
    if comments:
        c = F.regexp_replace(c, COMMENT_MARK, "")
    c = F.regexp_replace(c, COPYRIGHT_LINE, "")
    return F.regexp_replace(c, "[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", " ")


def _one_line(c: Column) -> Column:
    return F.btrim(F.regexp_replace(c, "[ \\n]+", " "), F.lit(" "))


def _digest(c: Column) -> Column:
    return F.sha2(c, 256)


def known_digests(spark: SparkSession, known: list[tuple[str, str]] = KNOWN, comments: bool = False) -> DataFrame:
    """(digest, license_id) of the known texts; one row per text."""
    t = spark.createDataFrame(known, "license_id string, t string")
    return t.select(_digest(_one_line(canonical(F.col("t"), comments))).alias("digest"), "license_id").distinct()


def known_from_folder(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(file name without ``.txt``, text) of each file of a folder of licence texts."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("f"), "value").collect()
    return sorted((r.f.removesuffix(".txt"), r.value) for r in rows)


def _paragraphs(c: Column) -> Column:
    """The paragraphs of a canonical text that have words, each as one line."""
    return F.filter(F.transform(F.split(c, BLANK_LINE), _one_line), lambda p: p != "")


def _runs(ps: Column, spark: SparkSession, known: list[tuple[str, str]]) -> Column:
    """Digests of the runs of paragraphs that begin like a known text and are as long."""
    t = spark.createDataFrame(known, "license_id string, t string").select(_paragraphs(canonical(F.col("t"), True)).alias("p"))
    heads: dict[str, set[int]] = {}
    for r in t.select(_digest(F.get("p", F.lit(0))).alias("head"), F.size("p").alias("n")).filter("n > 1").collect():
        heads.setdefault(r["head"], set()).add(r["n"])
    if not heads:
        return F.array().cast("array<string>")
    lengths = F.create_map(*(x for h, ns in sorted(heads.items()) for x in (F.lit(h), F.array(*map(F.lit, sorted(ns))))))

    def at(p: Column, i: Column) -> Column:
        fits = F.filter(F.coalesce(F.try_element_at(lengths, _digest(p)), F.array().cast("array<int>")),
                        lambda n: (i + n <= F.size(ps)) & (n < F.size(ps)))  # the whole text is the document
        return F.transform(fits, lambda n: _digest(F.array_join(F.slice(ps, i + 1, n), " ")))

    return F.flatten(F.transform(ps, at))


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  known: list[tuple[str, str]] = KNOWN, embedded: bool = True) -> DataFrame:
    """One row per document, unit kind (document, paragraph, line) and licence found:
    doc_id, unit, license_id, n (units of that kind with that licence).

    ``embedded`` has the unit ``paragraphs``, a licence of several paragraphs inside a
    longer text, and looks through code comments."""
    spark = docs.sparkSession
    canon = docs.filter(F.col(text).isNotNull()).select(
        F.col(doc_id).alias("doc_id"), canonical(F.col(text), embedded).alias("c"))

    def units(kind: str, parts: Column) -> Column:
        return F.transform(parts, lambda p: F.struct(F.lit(kind).alias("unit"), _digest(_one_line(p)).alias("digest")))

    paragraphs = F.when(F.regexp_like("c", F.lit("\\n ?\\n")), F.split("c", "\\n ?\\n")).otherwise(F.array())
    lines = F.when(F.instr("c", "\n") > 0, F.split("c", "\n")).otherwise(F.array("c"))
    all_units = F.concat(units("document", F.array("c")), units("paragraph", paragraphs), units("line", lines))
    if embedded:
        canon = canon.withColumn("ps", _paragraphs(F.col("c")))
        runs = F.transform(_runs(F.col("ps"), spark, known), lambda h: F.struct(F.lit("paragraphs").alias("unit"), h.alias("digest")))
        all_units = F.concat(all_units, runs)
    table = F.broadcast(known_digests(spark, known, embedded))  # a row per known text
    return (canon.select("doc_id", F.explode(all_units).alias("u")).select("doc_id", "u.unit", "u.digest")
            .join(table, "digest").groupBy("doc_id", "unit", "license_id").agg(F.count(F.lit(1)).alias("n")))

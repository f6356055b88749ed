"""License scan by canonical digests. DataFrame functions only.

A text is brought to a canonical form: lower case, copyright lines gone, every run of other characters than letters
and digits one space, equivalent spellings made equal. Its digest is looked up among the digests of known license texts
and notices. Whole texts and single lines are looked up. The known digests are a short list, so the look-up
is a hash join without a shuffle of the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A notice with or without comment marks before it. License texts themselves have lines that begin with "copyright holders", so the
#: word alone is none: a mark, a colon, "by" or a year must follow.
COPYRIGHT_LINE = (
    r"(^|\n)[ \t#*;/%!-]*(copyright([ \t]*(\(c\)|©|:|by[ \t])|[^\n]*[0-9]{4})|\(c\)|©|all rights reserved)[^\n]*"
)
NO_WORD = r"[^\p{L}\p{N}]+"

# Spellings that count as equal in license texts, after punctuation is gone.
EQUIVALENT = {
    "licence": "license",
    "licences": "licenses",
    "licenced": "licensed",
    "sub license": "sublicense",
    "non commercial": "noncommercial",
    "merchantibility": "merchantability",
    "fulfilment": "fulfillment",
    "organisation": "organization",
    "favour": "favor",
    "acknowledgement": "acknowledgment",
    "per cent": "percent",
    "https": "http",
}

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""

_BSD_SOURCE = """Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer."""

_BSD_BINARY = """Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution."""

_BSD_NAME = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""

_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF
THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def _bsd(conditions: list[str], numbered: bool) -> str:
    items = [f"{i}. {c}" if numbered else f"* {c}" for i, c in enumerate(conditions, 1)]
    opening = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:"""
    return "\n\n".join([opening, *items, _BSD_DISCLAIMER])


def _whole_texts() -> list[tuple[str, str]]:
    """Whole licenses, with the usual headings and without, lists with numbers or marks."""
    found = [("MIT", ["MIT License", "The MIT License", "The MIT License (MIT)"], _MIT), ("ISC", ["ISC License", "ISC License (ISC)", "The ISC License"], _ISC)]
    for numbered in (True, False):
        two, three = [_BSD_SOURCE, _BSD_BINARY], [_BSD_SOURCE, _BSD_BINARY, _BSD_NAME]
        found.append(("BSD-2-Clause", ["BSD 2-Clause License", "The 2-Clause BSD License"], _bsd(two, numbered)))
        found.append(("BSD-3-Clause", ["BSD 3-Clause License", "The 3-Clause BSD License"], _bsd(three, numbered)))
    return [(name, f"{heading}\n\n{text}" if heading else text) for name, headings, text in found for heading in [None, *headings]]


# License names, and notices and texts that stand for them.
KNOWN = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    *_whole_texts(),
]


def canonical(text: Column) -> Column:
    """The canonical form, empty for a text without letters and digits; NULL stays NULL."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "\n"), NO_WORD, " ")
    plain = F.concat(F.lit(" "), F.trim(plain), F.lit(" "))
    for other, one in EQUIVALENT.items():
        plain = F.replace(plain, F.lit(f" {other} "), F.lit(f" {one} "))
    return F.trim(plain)


def digest(text: Column) -> Column:
    """Digest of the canonical form; NULL for an empty one."""
    form = canonical(text)
    return F.when(form != "", F.md5(form))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(license, known_digest) of the given texts; a digest that stands for two licenses goes to the first by name."""
    texts = spark.createDataFrame(known or KNOWN, "license string, text string")
    found = texts.select("license", digest(F.col("text")).alias("known_digest")).filter("known_digest IS NOT NULL")
    return found.groupBy("known_digest").agg(F.min("license").alias("license"))


def _first_words(spark: SparkSession, known: list[tuple[str, str]] | None) -> list[str]:
    """The words that a line can begin with, as it is spelled, if its canonical form is a given text: few, as those are."""
    texts = spark.createDataFrame(known or KNOWN, "license string, text string")
    firsts = {r[0] for r in texts.select(F.split(canonical(F.col("text")), " ")[0]).distinct().collect()}
    return sorted(firsts | {other.split(" ")[0] for other, one in EQUIVALENT.items() if one.split(" ")[0] in firsts})


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: list[tuple[str, str]] | None = None) -> DataFrame:
    """One row per document: doc_id, whole_digest, whole_license, line_licenses (array), n_license_lines.

    ``whole_license`` is the license that the entire text is; ``line_licenses`` are those that single lines name, distinct
    and ascending. A NULL or empty text has no digest and no license. Rows with one id get the lines of all of them. Rows with a NULL
    id share what their lines name.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # one row per given license text, at most
    table = F.broadcast(known_digests(docs.sparkSession, known))
    lines = base.select("doc_id", F.explode(F.split("text", "\n", -1)).alias("line"))
    # a line that begins with no word of a given text cannot be one, and need not be brought to its canonical form
    first_word = F.regexp_extract(F.lower("line"), r"[\p{L}\p{N}]+", 0)
    lines = lines.filter(first_word.isin(_first_words(docs.sparkSession, known)))
    named = lines.select("doc_id", digest(F.col("line")).alias("known_digest")).join(table, "known_digest")
    per_doc = named.groupBy(F.col("doc_id").alias("of")).agg(
        F.array_sort(F.collect_set("license")).alias("line_licenses"), F.count(F.lit(1)).alias("n_license_lines")
    )
    whole = base.select("doc_id", digest(F.col("text")).alias("whole_digest"))
    whole = whole.join(table.withColumnRenamed("license", "whole_license"), F.col("whole_digest") == F.col("known_digest"), "left")
    return whole.join(per_doc, F.col("doc_id").eqNullSafe(F.col("of")), "left").select(
        "doc_id",
        "whole_digest",
        "whole_license",
        F.coalesce("line_licenses", F.array().cast("array<string>")).alias("line_licenses"),
        F.coalesce("n_license_lines", F.lit(0)).alias("n_license_lines"),
    )

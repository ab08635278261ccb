"""Licence scan by canonical digests.

A licence text and a candidate are brought to one form: lower case, without a
title, copyright statements (the word with a sign, a year or, in a line set
apart or before the licence's first words, a holder) and "all rights reserved",
with equivalent spellings made equal, and with every run of other than letters
and digits as one space, so it doesn't matter how a text is wrapped.  The SHA-256
of that form is looked up by a hash join with the digests of known licences, so
only entire texts match, never parts.  Candidates are each whole document and
each of its lines.  Built-in column functions only.

Defined results: null and empty texts, and ones with nothing left in canonical
form, match nothing; a null id is passed through and its rows count as one
document; repeated rows of an id count once a row; a document is returned only if something in it
matches; an empty table gives none.
"""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that count as one, and known licence statements and texts.
SPELLINGS = (
    ("©", "copyright"),
    ("(c)", "copyright"),
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("copyright holder", "copyright owner"),
    ("https:", "http:"),
    ("per cent", "percent"),
    ("favour", "favor"),
    ("organisation", "organization"),
)
# The same after other characters have become spaces, and names of holders within the BSD texts.
FORM_SPELLINGS = (("copyright holder", "copyright owner"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("per cent", "percent"))
HOLDERS = (
    (r"neither the name of .{1,100}? nor the names of (?:its|their|any) contributors", "neither the name of the owner nor the names of its contributors"),
    (r"this software is provided by .{1,100}? as is and any express", "this software is provided by the owner as is and any express"),
    (r"in no event shall the (?:regents|copyright owners?|author)(?: or contributors)? be liable for any direct", "in no event shall the owner be liable for any direct"),
)
TITLE = (
    r"\A[^\p{L}\p{N}]*(?:the\s+)?(?:(?:mit|isc|x11|expat|zlib|(?:new\s+|simplified\s+|modified\s+)?bsd(?:[ -][23][ -]clause)?)\b(?:[ \"]*(?:new|revised|simplified|or)\b[ \"]*)*\s+license(?:\s*\((?:mit|isc|x11|expat|zlib|bsd[ 23a-z-]*)\))?"
    r"|apache\s+license[,\s]+version\s+2\.0,\s+january\s+2004\s+(?:http://www\.apache\.org/licenses/)?"
    r"|gnu\s+(?:(?:lesser|library)\s+)?general\s+public\s+license\s+version\s+[0-9.]+,\s+[0-9]*\s*[a-z]+\s+[0-9]{4}"
    r"|mozilla\s+public\s+license,?\s+version\s+[0-9.]+|boost\s+software\s+license\s+-\s+version\s+1\.0\s+-\s+august\s+17th,\s+2003"
    r"|(?:creative\s+commons\s+legal\s+code\s+)?cc0\s+1\.0\s+universal)(?=[^\p{L}\p{N}]|\z)[^\p{L}\p{N}]*"
)
# First words after a copyright statement: where it ends if its line goes on, and what it never holds.
OPENING = (
    r"(?=\b(?:permission\s+(?:is|to)|redistribution\s+and|licensed\s+under|released\s+under|everyone\s+is|this\s+(?:program|software|library|is|work|file|license)"
    r"|all\s+rights\s+reserved|gnomovision|permission|\[this|copyright\s+(?:copyright|[0-9\[<])))"
)
HOLDER = r"(?:(?!\b(?:notice|licen|law|you\b|may|must|not\b|use\b|grant|permi|statement|redistribut))[\s\S])"
SIGNED = r"\bcopyright\s*(?:copyright\b|[0-9]{4}|[0-9]{2}yy|\[|<|\byear\b)"
STATEMENTS = (
    rf"{SIGNED}{HOLDER}{{0,200}}?{OPENING}",
    rf"\A\W*copyright\b{HOLDER}{{1,200}}?{OPENING}",
    rf"(?m)^[ \t]*{SIGNED}(?:(?!\n){HOLDER})*$",
    rf"(?:\A|\n[ \t]*\n)[ \t]*copyright\b(?:(?!\n){HOLDER}){{1,120}}(?=\n[ \t]*\n|\s*\z)",
    r"\ball\s+rights\s+reserved\b",
)
OTHER = r"[^\p{L}\p{N}]+"
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
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
SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
TEXTS = Path(__file__).parent / "licence_texts"
KNOWN = (
    ("MIT", MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", ISC),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
)


def canonical(text: Column) -> Column:
    spelled = reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), SPELLINGS, F.lower(text))
    bare = reduce(lambda t, pattern: F.regexp_replace(t, pattern, " "), STATEMENTS, F.regexp_replace(spelled, TITLE, ""))
    bare = F.when(spelled.rlike("copyright|license|rights|cc0"), bare).otherwise(spelled)  # the others have nothing to remove
    form = F.trim(F.regexp_replace(bare, OTHER, " "))
    form = reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), FORM_SPELLINGS, form)
    return reduce(lambda t, pair: F.regexp_replace(t, pair[0], pair[1]), HOLDERS, form)


def full_texts() -> list[tuple[str, str]]:
    """(licence, text) of the files of ``TEXTS``; where terms end before an appendix, also without it."""
    out = []
    for path in sorted(TEXTS.glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        out.append((path.stem, text))
        end = text.find("END OF TERMS AND CONDITIONS")
        if end >= 0:
            out += [(path.stem, text[:end]), (path.stem, text[: end + len("END OF TERMS AND CONDITIONS")])]
    return out


def known_licences(spark: SparkSession) -> DataFrame:
    """(license, text): ``KNOWN`` and the full texts, some dozens of rows whatever the documents are."""
    return spark.createDataFrame([*KNOWN, *full_texts()], "license string, text string")


def licences(documents: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license, whole, n_lines, first_line): licences whose whole text is a document or lines of it.

    ``known`` has a row (license, text) for each known text.  Lines count from 1;
    first_line is null where only the whole document matches.
    """
    digests = known.select("license", canonical(F.col("text")).alias("form")).where("form <> ''")
    digests = digests.select(F.sha2("form", 256).alias("digest"), "license").distinct()
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).where("t <> ''")
    parts = docs.select("id", F.posexplode(F.concat(F.array("t"), F.split("t", "\n", -1))).alias("line", "part"))
    # Never null, so that no filter on the digest makes it twice; no known text has the digest of an empty form.
    digest = F.coalesce(F.sha2(canonical(F.col("part")), 256), F.lit(""))
    found = parts.select("id", "line", digest.alias("digest")).join(digests, "digest")
    return found.groupBy("id", "license").agg(
        F.max(F.col("line") == 0).alias("whole"), F.count_if(F.col("line") > 0).alias("n_lines"),
        F.min(F.when(F.col("line") > 0, F.col("line"))).cast("long").alias("first_line")).withColumnRenamed("id", id_col)

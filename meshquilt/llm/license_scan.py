"""License scans (10), DataFrame functions only: canonical digest lookup.

A text is brought to a canonical form (A-Z lower-cased, copyright lines dropped, equivalent spellings
made one, everything but letters and digits turned into single blanks) and digested; an equi-join with
the digests of known licences finds texts that are a licence and nothing else. Lines that speak of a
licence get the same treatment, so that a one-line notice at the end of a document is found too.

Defined results: a null or empty text, or one that is empty in canonical form, matches nothing; repeated
rows give repeated rows; an empty table gives no rows; only doc_id and text are read. Two known licences
with one canonical form: the smaller name wins.
"""

from __future__ import annotations

import functools
import operator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Spellings held to be the same word (the first becomes the second).
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("licences", "licenses"), ("sublicence", "sublicense"), ("sub license", "sublicense"),
    ("organisation", "organization"), ("authorised", "authorized"), ("merchantibility", "merchantability"), ("non infringement", "noninfringement"),
    ("copyright owner", "copyright holder"), ("favour", "favor"), ("acknowledgement", "acknowledgment"), ("whilst", "while"), ("per cent", "percent"),
)
_SAID = ("Licensed under", "Released under", "Distributed under", "Available under", "This work is licensed under", "This software is licensed under", "This project is licensed under", "This file is licensed under")
#: One-line notices.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    *((f"CC-{k}-4.0", f"{said} CC {k} 4.0.") for k in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND") for said in _SAID),
    *((f"CC-{k}-4.0", f"This work is licensed under a Creative Commons {name} 4.0 International License.") for k, name in (
        ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))),
    *((k, f"{said} the {name}.") for k, names in (
        ("0BSD", ("BSD Zero Clause License",)), ("AGPL-3.0", ("GNU Affero General Public License, version 3",)), ("Apache-2.0", ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License")),
        ("BSD-2-Clause", ("BSD 2-Clause License",)), ("BSD-3-Clause", ("BSD 3-Clause License",)), ("GPL-2.0", ("GNU General Public License, version 2",)),
        ("GPL-3.0", ("GNU General Public License, version 3",)), ("ISC", ("ISC License",)), ("LGPL-2.1", ("GNU Lesser General Public License, version 2.1",)),
        ("LGPL-3.0", ("GNU Lesser General Public License, version 3",)), ("MIT", ("MIT License",)), ("MPL-2.0", ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0")),
        ("Unlicense", ("Unlicense",)), ("Zlib", ("zlib License",))) for name in names for said in _SAID),
)
_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY '
    "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
    "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n1. Redistributions of source code must retain the above "
    "copyright notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
    "the documentation and/or other materials provided with the distribution.\n"
)
_BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A '
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
    "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
#: Whole licence texts; the long ones are files named after the licence.
TEXTS = (
    *((p.stem, p.read_text(encoding="utf-8")) for p in sorted((Path(__file__).parent / "licenses").glob("*.txt"))),
    ("BSD-2-Clause", _BSD_2 + _BSD_END),
    ("BSD-3-Clause", _BSD_2 + _BSD_3 + _BSD_END),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n" + _ISC),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
     "copyright notice and this permission notice appear in all copies.\n" + _ISC),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
     "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
     "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\nThe above copyright notice and "
     "this permission notice shall be included in all copies or substantial portions of the Software.\n" + _WARRANTY),
)
COPYRIGHT = r"(?m)^[ \t]*(?:(?:copyright|\(c\)|©)[^\n]*(?:[0-9]{4}|\(c\)|©)[^\n]*|all rights reserved\.?[ \t]*)$"


#: What a line that COPYRIGHT drops holds one of: texts without skip that pass.
HINTS = ("copyright", "(c)", "©", "all rights reserved")


def _padded(words: str) -> str:
    return " " + words.replace(" ", "  ") + " "


def canonical(text):
    """The canonical form of a text column: words with a blank of their own on both sides, so that one of two adjacent
    spellings never takes the other's; null stays null."""
    t = F.translate(text, UPPER, LOWER)
    marked = functools.reduce(operator.or_, (F.contains(t, F.lit(h)) for h in HINTS))
    t = F.when(marked, F.regexp_replace(t, COPYRIGHT, " ")).otherwise(t)
    t = F.concat(F.lit(" "), F.trim(F.regexp_replace(t, r"[^\p{L}\p{N}]+", "  ")), F.lit(" "))
    for old, new in SPELLINGS:
        t = F.replace(t, F.lit(_padded(old)), F.lit(_padded(new)))
    return t


def digest(form):
    return F.when(form != "  ", F.sha2(form.cast("binary"), 256))


def known(spark: SparkSession, texts=TEXTS + NOTICES) -> DataFrame:
    """license, digest: one row for each canonical form. The list comes from the caller and is as large as that."""
    rows = spark.createDataFrame([*texts], "license string, text string").select("license", digest(canonical(F.col("text"))).alias("digest")).collect()
    first: dict[str, str] = {}
    for r in sorted((r for r in rows if r["digest"]), key=lambda r: r["license"]):
        first.setdefault(r["digest"], r["license"])
    return shared.literal_table(spark, [(n, d) for d, n in first.items()], ("license", "digest"))


def scan(docs: DataFrame, licences: DataFrame) -> DataFrame:
    """doc_id, digest, license (of the whole text), notices (of its lines, sorted, joined by commas; else null)."""
    lines = F.when(F.contains(F.lower("text"), F.lit("licen")), F.split("text", "\n")).otherwise(F.array().cast("array<string>"))  # most texts need no split
    speaks = F.filter(lines, lambda x: F.translate(x, UPPER, LOWER).rlike("licen[sc]e"))
    lines = F.array_compact(F.array_distinct(F.transform(speaks, lambda x: digest(canonical(x)))))
    wide = docs.select("doc_id", digest(canonical(F.col("text"))).alias("digest"), F.coalesce(lines, F.array().cast("array<string>")).alias("lines"))
    wide = wide.select("*", F.explode_outer("lines").alias("line"))
    texts = licences.select(F.col("digest").alias("_w"), F.col("license").alias("license"))
    notes = licences.select(F.col("digest").alias("_l"), F.col("license").alias("notice"))
    met = wide.join(texts, F.col("digest") == F.col("_w"), "left").join(notes, F.col("line") == F.col("_l"), "left")
    # a row of the input gave one row for each of its lines, or one: repeated rows are counted and dealt out again
    per = met.groupBy("doc_id", "digest", "lines").agg(F.first("license").alias("license"), F.sort_array(F.collect_set("notice")).alias("notes"), F.count("*").alias("n"))
    each = F.array_repeat(F.lit(1), (F.col("n") / F.greatest(F.size("lines"), F.lit(1))).cast("int"))
    return per.select("doc_id", "digest", "license", F.when(F.size("notes") > 0, F.array_join("notes", ",")).alias("notices"), F.explode(each).alias("_")).drop("_")


def op10_license_scans(spark, sf_dir: str) -> DataFrame:
    return scan(shared.table(spark, sf_dir, "documents"), known(spark))


def _form(column: str) -> str:
    t = f"translate({column}, '{UPPER}', '{LOWER}')"
    t = f"regexp_replace({t}, '{COPYRIGHT}', ' ', 'g')"
    t = f"' ' || trim(regexp_replace({t}, '[^\\p{{L}}\\p{{N}}]+', '  ', 'g'), ' ') || ' '"
    for old, new in SPELLINGS:
        t = f"replace({t}, '{_padded(old)}', '{_padded(new)}')"
    return t


_ROWS = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in TEXTS + NOTICES)
SQL = f"""
WITH k AS (SELECT d, min(n) AS n FROM (SELECT n, sha256({_form('t')}) AS d FROM (VALUES {_ROWS}) AS x(n, t)) GROUP BY d),
d AS (SELECT row_number() OVER () AS r, doc_id, text, {_form('text')} AS f FROM documents),
w AS (SELECT r, doc_id, text, CASE WHEN f <> '  ' THEN sha256(f) END AS digest FROM d),
l AS (SELECT DISTINCT r, sha256(f) AS line FROM (SELECT r, {_form('x')} AS f FROM (SELECT r, unnest(string_split(text, chr(10))) AS x FROM w)
        WHERE regexp_matches(translate(x, '{UPPER}', '{LOWER}'), 'licen[sc]e')) WHERE f <> '  '),
o AS (SELECT r, string_agg(n, ',' ORDER BY n) AS notices FROM (SELECT DISTINCT r, n FROM l JOIN k ON line = d) GROUP BY r)
SELECT doc_id, digest, k.n AS license, notices FROM w LEFT JOIN k ON digest = k.d LEFT JOIN o USING (r)
"""

"""Licence scans by canonical digest: entire texts, and entire lines, hash-joined to the digests of known licences.

Canonical form: lower case; lines of copyright notices left out; everything but letters and digits a blank; spellings
that licences use for the same word made one. All of it is SQL functions on the JVM side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Equivalent spellings, after punctuation has become blanks (fixed values).
SPELLINGS = (
    ("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"),
    ("organisation", "organization"), ("acknowledgement", "acknowledgment"), ("favour", "favor"),
    ("authorised", "authorized"), ("recognised", "recognized"), ("modelled", "modeled"),
    ("copyright holders", "copyright holder"), ("copyright owners", "copyright owner"),
)

# Known licences and notices, by their names in the SPDX list (fixed values: published texts).
_WARRANTY_MIT = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_WARRANTY_BSD = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_WARRANTY_ISC = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE.")
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution.")
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
    "and this permission notice shall be included in all copies or substantial portions of the Software. ")
KNOWN = (
    ("MIT", _MIT + _WARRANTY_MIT),
    ("MIT", "MIT License " + _MIT + _WARRANTY_MIT),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies. "
            + _WARRANTY_ISC),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted. " + _WARRANTY_ISC),
    ("BSD-2-Clause", _BSD_2 + _WARRANTY_BSD),
    ("BSD-3-Clause", _BSD_2 + " 3. Neither the name of the copyright holder nor the names of its contributors may be used to "
                     "endorse or promote products derived from this software without specific prior written permission. "
                     + _WARRANTY_BSD),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
)

# A line that begins, after comment signs, with a copyright notice.
COPYRIGHT_LINE = r"(?m)^[ \t*#/;-]*(copyright|\(c\)|©|all rights reserved)[^\n]*"
NO_WORD = r"[^\p{L}\p{N}\n]+"


def canonical_lines(text: Column) -> Column:
    """The text in canonical form, its lines still apart."""
    kept = F.regexp_replace(F.lower(text), F.lit(COPYRIGHT_LINE), F.lit(""))
    plain = F.regexp_replace(kept, F.lit(NO_WORD), F.lit(" "))
    for one, other in SPELLINGS:
        plain = F.replace(plain, F.lit(one), F.lit(other))
    return plain


def canonical(lines: Column) -> Column:
    """Canonical lines as one line."""
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def digest(canonical_text: Column) -> Column:
    return F.sha2(canonical_text, 256)


MOST_KNOWN = 10_000  # digests that are looked up in a map in each task, a megabyte; more are joined by a shuffle


def known_digests(spark: SparkSession) -> DataFrame:
    """name and digest of the known texts: a constant table of a dozen rows."""
    known = spark.createDataFrame(list(KNOWN), "licence string, text string")
    return known.select("licence", digest(canonical(canonical_lines(F.col("text")))).alias("digest")).distinct()


def scan(df: DataFrame, known: DataFrame | None = None, most_known: int = MOST_KNOWN) -> DataFrame:
    """``df`` (doc_id, text) with digest, licence and notices, a row per row of ``df``.

    ``digest`` is that of the whole canonical text; ``licence`` the known licence with that digest, or null;
    ``notices`` the names, in order and joined by commas, of known texts that are a line of the text by themselves
    (empty if none). A null text counts as empty; a text with no letter or digit is no licence. Should a digest of
    ``known`` (licence, digest) have two names, the first in order counts; null ones do not. Rows are scanned one by
    one: repeated rows stay, an empty table gives no rows, other columns are dropped.

    At most ``most_known`` digests are collected once and looked up where the text is; of more, whole texts and lines
    are joined to the table by digest, with the same result.
    """
    spark = df.sparkSession
    known = ((known if known is not None else known_digests(spark)).where("digest IS NOT NULL AND licence IS NOT NULL")
             .groupBy("digest").agg(F.min("licence").alias("licence")))
    table = [(r["digest"], r["licence"]) for r in known.limit(most_known + 1).collect()]
    if len(table) > most_known:
        return _scan_by_joins(df, known)
    names = F.create_map(*[F.lit(x) for row in table for x in row]) if table else F.map_from_arrays(
        F.array().cast("array<string>"), F.array().cast("array<string>"))
    lines = df.select("doc_id", canonical_lines(F.coalesce("text", F.lit(""))).alias("lines"))
    hashed = lines.select(
        "doc_id", digest(canonical(F.col("lines"))).alias("digest"),
        F.array_join(F.array_sort(F.array_distinct(F.filter(
            F.transform(F.split("lines", "\n"), lambda x: names[digest(F.trim(x))]), lambda x: x.isNotNull()))),
            ",").alias("notices"))
    lookup = spark.createDataFrame(table, "digest string, licence string")
    return hashed.join(F.broadcast(lookup), "digest", "left").select("doc_id", "digest", "licence", "notices")


def _scan_by_joins(df: DataFrame, known: DataFrame) -> DataFrame:
    """:func:`scan` with a ``known`` of any size. Equal texts have equal notices, so these are found once per text."""
    lines = df.select("doc_id", canonical_lines(F.coalesce("text", F.lit(""))).alias("lines"))
    hashed = lines.select("doc_id", digest(canonical(F.col("lines"))).alias("digest"), digest(F.col("lines")).alias("body"),
                          F.array_distinct(F.transform(F.split("lines", "\n"), lambda x: digest(F.trim(x)))).alias("parts"))
    parts = hashed.select("body", F.explode("parts").alias("digest")).distinct()
    notices = (parts.join(known, "digest").groupBy("body")
               .agg(F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("notices")))
    return (hashed.join(known, "digest", "left").join(notices, "body", "left")
            .select("doc_id", "digest", "licence", F.coalesce("notices", F.lit("")).alias("notices")))


def oracle() -> str:
    """The same over ``documents`` in DuckDB."""
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def lines(text: str) -> str:
        plain = f"regexp_replace(regexp_replace(lower({text}), '{COPYRIGHT_LINE}', '', 'g'), '{NO_WORD}', ' ', 'g')"
        for one, other in SPELLINGS:
            plain = f"replace({plain}, {quoted(one)}, {quoted(other)})"
        return plain

    def whole(text: str) -> str:
        return f"sha256(trim(regexp_replace({text}, '[ \\n]+', ' ', 'g')))"

    known = ", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in KNOWN)
    return f"""
    WITH known AS (
      SELECT digest, min(name) AS licence
      FROM (SELECT name, {whole(lines('body'))} AS digest FROM (VALUES {known}) t(name, body)) GROUP BY digest),
    d AS (SELECT doc_id, {lines("coalesce(text, '')")} AS lines FROM documents),
    found AS (
      SELECT doc_id, string_agg(licence, ',' ORDER BY licence) AS notices
      FROM (SELECT DISTINCT l.doc_id, k.licence
            FROM (SELECT doc_id, unnest(string_split(lines, chr(10))) AS line FROM d) l
            JOIN known k ON sha256(trim(l.line)) = k.digest) GROUP BY doc_id)
    SELECT h.doc_id, h.digest, k.licence, coalesce(f.notices, '') AS notices
    FROM (SELECT doc_id, {whole('lines')} AS digest FROM d) h
    LEFT JOIN known k ON h.digest = k.digest LEFT JOIN found f ON h.doc_id = f.doc_id"""

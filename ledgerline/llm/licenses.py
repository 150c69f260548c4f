"""Licence scan by canonical digest lookup (operator 9), in SQL functions alone.

A text's canonical form has no case, punctuation, layout or copyright lines
and one spelling of equivalent words.  The digest of the whole canonical text
is hash-joined with the digests of known licences and notices; each line of a
document is looked up in the same way, so a notice of its own line is found
inside a longer text too.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Known notices and licence texts, by identifier.
KNOWN = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>"""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""),
]
# Titles that stand above the licence texts.
TITLES = [
    ("0BSD", "BSD Zero Clause License"), ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"),
    ("ISC", "ISC License"), ("MIT", "MIT License"), ("MIT", "The MIT License"), ("MIT", "The MIT License (MIT)"), ("Zlib", "zlib License"),
]
#: Every licence text with each of its titles, too.
KNOWN += [(i, f"{title}\n{text}") for i, title in TITLES for j, text in KNOWN if i == j and len(text) > 400]

# Spellings that count as equal, by their beginnings (the second is the one kept).
EQUIVALENT = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authoris", "authoriz"), ("copyright owner", "copyright holder"), ("e mail", "email"), ("favour", "favor"),
    ("fulfilment", "fulfillment"), ("https", "http"), ("initialis", "initializ"), ("judgement", "judgment"),
    ("labour", "labor"), ("licence", "license"), ("merchantibility", "merchantability"), ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"), ("optimis", "optimiz"), ("organis", "organiz"), ("per cent", "percent"),
    ("recognis", "recogniz"), ("sub license", "sublicense"), ("whilst", "while"), ("wilful", "willful"),
]

#: Lines that name a copyright's owner or reserve rights, with comment marks before them.
COPYRIGHT_LINE = r"(^|\n)[ \t*#/;-]*(copyright[ \t]+(\(c\)|©|[0-9]|by[ \t]|<|\[)|\(c\)[ \t]|©|all rights reserved)[^\n]*"
#: Everything but letters, digits and line ends.
MARKS = r"[^\p{L}\p{N}\n]+"


def canonical_lines(text: Column) -> Column:
    """The text with each line in canonical form: a space before every word, none after the last."""
    t = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "\n")
    t = F.regexp_replace(F.concat(F.lit(" "), F.replace(t, F.lit("\n"), F.lit(" \n ")), F.lit(" ")), MARKS, " ")
    return reduce(lambda c, pair: F.replace(c, F.lit(f" {pair[0]}"), F.lit(f" {pair[1]}")), EQUIVALENT, t)


def flat(lines: Column) -> Column:
    """Canonical lines as one line."""
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def digest(flat_text: Column) -> Column:
    """SHA-256 of a canonical text; null where nothing is left of it."""
    return F.when(flat_text != "", F.sha2(flat_text, 256))


def known(spark: SparkSession, texts: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """(digest, license_id): one row a digest of the given (identifier, text) pairs, a fixed list."""
    pairs = F.array(*(F.struct(F.lit(i).alias("license_id"), F.lit(t).alias("text")) for i, t in texts))
    rows = spark.range(1).select(F.inline(pairs))
    return rows.select(digest(flat(canonical_lines(F.col("text")))).alias("digest"), "license_id").where("digest is not null").groupBy("digest").agg(F.min("license_id").alias("license_id"))


def known_from(texts: DataFrame, id_col: str = "license_id", text_col: str = "text") -> DataFrame:
    """(digest, license_id) of a table of (identifier, text) rows, for licences beyond the list; of equal texts the smallest
    identifier counts, null and empty texts give nothing.  Union it with ``known`` to scan for both."""
    rows = texts.select(digest(flat(canonical_lines(texts[text_col].cast("string")))).alias("digest"), texts[id_col].cast("string").alias("license_id"))
    return rows.where("digest is not null").groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scanned(docs: DataFrame, licenses: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, license_id, n_license_lines, line_licenses) of every document, repeats included.

    digest is of the canonical whole text (null for a null text or one of
    which nothing is left), license_id the licence whose digest it is, if any.
    n_license_lines counts the lines that are a known text by themselves,
    line_licenses lists their distinct licences in order, joined by commas
    (empty if none).  Each text is read once and its lines are looked up in
    the row, against the digests of the known licences: ``licenses`` is the
    list that ``known`` makes, of thousands of rows at most.  A very long text
    is one row; an empty table gives no rows; only the two named columns are
    read, so extra columns cannot clash.
    """
    d = docs.select(docs[id_col].alias("key"), canonical_lines(docs[text_col].cast("string")).alias("lines"))
    d = d.select("key", digest(flat(F.col("lines"))).alias("digest"), F.transform(F.split("lines", "\n"), lambda line: digest(F.trim(line))).alias("lines"))
    whole = d.join(licenses, "digest", "left")
    ids = licenses.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("digest", "license_id"))))).scalar()
    digests = licenses.agg(F.array_sort(F.collect_set("digest"))).scalar()
    found = whole.withColumns({"ids": ids, "hits": F.array_intersect(F.coalesce("lines", F.array().cast("array<string>")), digests)})
    many = F.when(F.size("hits") > 0, F.size(F.filter("lines", lambda x: F.array_contains(F.col("hits"), x)))).otherwise(0)
    names = F.when(F.size("hits") > 0, F.array_join(F.array_sort(F.array_distinct(F.transform("hits", lambda x: F.element_at(F.col("ids"), x)))), ",")).otherwise("")
    return found.select(F.col("key").alias(id_col), "digest", "license_id", many.cast("long").alias("n_license_lines"), names.alias("line_licenses"))


def oracle(texts: list[tuple[str, str]] = KNOWN) -> str:
    """The scan of ``documents`` as DuckDB SQL."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    spelled = "c"
    for a, b in EQUIVALENT:
        spelled = f"replace({spelled}, {quote(' ' + a)}, {quote(' ' + b)})"
    marks = MARKS.replace("\\n", "\n")
    return f"""
        WITH raw AS (
            SELECT row_number() OVER () AS r, doc_id, CAST(NULL AS VARCHAR) AS license_id, text FROM documents
            UNION ALL
            SELECT NULL, NULL, l, t FROM (VALUES {", ".join(f"({quote(i)}, {quote(t)})" for i, t in texts)}) k(l, t)),
        cut AS (SELECT r, doc_id, license_id, regexp_replace(' ' || replace(regexp_replace(lower(text), {quote(COPYRIGHT_LINE)}, chr(10), 'g'), chr(10), ' ' || chr(10) || ' ') || ' ', {quote(marks)}, ' ', 'g') AS c FROM raw),
        canon AS (SELECT r, doc_id, license_id, {spelled} AS c FROM cut),
        dig AS (SELECT r, doc_id, license_id, c, CASE WHEN trim(regexp_replace(c, '[ \n]+', ' ', 'g')) <> '' THEN sha256(trim(regexp_replace(c, '[ \n]+', ' ', 'g'))) END AS digest FROM canon),
        known AS (SELECT digest, min(license_id) AS license_id FROM dig WHERE r IS NULL AND digest IS NOT NULL GROUP BY digest),
        lines AS (SELECT r, unnest(string_split(c, chr(10))) AS line FROM dig WHERE r IS NOT NULL),
        hits AS (SELECT r, count(*) AS n, string_agg(DISTINCT k.license_id, ',' ORDER BY k.license_id) AS names
                 FROM lines JOIN known k ON sha256(trim(line)) = k.digest AND trim(line) <> '' GROUP BY r)
        SELECT d.doc_id, d.digest, k.license_id, coalesce(h.n, 0) AS n_license_lines, coalesce(h.names, '') AS line_licenses
        FROM dig d LEFT JOIN known k ON d.digest = k.digest LEFT JOIN hits h ON d.r = h.r
        WHERE d.r IS NOT NULL
    """

"""Licence scan by canonical digest lookup (operator 5).

A text is made canonical line by line: lower case, copyright notices left out (not the lines of a licence that begin with
"copyright holders" or the like), everything but letters and digits to one
blank, equivalent spellings to one of them. The SHA-256 digest of the canonical entire text, and of each of its
lines, is joined by hash with the digests of known licences, made canonical in the same way. Known digests of up to
BROADCAST_BYTES go to every task, so that only one row of each document is shuffled; more are joined with digests alone,
dealt to parts of each digest.

Cases: null and empty texts, and texts of copyright lines alone, have the digest of '' and no licence; repeated rows
are reported each; a line that matches more than once counts each time; licences that are equal in canonical form
are all reported (ties); a very long text is one row, never cut, its lines in one array; a notice on one line with the text is part of it; an empty table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import license_table
from tidemark.llm.common import attached, text_of, written

BROADCAST_BYTES = 64 << 20  # known digests are sent to every task up to this size
ROW_BYTES = 128             # of a digest in memory, beside its ids
NOT_WORD = r"[^\p{L}\p{N}]+"

# Words after "copyright" with which a line goes on with the text of a licence and names no holder.
PROSE = ("holder holders owner owners notice notices law laws license licenses licence licences statement statements "
         "permission permissions protection infringement interest interests status treaty treaties claim claims act and or in "
         "on of as is are was to for with under that which also line lines page material materials work works disclaimer "
         "disclaimers information rights right term terms restrictions regulations legislation has have may shall will must "
         "not if from file files management subject").split()


GAPS = r"\x00-/:-@\[-`{-\x{bf}\x{2000}-\x{206f}"


def _no_prose(words: list[str]) -> str:
    """A pattern of the beginning of a word that is none of `words`, without lookahead (DuckDB has none)."""
    heads: dict[str, list[str]] = {}
    for w in words:
        heads.setdefault(w[:1], []).append(w[1:])
    ends = [] if "" in words or words == PROSE else [rf"[{GAPS}]|$"]
    heads.pop("", None)
    return "(" + "|".join([f"[^{GAPS}{''.join(heads)}]", *ends, *(h + _no_prose(rest) for h, rest in heads.items())]) + ")"


#: a line that only says who holds the rights: "copyright" alone or before the sign, a year or a holder; "(c)" before a
#: year or "copyright", or a line of it that ends in a year or a company (else it is the third item of a list)
COPYRIGHT_LINE = (r"^[^\p{L}\p{N}(©]*(copyright([^\p{L}\p{N}]*$|[^\p{L}\p{N}]+" + _no_prose(PROSE) + ")"
                  r"|\(c\)([^\p{L}\p{N}]*($|\p{N}{4}|copyright)|[^\n]*[^\p{L}\p{N}](\p{N}{4}|all rights reserved|inc|ltd|llc|gmbh|corp"
                  r"|corporation|foundation)[^\p{L}\p{N}]*$)|©|all rights reserved)")

# Words that count as the same in licence texts (variant, kept form).
EQUIVALENTS = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"), ("emphasised", "emphasized"),
    ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"),
    ("https", "http"), ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"),
    ("labour", "labor"), ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("maximise", "maximize"),
    ("modelled", "modeled"), ("modelling", "modeling"), ("offence", "offense"), ("optimise", "optimize"),
    ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"), ("programme", "program"),
    ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"), ("utilisation", "utilization"),
    ("whilst", "while"), ("wilful", "willful"),
]

# Public licence texts and short notices, with more of both from the data table.
KNOWN = [
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
]
KNOWN += [(i, f"{title}\n{text}") for i, text in KNOWN[:4] for title in license_table.TITLES[i]]
KNOWN = list(dict.fromkeys(KNOWN + license_table.rows()))


def canonical_lines(text: Column) -> Column:
    """The canonical form of each line that is not empty in it."""
    same = F.create_map(*[F.lit(x) for pair in EQUIVALENTS for x in pair])
    words = lambda line: F.split(F.trim(F.regexp_replace(line, NOT_WORD, " ")), " ")
    lines = F.filter(F.split(F.lower(text), "\n"), lambda x: ~F.regexp_like(x, F.lit(COPYRIGHT_LINE)))
    return F.filter(F.transform(lines, lambda x: F.array_join(
        F.transform(words(x), lambda w: F.coalesce(F.element_at(same, w), w)), " ")), lambda x: x != "")


def known_licenses(spark: SparkSession) -> DataFrame:
    """license_id, text of the built-in table."""
    return spark.createDataFrame(KNOWN, "license_id string, text string")


def scan(docs: DataFrame, licenses: DataFrame) -> DataFrame:
    """doc_id, text_digest, text_license, line_licenses, n_license_lines: one row per input row.

    text_license: licences whose entire text the document is; line_licenses: those that a line of it states (both as
    sorted, comma-separated ids, '' if none).
    """
    known = written(licenses.select(F.col("license_id").cast("string"), F.sha2(F.array_join(canonical_lines(text_of()), " "), 256).alias("digest")
                            ).groupBy("digest").agg(F.array_sort(F.collect_set("license_id")).alias("ids")), "known-licenses")
    small = (known.agg(F.sum(ROW_BYTES + F.octet_length(F.array_join("ids", ",")))).first()[0] or 0) <= BROADCAST_BYTES
    units = F.concat(F.array(F.struct(F.lit(True).alias("whole"), F.sha2(F.array_join("lines", " "), 256).alias("digest"))),
                     F.transform("lines", lambda x: F.struct(F.lit(False).alias("whole"), F.sha2(x, 256).alias("digest"))))
    rows = (docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long"), text_of().alias("t"))
            .select("uid", "doc_id", F.xxhash64("doc_id", "t").alias("own"), canonical_lines(F.col("t")).alias("lines"))
            .select("uid", "doc_id", "own", F.inline(units)))
    # a common line's digest may hold any share of the rows: they stay where they are, or are dealt to parts of the digest
    found = rows.join(F.broadcast(known), "digest", "left") if small else attached(rows, known, "digest", F.col("own"), "left")
    listed = lambda x: F.array_join(F.array_sort(F.array_distinct(F.flatten(x))), ",")
    return (found.groupBy("uid").agg(
        F.first("doc_id").alias("doc_id"), F.max(F.when(F.col("whole"), F.col("digest"))).alias("text_digest"),
        listed(F.collect_set(F.when(F.col("whole"), F.col("ids")))).alias("text_license"),
        listed(F.collect_set(F.when(~F.col("whole"), F.col("ids")))).alias("line_licenses"),
        F.count(F.when(~F.col("whole") & F.col("ids").isNotNull(), 1)).alias("n_license_lines")).drop("uid"))


def oracle_sql() -> str:
    """The scan with the built-in table as one SQL statement."""
    text = lambda x: "'" + x.replace("'", "''") + "'"
    known = ", ".join(f"({text(i)}, {text(t)})" for i, t in KNOWN)
    same = "map {" + ", ".join(f"{text(a)}: {text(b)}" for a, b in EQUIVALENTS) + "}"
    lines = f"""list_filter(list_transform(list_filter(string_split(lower(t), chr(10)), lambda x: not regexp_matches(x, '{COPYRIGHT_LINE}')),
        lambda x: list_aggregate(list_transform(string_split(trim(regexp_replace(x, '{NOT_WORD}', ' ', 'g')), ' '),
             lambda w: coalesce({same}[w], w)), 'string_agg', ' ')), lambda x: x <> '')"""
    whole = "sha256(coalesce(array_to_string(lines, ' '), ''))"
    return f"""
        with k as (select id, {whole} digest from (select id, {lines} lines from (values {known}) as v(id, t))),
        d as (select doc_id, {lines} lines from (select doc_id, coalesce(text, '') t from documents)),
        w as (select doc_id, {whole} digest from d),
        l as (select doc_id, no, sha256(line) digest from (select doc_id, unnest(lines) line, generate_subscripts(lines, 1) no from d)),
        wk as (select doc_id, string_agg(distinct id, ',' order by id) ids from w join k using (digest) group by 1),
        lk as (select doc_id, string_agg(distinct id, ',' order by id) ids, count(distinct no) n from l join k using (digest) group by 1)
        select doc_id, w.digest text_digest, coalesce(wk.ids, '') text_license, coalesce(lk.ids, '') line_licenses,
               coalesce(lk.n, 0) n_license_lines
        from w left join wk using (doc_id) left join lk using (doc_id)"""

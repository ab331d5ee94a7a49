"""Operator 10: licence scans by canonical digest lookup.

A text is put in canonical form (lower case, no copyright lines, equivalent spellings made one,
punctuation and white space as single blanks) and its digest is hash-joined to the digests of known
licence texts and notices. Whole documents are looked up, and every whole line of them, since
notices stand on lines of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import joined_small, literal_rows, small

#: Spellings that licence texts use for the same thing, as listed for licence matching by SPDX.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("customised", "customized"),
    ("emphasised", "emphasized"),
    ("favour", "favor"),
    ("favourite", "favorite"),
    ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"),
    ("https", "http"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("labour", "labor"),
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("maximise", "maximize"),
    ("modelled", "modeled"),
    ("modelling", "modeling"),
    ("noncommercial", "non commercial"),
    ("offence", "offense"),
    ("optimise", "optimize"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("signalling", "signaling"),
    ("sublicence", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "wilfull"),
)

_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution.\n"
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.\n"
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions:\nThe above copyright notice and "
    "this permission notice shall be included in all copies or substantial portions of the Software.\n"
)
#: Licence identifiers with known texts and notices.
KNOWN = (
    ("MIT", "MIT License\n" + _MIT_GRANT + _WARRANTY),
    ("MIT", _MIT_GRANT + _WARRANTY),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", "ISC License\n" + _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_WARRANTY),
    ("ISC", _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_WARRANTY),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("0BSD", _ISC_GRANT + ".\n" + _ISC_WARRANTY),
    ("0BSD", "SPDX-License-Identifier: 0BSD"),
    ("BSD-2-Clause", _BSD_GRANT + _BSD_WARRANTY),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", _BSD_GRANT + _BSD_THIRD + _BSD_WARRANTY),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
)
#: A line that names a copyright holder and nothing else, or reserves all rights.
COPYRIGHT_LINE = r"(?im)^[^\p{L}\p{N}\n]*(?:(?:copyright|©)[^\p{L}\p{N}\n]*(?:\(c\)|©|[0-9]{4})[^\n]*|\(c\)[^\n]*|©[^\n]*|all rights reserved[^\p{L}\p{N}\n]*)$"
_NOT_WORD = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """The canonical form; NULL gives an empty one."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), COPYRIGHT_LINE, "")
    out = F.concat(F.lit(" "), F.regexp_replace(F.lower(out), _NOT_WORD, "  "), F.lit(" "))
    # Every word has a blank of its own on either side, so spellings are replaced as whole words.
    # Few texts hold any, and one search tells.
    unified = out
    for old, new in SPELLINGS:
        unified = F.replace(unified, F.lit(f" {old} "), F.lit(f" {new} "))
    some = out.rlike(f" (?:{'|'.join(old for old, _ in SPELLINGS)}) ")
    return F.trim(F.replace(F.when(some, unified).otherwise(out), F.lit("  "), F.lit(" ")))


def digest(text: Column) -> Column:
    return F.md5(canonical(text))


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """(known, licence): one row for each canonical digest; of equal ones the smallest name."""
    given = literal_rows(spark, list(known), ["licence", "body"])
    return given.select(digest(F.col("body")).alias("known"), "licence").groupBy("known").agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, digest, licence, line_licences.

    ``licence`` is that of the whole text, else NULL; ``line_licences`` are the distinct licences of
    whole lines in ascending order, comma-joined, else empty. NULL, empty and word-less texts have
    the digest of the empty form, which is never a licence. Repeated rows keep one row each; an
    empty table gives no rows; other columns are ignored.
    """
    empty = F.md5(F.lit(""))
    known = known.filter(F.col("known") != empty)
    fits = small(known, "known", "licence")
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Line hits depend on the text alone, so they are kept by its digest and copies share them.
    lines = texts.select(F.sha2("text", 256).alias("body"), F.explode(F.split("text", r"\r\n|[\r\n]")).alias("line"))
    hits = joined_small(lines.filter("line != ''").select("body", digest(F.col("line")).alias("known")), known, "known", "inner", fits)
    found = hits.groupBy("body").agg(F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("line_licences"))
    whole = texts.select("doc_id", F.sha2("text", 256).alias("body"), digest(F.col("text")).alias("digest"))
    named = joined_small(whole, known.withColumnRenamed("known", "digest"), "digest", "left", fits)
    return named.join(found, "body", "left").select(
        "doc_id", "digest", "licence", F.coalesce("line_licences", F.lit("")).alias("line_licences")
    )


def _canonical_sql(text: str) -> str:
    out = f"' ' || regexp_replace(lower(regexp_replace(coalesce({text}, ''), '{COPYRIGHT_LINE}', '', 'g')), '{_NOT_WORD}', '  ', 'g') || ' '"
    for old, new in SPELLINGS:
        out = f"replace({out}, ' {old} ', ' {new} ')"
    return f"md5(trim(replace({out}, '  ', ' ')))"


def oracle() -> str:
    """Licences by position in the list instead of digest joins for lines: every line against the list."""
    values = ", ".join("('{}', '{}')".format(name, body.replace("'", "''")) for name, body in KNOWN)
    return f"""
WITH k(licence, body) AS (VALUES {values}),
known AS (SELECT {_canonical_sql('body')} AS known, min(licence) AS licence FROM k GROUP BY 1),
t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT rid, unnest(regexp_split_to_array(text, '\\r\\n|[\\r\\n]')) AS line FROM t),
hits AS (SELECT rid, string_agg(DISTINCT licence, ',' ORDER BY licence) AS line_licences
         FROM (SELECT rid, {_canonical_sql('line')} AS d FROM lines) JOIN known ON d = known GROUP BY rid)
SELECT doc_id, d AS digest, licence, coalesce(line_licences, '') AS line_licences
FROM (SELECT *, {_canonical_sql('text')} AS d FROM t) LEFT JOIN known ON d = known LEFT JOIN hits USING (rid)"""

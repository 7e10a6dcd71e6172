"""Licence scan by canonical digest: whole texts against known licence texts.

The canonical form folds ASCII case, drops copyright lines, writes equivalent
spellings one way, and keeps only letters and digits, words separated by one blank. Its SHA-256 is
joined with the digests of the known texts, canonicalized by the same
expressions. Native column expressions throughout; the known table is a parameter of
bounded size.

Defined cases: null and empty texts, and those whose canonical form is empty, match
nothing; repeated rows each get a row; if two known texts share a canonical
form the first name by code point stands; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm._common import text_column

MAX_KNOWN = 10_000  # rows of the known table that may be broadcast

# Spellings that mean the same, in the order they are applied (after case folding).
SPELLINGS = [
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("copyright owner", "copyright holder"),
    ("merchantibility", "merchantability"),
    ("acknowledgement", "acknowledgment"),
    ("favour", "favor"),
    ("https://", "http://"),
    ("&", " and "),
    ("(c)", "copyright"),
    ("©", "copyright"),
]
COPYRIGHT_LINE = r"(^|\n)[^\na-z0-9]*(copyright [^\n]*[0-9]{4}|portions copyright|all rights reserved)[^\n]*"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Texts of known licences and notices.
_AS_IS = ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
          "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
          "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
          "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
          "OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC_END = ('THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
            "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
            "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
            "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
            "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_BSD_START = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided "
              "that the following conditions are met:\n1. Redistributions of source code must retain the above copyright "
              "notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary form must "
              "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
              "documentation and/or other materials provided with the distribution.\n")
_BSD_THIRD = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
              "promote products derived from this software without specific prior written permission.\n")
_BSD_END = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
            "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
            "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
            "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
            "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
            "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
            "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
            "POSSIBILITY OF SUCH DAMAGE.")
KNOWN = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           'documentation files (the "Software"), to deal in the Software without restriction, including without '
           "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
           "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
           "conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or "
           "substantial portions of the Software.\n\n" + _AS_IS,
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n"
           + _ISC_END,
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted.\n\n" + _ISC_END,
    "BSD-2-Clause": _BSD_START + _BSD_END,
    "BSD-3-Clause": _BSD_START + _BSD_THIRD + _BSD_END,
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "MIT-notice": "Licensed under the MIT License.",
}


def canonical(text: Column) -> Column:
    """Canonical form: words of ASCII letters and digits, separated by one blank."""
    out = F.translate(text, UPPER, LOWER)
    for variant, usual in SPELLINGS:
        out = F.replace(out, F.lit(variant), F.lit(usual))
    out = F.regexp_replace(out, COPYRIGHT_LINE, "\n")
    return F.btrim(F.regexp_replace(out, "[^a-z0-9]+", " "))


def known_digests(spark: SparkSession, known: dict[str, str] | None = None) -> DataFrame:
    """license_id, digest of the known texts (KNOWN by default)."""
    known = KNOWN if known is None else known
    if len(known) > MAX_KNOWN:
        raise ValueError(f"at most {MAX_KNOWN} known texts; join a larger table by digest instead")
    rows = spark.createDataFrame(sorted(known.items()), "license_id string, text string")
    return (rows.withColumn("canon", canonical(F.col("text"))).where("canon <> ''")
            .groupBy(F.sha2("canon", 256).alias("digest")).agg(F.min("license_id").alias("license_id")))


def scan_licenses(docs: DataFrame, known: dict[str, str] | None = None) -> DataFrame:
    """doc_id, canonical size, digest and licence (null if none) of every document's whole text."""
    digests = known_digests(docs.sparkSession, known).select(F.col("digest").alias("_digest"), "license_id")
    form = docs.select(F.col("doc_id").cast("long"), canonical(text_column()).alias("canon"))
    form = form.select("doc_id", F.length("canon").cast("long").alias("canonical_chars"),
                       F.when(F.col("canon") != "", F.sha2("canon", 256)).alias("digest"))
    # at most MAX_KNOWN digests of 64 bytes: checked above
    return form.join(F.broadcast(digests), F.col("digest") == F.col("_digest"), "left").drop("_digest")


def oracle_sql() -> str:
    """The same query for DuckDB over ``documents``."""
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def canon(x: str) -> str:
        out = f"translate({x}, '{UPPER}', '{LOWER}')"
        for variant, usual in SPELLINGS:
            out = f"replace({out}, {quoted(variant)}, {quoted(usual)})"
        out = f"regexp_replace({out}, {quoted(COPYRIGHT_LINE)}, chr(10), 'g')"
        return f"trim(regexp_replace({out}, '[^a-z0-9]+', ' ', 'g'))"

    rows = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in sorted(KNOWN.items()))
    return f"""
WITH known AS (
    SELECT sha256(canon) AS digest, MIN(license_id) AS license_id
    FROM (SELECT license_id, {canon('text')} AS canon FROM (VALUES {rows}) AS k(license_id, text)) WHERE canon <> ''
    GROUP BY 1),
form AS (SELECT doc_id, {canon("COALESCE(text, '')")} AS canon FROM documents)
SELECT f.doc_id, CAST(length(canon) AS BIGINT) AS canonical_chars,
       CASE WHEN canon <> '' THEN sha256(canon) END AS digest, license_id
FROM form f LEFT JOIN known k ON canon <> '' AND k.digest = sha256(canon)"""

"""Licence scan: canonical digests of texts and lines, joined to known licence digests.

DataFrame functions only.  Canonical form: A-Z lowered, copyright lines dropped,
equivalent spellings made one, every sign but digits, letters and non-ASCII a single
blank.  A text matches a licence when the digests of the canonical forms are equal; the
whole text is looked up, and each of its lines (notices stand in running texts).  Known
are whole licence texts, every SPDX identifier line and common notices; a notice may be
wrapped over several lines.  A whole text is looked up a second time with only those
copyright lines dropped that name a year or a sign, as a wrapped licence body may have
lines that begin with "copyright".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import text_column
from quayside.llm.license_texts import SPDX_IDS, WHOLE

# Short notices and the licences they name.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
)
# Further notices, which the SQL does not know.
HEADERS = (
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not "
                   "use this file except in compliance with the License."),
    ("Apache-2.0", "Licensed under the Apache License 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain "
                "one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain "
                "one at https://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("ISC", "Licensed under the ISC License."),
    ("ISC", "Released under the ISC License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
)
# Spellings that mean the same, over canonical words.
SPELLINGS = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("gnu gpl", "gnu general public license"),
    ("creative commons attribution noncommercial", "cc by nc"),
    ("creative commons attribution", "cc by"),
    ("v2 0", "version 2 0"),
    ("v3", "version 3"),
)
_COPYRIGHT = r"^[^0-9A-Za-z]*(?:copyright|\(c\)|©|all rights reserved)"
#: Copyright lines that no wrapped licence body has: with a year, a sign or a blank to fill.
_HOLDER = (r"^[^0-9a-z]*(?:(?:copyright|\(c\)|©).*(?:[0-9]{4}|\(c\)|©|<|\[)"
           r"|all rights reserved[^0-9a-z]*$)")


def _lowered(line: Column) -> Column:
    return F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(low: Column) -> Column:
    words = F.concat(F.lit(" "), F.regexp_replace(low, r"[^0-9a-z\x{80}-\x{10FFFF}]+", " "),
                     F.lit(" "))
    words = F.regexp_replace(words, " +", " ")
    for other, one in SPELLINGS:
        words = F.replace(words, F.lit(f" {other} "), F.lit(f" {one} "))
    return F.trim(words)


def canonical_line(line: Column) -> Column:
    """Canonical words of one line, joined by blanks; '' for a copyright line."""
    low = _lowered(line)
    return F.when(low.rlike(_COPYRIGHT), F.lit("")).otherwise(_words(low))


def canonical_text(text: Column) -> Column:
    """Canonical lines that are not empty, joined by blanks."""
    lines = F.transform(F.split(text, "\n"), canonical_line)
    return F.array_join(F.filter(lines, lambda x: x != ""), " ")


def _kept_copyright(text: Column) -> Column:
    """Canonical copyright lines by position that are no ``_HOLDER`` lines; else ''."""
    def kept(line):
        low = _lowered(line)
        return F.when(low.rlike(_COPYRIGHT) & ~low.rlike(_HOLDER), _words(low)).otherwise(F.lit(""))

    return F.transform(F.split(text, "\n"), kept)


def body_text(text: Column) -> Column:
    """``canonical_text`` with copyright lines dropped only where a holder is named."""
    lines = F.zip_with(F.transform(F.split(text, "\n"), canonical_line), _kept_copyright(text),
                       lambda a, b: F.concat(a, b))
    return F.array_join(F.filter(lines, lambda x: x != ""), " ")


def _digest(canonical: Column) -> Column:
    return F.sha2(canonical.cast("binary"), 256)


def spdx_notices() -> list[tuple[str, str]]:
    """The identifier line of every SPDX licence; '-only' is the licence itself."""
    return [(x.removesuffix("-only"), f"SPDX-License-Identifier: {x}") for x in SPDX_IDS]


def known_digests(spark: SparkSession, notices=NOTICES + HEADERS) -> DataFrame:
    """``(digest, license)`` of the known texts, one row per digest.

    ``notices``, the SPDX identifier lines and the whole texts of ``license_texts``.
    """
    rows = spark.createDataFrame([*notices, *spdx_notices()], "license string, known string") \
        .select(_digest(canonical_text(F.col("known"))).alias("digest"), "license")
    whole = spark.createDataFrame([(d, x) for x, digests in WHOLE.items() for d in digests],
                                  "digest string, license string")
    return rows.unionByName(whole).groupBy("digest").agg(F.min("license").alias("license"))


def _wrapped(lines: Column, notices) -> Column:
    """Licences of the notices that stand wrapped over whole lines, once per place."""
    text = F.concat(F.lit("\n"), F.array_join(lines, "\n"), F.lit("\n"))
    flat = F.concat(F.lit(" "), F.array_join(lines, " "), F.lit(" "))

    def places(flat_and_text):
        flat, text = flat_and_text["flat"], flat_and_text["text"]
        parts = []
        for name, words in notices:
            pattern = "(?<=\n)" + words.replace(" ", "[ \n]") + "(?=\n)"
            hits = F.filter(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                            lambda x: F.contains(x, F.lit("\n")))
            parts.append(F.when(F.contains(flat, F.lit(f" {words} ")),
                                F.array_repeat(F.lit(name), F.size(hits)))
                         .otherwise(F.expr("cast(array() as array<string>)")))
        return F.concat(*parts)

    none = F.expr("cast(array() as array<string>)")
    both = F.struct(flat.alias("flat"), text.alias("text"))
    # Every notice names a licence by one of these words.
    likely = F.exists(lines, lambda x: F.contains(x, F.lit("licens")) | F.contains(x, F.lit("spdx")))
    return F.when(likely, F.transform(F.array(both), places)[0]).otherwise(none)


def canonical_notices(spark: SparkSession, notices=NOTICES + HEADERS) -> list[tuple[str, str]]:
    """(licence, canonical words) of the notices: a few rows."""
    rows = spark.createDataFrame(list(notices), "license string, known string")
    found = rows.select("license", canonical_text(F.col("known")).alias("words")).distinct()
    return sorted((r["license"], r["words"]) for r in found.collect())


def scan(docs: DataFrame, known: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``text_digest``, ``text_license``, ``line_licenses``, ``n_lines`` per row.

    ``text_license`` names the licence whose text the whole text is (else null);
    ``line_licenses`` lists the licences of single lines and of notices wrapped over
    several lines, sorted, joined by commas; ``n_lines`` counts these lines, a wrapped
    notice as one.  A null or empty text has the digest of the empty
    string and no licence.  Equal rows have equal results, null keys included.
    Matched lines are joined on (key, digest of the text), hot digests are combined before
    the shuffle.
    """
    source = text_column(docs, text)
    base = docs.select(docs[key].alias("key"), source.alias("text"))
    base = base.select("key", F.transform(F.split("text", "\n"), canonical_line).alias("lines"),
                       F.when(F.lower("text").rlike(r"(?m)^[^0-9a-z\n]*copyright"), body_text(F.col("text")))
                       .alias("body"))
    base = base.select("key", F.filter("lines", lambda x: x != "").alias("lines"),
                       _digest(F.col("body")).alias("body_digest"))
    base = base.withColumn("text_digest", _digest(F.array_join("lines", " ")))
    found = F.concat(
        F.transform("lines", lambda x, i: F.struct(
            i.alias("pos"), x.alias("line"), F.lit(None).cast("string").alias("wrapped"))),
        F.transform(_wrapped(F.col("lines"), canonical_notices(docs.sparkSession)),
                    lambda x, i: F.struct((-1 - i).alias("pos"), F.lit(None).cast("string").alias("line"),
                                          x.alias("wrapped"))))
    lines = base.select("key", "text_digest", F.inline(found)) \
        .withColumn("digest", _digest(F.col("line")))
    single = lines.join(F.broadcast(known), "digest", "left") \
        .select("key", "text_digest", "pos", F.coalesce("wrapped", "license").alias("license")) \
        .filter("license is not null")
    named = single.distinct() \
        .groupBy("key", "text_digest").agg(
            F.array_join(F.array_sort(F.collect_set("license")), ",").alias("line_licenses"),
            F.count("*").alias("n_lines")) \
        .withColumnRenamed("key", "k2").withColumnRenamed("text_digest", "d2")
    rows = base.select("key", "text_digest", "body_digest")
    whole = known.select(F.col("digest").alias("text_digest"),
                         F.col("license").alias("text_license"))
    body = known.select(F.col("digest").alias("body_digest"),
                        F.col("license").alias("body_license"))
    out = rows.join(F.broadcast(whole), "text_digest", "left") \
        .join(F.broadcast(body), "body_digest", "left").join(
        named, F.col("key").eqNullSafe(F.col("k2")) & (F.col("text_digest") == F.col("d2")), "left")
    return out.select(F.col("key").alias(key), "text_digest",
                      F.coalesce("text_license", "body_license").alias("text_license"),
                      F.coalesce("line_licenses", F.lit("")).alias("line_licenses"),
                      F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"))


def scan_sql(notices=NOTICES) -> str:
    """The same scan in DuckDB SQL over ``documents``."""
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    words = r"regexp_replace(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^0-9a-z\x{80}-\x{10FFFF}]+', ' ', 'g')"
    words = f"regexp_replace(' ' || {words} || ' ', ' +', ' ', 'g')"
    for other, one in SPELLINGS:
        words = f"replace({words}, {quoted(f' {other} ')}, {quoted(f' {one} ')})"
    low = "translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    line = f"CASE WHEN regexp_matches({low}, {quoted(_COPYRIGHT)}) THEN '' ELSE trim({words}, ' ') END"
    lines = f"list_filter(list_transform(string_split(t, chr(10)), lambda l: {line}), lambda x: x <> '')"
    values = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in notices)
    return f"""
WITH known AS (
  SELECT sha256(array_to_string({lines}, ' ')) AS digest, min(license) AS license
  FROM (VALUES {values}) v(license, t) GROUP BY 1),
base AS (
  SELECT doc_id, {lines} AS lines FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
digests AS (
  SELECT doc_id, sha256(array_to_string(lines, ' ')) AS text_digest,
         list_transform(lines, lambda x: sha256(x)) AS line_digests FROM base),
named AS (
  SELECT d.doc_id, string_agg(DISTINCT k.license, ',' ORDER BY k.license) AS line_licenses,
         count(*) AS n_lines
  FROM (SELECT doc_id, unnest(line_digests) AS digest FROM digests) d
  JOIN known k USING (digest) GROUP BY 1)
SELECT d.doc_id, d.text_digest, k.license AS text_license,
       coalesce(n.line_licenses, '') AS line_licenses, coalesce(n.n_lines, 0) AS n_lines
FROM digests d LEFT JOIN known k ON k.digest = d.text_digest
LEFT JOIN named n ON n.doc_id = d.doc_id"""

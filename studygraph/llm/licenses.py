"""License scan by canonical digest: a text is brought to one canonical form, and the digest of that form is looked up
in a table of known licence digests. DataFrame functions only."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studygraph.llm.license_texts import TEXTS

# Spellings that licence texts use for the same word; the first is written, the second is kept.
SPELLINGS = {
    "licence": "license",
    "licences": "licenses",
    "licenced": "licensed",
    "sublicence": "sublicense",
    "organisation": "organization",
    "organisations": "organizations",
    "recognised": "recognized",
    "authorised": "authorized",
    "favour": "favor",
    "honour": "honor",
    "judgement": "judgment",
    "fulfil": "fulfill",
    "wilful": "willful",
    "noninfringement": "non infringement",
    "merchantibility": "merchantability",
    "sub license": "sublicense",
    "copyright owner": "copyright holder",
    "copyright owners": "copyright holders",
    "per cent": "percent",
}

# Notices by which a text states its licence, as whole lines or whole texts.
NOTICES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Released under CC0 1.0.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "MPL-2.0": "Licensed under the Mozilla Public License, version 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "proprietary": "All rights reserved.",
}

#: What the registered query knows: the notices, and the texts with and without their titles and "All rights reserved."
KNOWN = {k: ([NOTICES[k]] if k in NOTICES else []) + [f"{a}\n{b}\n{TEXTS[k][1]}" for a in {"", TEXTS[k][0]} for b in ("", "All rights reserved.")] if k in TEXTS else [NOTICES[k]] for k in NOTICES | TEXTS}

#: A line that begins so and tells a year or a mark is a copyright line and says nothing of the licence; a sentence that
#: happens to break before "copyright", or an item (c) of a list, is none.
COPYRIGHT_LINE = r"(?md)^[ \t]*(?:copyright[^\n]*(?:\(c\)|©|[12][0-9][0-9][0-9])|\(c\)[ \t]*[12][0-9][0-9][0-9]|©)[^\n]*$"
#: What is neither letter nor digit separates words.
SEPARATORS = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """The canonical form: lower case, no copyright lines, one space for every run of punctuation or white space, one
    spelling of words that have several, one space before and after. Null stands for the empty text."""
    return spelled(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, " "))


def spelled(text: Column) -> Column:
    """The canonical form of a text in lower case, copyright lines kept: it doesn't depend on where lines break. Words are
    spaced twice while spellings are replaced, so that of two words in a row both are."""
    out = F.concat(F.lit("  "), F.regexp_replace(text, SEPARATORS, "  "), F.lit("  "))
    for written, kept in SPELLINGS.items():
        out = F.replace(out, F.lit(f" {written.replace(' ', '  ')} "), F.lit(f" {kept.replace(' ', '  ')} "))
    return F.regexp_replace(out, " +", " ")


def digest(text: Column) -> Column:
    """SHA-256 of the canonical form, lower-case hex."""
    return F.sha2(F.encode(canonical(text), "UTF-8"), 256)


def known_texts(spark: SparkSession, licences: Mapping[str, str | Sequence[str]]) -> DataFrame:
    """(license_id, text) of the licences, of which each has one text or several."""
    return spark.createDataFrame([(k, t) for k, v in licences.items() for t in ([v] if isinstance(v, str) else v)], "license_id string, text string")


def known_digests(spark: SparkSession, licences: Mapping[str, str | Sequence[str]]) -> DataFrame:
    """(digest, license_id) of licence texts by id; of texts with one canonical form the smallest id stays. It has a row
    per licence given by the caller, so it is small enough to broadcast."""
    return known_texts(spark, licences).select(digest(F.col("text")).alias("digest"), "license_id").groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan_licenses(docs: DataFrame, licences: Mapping[str, str | Sequence[str]] = NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: the id, digest (of the entire text), license_id where a known licence has that digest (else
    null), and notices: the sorted distinct ids of the known licences in it in full (else empty): of those of one line that
    are a line of it, and of those of several lines whose words stand in it one after the other.

    The digest of every entire text and of every line is looked up, whatever its length. Licences of several lines are
    looked for in the whole text's words, so that other line breaks do not hide them. Null text is the empty text; it
    matches nothing unless an empty licence is given. Repeated rows give repeated results, an empty table gives no rows;
    other columns are not looked at, so their names may clash with those made here. The licences are the caller's own
    list and no data of the documents: only they are broadcast, as a hash table of digests."""
    known = known_digests(docs.sparkSession, licences)
    by_digest = F.from_json(F.lit(json.dumps({r["digest"]: r["license_id"] for r in known.collect()})), "map<string,string>")
    found = F.transform(F.split(F.coalesce(F.col("_text"), F.lit("")), "\n"), lambda line: F.try_element_at(by_digest, digest(line)))
    long = known_texts(docs.sparkSession, licences).filter(F.col("text").rlike(r"\S\s*\n\s*\S")).select("license_id", spelled(F.lower("text")).alias("form")).distinct().collect()
    long = [r for r in long if not any(x["license_id"] == r["license_id"] and x["form"] != r["form"] and x["form"] in r["form"] for x in long)]
    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text")).withColumn("digest", digest(F.col("_text")))
    if long:
        rows = rows.withColumn("_form", spelled(F.lower(F.coalesce("_text", F.lit("")))))
        found = F.concat(found, F.transform(F.filter(F.array(*[F.struct(F.lit(r["license_id"]).alias("id"), F.lit(r["form"]).alias("form")) for r in long]), lambda k: F.contains(F.col("_form"), k["form"])), lambda k: k["id"]))
    return rows.join(F.broadcast(known), "digest", "left").select(id_col, "digest", "license_id", F.array_sort(F.array_distinct(F.array_compact(found))).alias("notices"))


def spelled_sql(text: str) -> str:
    """spelled() in DuckDB SQL."""
    out = f"'  ' || regexp_replace({text}, '{SEPARATORS}', '  ', 'g') || '  '"
    for written, kept in SPELLINGS.items():
        out = f"replace({out}, ' {written.replace(' ', '  ')} ', ' {kept.replace(' ', '  ')} ')"
    return f"regexp_replace({out}, ' +', ' ', 'g')"


def canonical_sql(text: str) -> str:
    """canonical() in DuckDB SQL."""
    return spelled_sql(f"regexp_replace(lower(coalesce({text}, '')), '{COPYRIGHT_LINE.replace('(?md)', '(?m)')}', ' ', 'g')")


def scan_sql(licences: Mapping[str, str | Sequence[str]] = KNOWN) -> str:
    """scan_licenses() of documents in DuckDB SQL."""
    given = [(k, t) for k, v in licences.items() for t in ([v] if isinstance(v, str) else v)]
    values = ", ".join("('{}', '{}')".format(k.replace("'", "''"), t.replace("'", "''")) for k, t in given)
    return f"""
WITH given AS (SELECT * FROM (VALUES {values}) AS v(id, t)),
known AS (SELECT sha256({canonical_sql("t")}) AS digest, min(id) AS license_id FROM given GROUP BY 1),
forms AS (SELECT DISTINCT id, {spelled_sql("lower(t)")} AS form FROM given WHERE regexp_matches(t, '[^\\s]\\s*\\n\\s*[^\\s]')),
long AS (SELECT * FROM forms a WHERE NOT EXISTS (SELECT 1 FROM forms b WHERE b.id = a.id AND b.form <> a.form AND contains(a.form, b.form))),
d AS (SELECT doc_id, text, sha256({canonical_sql("text")}) AS digest FROM documents),
lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
spelt AS (SELECT doc_id, {spelled_sql("lower(coalesce(text, ''))")} AS form FROM documents),
found AS (SELECT doc_id, license_id FROM lines JOIN known ON known.digest = sha256({canonical_sql("line")})
  UNION SELECT doc_id, id FROM spelt JOIN long ON contains(spelt.form, long.form)),
n AS (SELECT doc_id, list_sort(list(DISTINCT license_id)) AS notices FROM found GROUP BY doc_id)
SELECT d.doc_id, d.digest, known.license_id, coalesce(n.notices, CAST([] AS VARCHAR[])) AS notices
FROM d LEFT JOIN known ON known.digest = d.digest LEFT JOIN n ON n.doc_id = d.doc_id
"""

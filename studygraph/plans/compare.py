"""Pages by domain, notes, and three-way comparison over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from studygraph.operators import compare
from studygraph.plans.labels import labels, values_sql
from studygraph.registry import query, table

DOMAINS = {"licence": (("license", "released under", "copyright"), 1), "contact": (("@", "phone", "http"), 2)}
NOTES = ("Fasting for 10 hours before the sample", "PAGE HEADER OF THE DOCUMENT", "Page 3 of the whole protocol text", "12345678901234567 a", "short", "No keyword in here", "A remark without a word of that list which is longer than fifty characters")
KEYWORDS, NOISE = ("fasting", "before", "protocol"), ("page ",)


def _hits(words) -> str:
    return " + ".join(f"contains(lower(text), '{w}')::BIGINT" for w in words)


@query("domain_pages", " UNION ALL ".join(f"SELECT doc_id, '{d}' AS domain, {_hits(w)} AS hits FROM documents WHERE {_hits(w)} >= {n}" for d, (w, n) in DOMAINS.items()))
def domain_pages(spark, sf_dir):
    return compare.domain_pages(table(spark, sf_dir, "documents"), ["doc_id"], "text", DOMAINS)


@query("note_validity", f"""
SELECT k, pos, length(label) BETWEEN 15 AND 800 AND label <> upper(label) AND len(regexp_extract_all(label, '[0-9]')) * 2 <= length(label)
  AND {' AND '.join(f"NOT starts_with(lower(label), '{p}')" for p in NOISE)} AND (length(label) > 50 OR {' OR '.join(f"contains(lower(label), '{w}')" for w in KEYWORDS)}) AS valid
FROM {values_sql(NOTES)}
""")
def note_validity(spark, sf_dir):
    return labels(spark, sf_dir, NOTES, valid=compare.valid_note(F.col("label"), KEYWORDS, NOISE)).select("k", "pos", "valid")


@query("note_merge", """
WITH a AS (SELECT DISTINCT user_id, lower(event_type) AS marker, 'seen' AS note FROM events WHERE event_id % 3 = 0), b AS (SELECT DISTINCT user_id, lower(event_type) AS marker, 'read' AS note FROM events WHERE event_id % 3 = 1)
SELECT *, 'first' AS origin FROM a UNION ALL SELECT *, 'second' FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.user_id = b.user_id AND a.marker = b.marker)
""")
def note_merge(spark, sf_dir):
    def notes(rest: int, note: str):
        return table(spark, sf_dir, "events").filter(F.col("event_id") % 3 == rest).select("user_id", F.upper("event_type").alias("marker"), F.lit(note).alias("note")).distinct()

    return compare.merge_notes(notes(0, "seen"), notes(1, "read"), "user_id", "marker", "note")


@query("three_way_compare", """
WITH g AS (SELECT o_orderkey, o_orderstatus AS v FROM orders WHERE o_orderkey % 7 <> 0), x AS (SELECT o_orderkey, o_orderstatus AS v FROM orders WHERE o_orderkey % 5 <> 0),
c AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderstatus END AS v FROM orders WHERE o_orderkey % 15 > 4)
SELECT o_orderkey, g.v AS golden, x.v AS extracted, c.v AS combined,
  CASE WHEN g.v IS NULL THEN 'extra' WHEN x.v IS NULL AND c.v IS NULL THEN 'lost' WHEN c.v IS NULL THEN 'dropped' WHEN g.v <> c.v THEN 'changed' ELSE 'same' END AS verdict
FROM g FULL JOIN x USING (o_orderkey) FULL JOIN c USING (o_orderkey)
""")
def three_way_compare(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("v"))
    combined = o.filter("o_orderkey % 15 > 4").withColumn("v", F.when(F.col("o_orderkey") % 11 == 0, "X").otherwise(F.col("v")))
    return compare.compare_three(o.filter("o_orderkey % 7 <> 0"), o.filter("o_orderkey % 5 <> 0"), combined, ["o_orderkey"], "v")


@query("standard_ids", "SELECT c_custkey, replace(c_name, '-', '_') AS id FROM (SELECT c_custkey, 'act-' || c_custkey || '-' || c_name AS c_name FROM customer)")
def standard_ids(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("act-"), F.col("c_custkey").cast("string"), F.lit("-"), "c_name").alias("id"))
    return compare.standard_ids(c, ["id"])

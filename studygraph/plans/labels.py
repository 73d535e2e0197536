"""Scalar functions over names and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studygraph.functions import text as T
from studygraph.registry import query, table

#: Labels of visits as protocols write them.
VISITS = ("Screening", "Baseline Visit", "Day 1", "Day -7", "Day −14 (±2 days)", "Week 4 (+/- 3 days)", "Week 12 Visit", "Visit 3 within 5 days", "Follow-up", "End of Study", "Early Termination", "Day 29, window of 4 days", "Day 8 -1 to +2 days", "Unscheduled", "Week 2 a", "Randomization (b)", "Month 6 [C]", "Treatment")
DOSES = ("5 mg once daily", "10-20 mg BID", "0.5 to 1.5 mL IV weekly", "300 IU q2w", "placebo", "75 mg/m2 every 3 weeks", "apply daily", "2 g")


def labels(spark: SparkSession, sf_dir: str, values: tuple[str, ...], **facts: Column) -> DataFrame:
    """Every label with the number of every customer, so that each has several rows; the labels are a fixed list. facts are
    further columns over label, which are computed once a label before it meets the customers."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "pos int, label string").withColumns(facts)
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).crossJoin(F.broadcast(rows))


def values_sql(values: tuple[str, ...]) -> str:
    return "(SELECT c_custkey AS k, pos, label FROM customer CROSS JOIN (VALUES " + ", ".join("({}, '{}')".format(i, v.replace("'", "''")) for i, v in enumerate(values)) + ") AS v(pos, label))"


def in_documents(spark: SparkSession, sf_dir: str, values: tuple[str, ...]) -> DataFrame:
    """The whole text of every document, with one of the values as its last lines: k, pos (of the value), label."""
    pos = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(len(values))).cast("int")
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("k"), pos.alias("pos"), F.coalesce("text", F.lit("")).alias("text"))
    return d.select("k", "pos", F.concat("text", F.lit("\n"), F.element_at(F.array(*map(F.lit, values)), F.col("pos") + 1)).alias("label"))


def in_documents_sql(values: tuple[str, ...]) -> str:
    listed = ", ".join("'{}'".format(v.replace("'", "''")) for v in values)
    return f"(SELECT doc_id AS k, (coalesce(doc_id, 0) % {len(values)})::INTEGER AS pos, coalesce(text, '') || chr(10) || [{listed}][coalesce(doc_id, 0) % {len(values)} + 1] AS label FROM documents)"


@query("name_normalize", r"""
SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(p_name || ' (' || p_brand || ')  ' || p_type), '[^a-z0-9\s\-]', '', 'g'), '\s+', ' ', 'g')) AS name FROM part
""")
def name_normalize(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.normalize_name(F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")  "), "p_type")).alias("name"))


_CLEAN = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim({0}), '(?i)\s+[a-z]$', ''), '(?i)\s+[a-z]\.$', ''), '(?i)\s*\([a-z]\)$', ''), '(?i)\s*\[[a-z]\]$', ''))"
_MARKED = "s_name || CASE s_suppkey % 5 WHEN 0 THEN ' a' WHEN 1 THEN ' b.' WHEN 2 THEN ' (c)' WHEN 3 THEN '[D]' ELSE '' END"


@query("name_clean_suffix", f"""
SELECT s_suppkey, {_CLEAN.format('n')} AS name,
  coalesce(nullif(regexp_extract(n, '\\s+([a-z])\\.?$', 1), ''), '') || coalesce(nullif(regexp_extract(n, '\\(([a-z])\\)$', 1), ''), '') AS refs
FROM (SELECT s_suppkey, {_MARKED} AS n FROM supplier)
""")
def name_clean_suffix(spark, sf_dir):
    mark = F.element_at(F.array(*map(F.lit, (" a", " b.", " (c)", "[D]", ""))), (F.col("s_suppkey") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.concat("s_name", mark).alias("n")).select("s_suppkey", T.clean_name(F.col("n")).alias("name"), F.array_join(T.footnote_refs(F.col("n")), "").alias("refs"))


@query("superscript_strip", f"""
SELECT c_custkey, trim(translate(n, '{T.SUPERSCRIPTS}', '')) AS name, translate(regexp_replace(n, '[^{T.SUPERSCRIPTS}]', '', 'g'), '{T.SUPERSCRIPTS}', '{T.PLAIN}') AS refs
FROM (SELECT c_custkey, c_name || substr('{T.SUPERSCRIPTS}', CAST(c_custkey % 30 + 1 AS INTEGER), CAST(c_custkey % 3 AS INTEGER)) AS n FROM customer)
""")
def superscript_strip(spark, sf_dir):
    marked = F.concat("c_name", F.substring(F.lit(T.SUPERSCRIPTS), (F.col("c_custkey") % 30 + 1).cast("int"), (F.col("c_custkey") % 3).cast("int")))
    return table(spark, sf_dir, "customer").select("c_custkey", marked.alias("n")).select("c_custkey", T.strip_superscripts(F.col("n")).alias("name"), T.superscript_refs(F.col("n")).alias("refs"))


def _number_sql(word: str, column: str = "label") -> str:
    return rf"TRY_CAST(nullif(regexp_extract(translate(lower({column}), '−–—', '---'), '(?:^|[^a-z]){word}\s*(-?[0-9]+)', 1), '') AS INTEGER)"


_DAY_SQL = f"""coalesce({_number_sql('day')}, ({_number_sql('week')} - 1) * 7 + 1, CASE WHEN contains(lower(label), 'screening') THEN -14 WHEN contains(lower(label), 'baseline') THEN 0
  WHEN contains(lower(label), 'randomization') THEN 1 WHEN contains(lower(label), 'follow-up') THEN 365 END)"""


@query("day_extract", f"SELECT k, label, {_number_sql('day')} AS day, {_number_sql('week')} AS week, {_number_sql('visit')} AS visit, {_DAY_SQL} AS study_day FROM {values_sql(VISITS)}")
def day_extract(spark, sf_dir):
    c = F.col("label")
    facts = {word: T.number_after(c, word) for word in ("day", "week", "visit")}
    return labels(spark, sf_dir, VISITS, **facts, study_day=T.study_day(c)).select("k", "label", *facts, "study_day")


def _window_sql(side: int) -> str:
    found = ", ".join(f"TRY_CAST(nullif(regexp_extract(lower(label), '{p}', 1), '') AS INTEGER)" for p in T.SYMMETRIC)
    return f"coalesce(TRY_CAST(nullif(regexp_extract(lower(label), '{T.TWO_SIDED}', {side}), '') AS INTEGER), {found}, 0)"


def _default_sql(at: int) -> str:
    return "CASE " + " ".join(f"WHEN contains(lower(label), '{r[0]}') THEN {r[at]}" for r in T.DEFAULT_WINDOWS) + " ELSE 3 END"


@query("window_extract", f"""
WITH w AS (SELECT k, label, {_window_sql(1)} AS b, {_window_sql(2)} AS a FROM {values_sql(VISITS)}),
d AS (SELECT k, label, CASE WHEN a = 0 AND b = 0 THEN {_default_sql(1)} ELSE b END AS before, CASE WHEN a = 0 AND b = 0 THEN {_default_sql(2)} ELSE a END AS after FROM w)
SELECT k, label, before, after, 'Day ' || {_DAY_SQL} || ' (−' || before || '/+' || after || ')' AS window_label FROM d
""")
def window_extract(spark, sf_dir):
    c = F.col("label")
    w = T.visit_window(c, c)
    return labels(spark, sf_dir, VISITS, before=w["before"], after=w["after"], window_label=T.window_label(T.study_day(c), w["before"], w["after"])).select("k", "label", "before", "after", "window_label")


_DOSE_SQL = r"([0-9]+(?:\.[0-9]+)?)(?:\s*(?:-|to)\s*([0-9]+(?:\.[0-9]+)?))?\s*(mg|mcg|ml|iu|units|g)(?:[^a-z]|$)"
FREQUENCIES = (("(?:once daily|qd)", "QD"), ("(?:twice daily|bid)", "BID"), ("(?:every 2 weeks|q2w)", "Q2W"), ("(?:every 3 weeks|q3w)", "Q3W"), ("weekly", "QW"), ("daily", "QD"))


@query("dose_extract", f"""
WITH d AS (SELECT k, label, TRY_CAST(nullif(regexp_extract(lower(label), '{_DOSE_SQL}', 1), '') AS DOUBLE) AS low,
  TRY_CAST(nullif(regexp_extract(lower(label), '{_DOSE_SQL}', 2), '') AS DOUBLE) AS hi, nullif(regexp_extract(lower(label), '{_DOSE_SQL}', 3), '') AS unit FROM {values_sql(DOSES)})
SELECT k, label, low, coalesce(hi, low) AS high, unit, CASE {' '.join(f"WHEN regexp_matches(lower(label), '{p}') THEN '{v}'" for p, v in FREQUENCIES)} ELSE 'QD' END AS frequency FROM d
""")
def dose_extract(spark, sf_dir):
    rows = labels(spark, sf_dir, DOSES, d=T.dose(F.col("label")), frequency=T.first_rule(F.lower("label"), FREQUENCIES, "QD", regex=True))
    return rows.select("k", "label", "d.low", "d.high", "d.unit", "frequency")


@query("iso_duration", """
WITH d AS (SELECT l_orderkey, l_linenumber, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_linenumber, CASE WHEN days < 0 THEN '-P' || abs(days) || 'D' ELSE 'P' || days || 'D' END AS duration, CAST(days AS DOUBLE) AS back FROM d
""")
def iso_duration(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    d = lines.select("l_orderkey", "l_linenumber", F.date_diff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).alias("days")).withColumn("duration", T.iso_duration(F.col("days"), F.lit("days")))
    return d.select("l_orderkey", "l_linenumber", "duration", T.duration_days(F.col("duration")).alias("back"))


# Words of an encounter's name and its type, in order of precedence.
ENCOUNTER_TYPES = (
    ("screening", "Screening Visit"),
    ("baseline", "Baseline Visit"),
    ("randomization", "Randomization Visit"),
    ("treatment", "Treatment Visit"),
    ("follow-up", "Follow-up Visit"),
    ("followup", "Follow-up Visit"),
    ("end of study", "End of Study Visit"),
    ("eos", "End of Study Visit"),
    ("early termination", "Early Termination Visit"),
    ("et", "Early Termination Visit"),
    ("unscheduled", "Unscheduled Visit"),
)


@query("encounter_type", f"SELECT k, label, CASE {' '.join(f"WHEN contains(lower(label), '{w}') THEN '{v}'" for w, v in ENCOUNTER_TYPES)} ELSE 'Study Visit' END AS kind FROM {values_sql(VISITS)}")
def encounter_type(spark, sf_dir):
    return labels(spark, sf_dir, VISITS, kind=T.first_rule(F.lower("label"), ENCOUNTER_TYPES, "Study Visit")).select("k", "label", "kind")


PART_RULES = (("STEEL", "metal"), ("COPPER", "metal"), ("BRASS", "alloy"), ("TIN", "metal"), ("ECONOMY", "cheap"), ("PROMO", "offer"))


@query("rule_classify", f"SELECT p_partkey, CASE {' '.join(f"WHEN contains(p_type, '{w}') THEN '{v}'" for w, v in PART_RULES)} ELSE 'other' END AS kind FROM part")
def rule_classify(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.first_rule(F.col("p_type"), PART_RULES, "other").alias("kind"))


@query("hash_id", """
SELECT c_custkey, id, CASE WHEN NOT regexp_matches(id, '^[0-9a-f]{8}-') AND (contains(id, '_') OR contains(id, '-')) AND length(id) < 50
  THEN concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), substr(h, 13, 4), substr(h, 17, 4), substr(h, 21, 12)) ELSE id END AS uuid
FROM (SELECT c_custkey, id, md5('customer|' || id) AS h FROM (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'c' || c_custkey ELSE 'cust_' || c_custkey END AS id FROM customer))
""")
def hash_id(spark, sf_dir):
    id_ = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("c"), F.col("c_custkey"))).otherwise(F.concat(F.lit("cust_"), F.col("c_custkey")))
    rows = table(spark, sf_dir, "customer").select("c_custkey", id_.alias("id"))
    return rows.select("c_custkey", "id", F.when(T.needs_id(F.col("id")), T.stable_id(F.lit("customer"), F.col("id"))).otherwise(F.col("id")).alias("uuid"))


@query("revision_hash", "SELECT doc_id, substr(sha256(text), 1, 12) AS revision FROM documents")
def revision_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.substring(F.sha2(F.encode("text", "UTF-8"), 256), 1, 12).alias("revision"))


@query("json_repair_parse", "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_repair_parse(spark, sf_dir):
    fenced = F.concat(F.lit("Here it is:\n```json\n"), F.when(F.col("event_id") % 3 == 0, F.regexp_replace("props", "}$", ",}")).when(F.col("event_id") % 3 == 1, F.regexp_replace("props", '"', "'")).otherwise(F.col("props")), F.lit("\n```\nDone."))
    return table(spark, sf_dir, "events").select("event_id", T.repaired_json(fenced, "k long").getField("k").alias("k"))

"""Footnotes and days in all documents, each with a passage as protocols have it behind its own text."""

from __future__ import annotations

from pyspark.sql import functions as F

from studygraph.operators import days, notes
from studygraph.plans.labels import in_documents, in_documents_sql
from studygraph.registry import query

LAYOUT_PASSAGES = (
    "\na. Collected 30 minutes before the first dose\nb) Only for women of childbearing potential\nc. short",
    "\n[a] Performed in triplicate at each visit [b]: Fasting for at least 10 hours is required\n\nother text",
    "\nBlood draw^a After 12-hour fast as the plan says ^b Vital signs 2 hours after dosing\n\nother text",
    "\n\n1. Samples are collected at weeks 4, 8 and 12\n2) Only in subjects aged 65 years and older\n\n3. Table of all contents that follow",
    "\n\n\nFootnotes:\na. Daily weight is recorded in the diary\nwithout a mark but in the section\nb) If clinically indicated, repeat the test\n\n\n\nEND OF PAGE:",
    "\na. Collected daily during the treatment period\na. Collected daily during the treatment period.\nb. collected DAILY during treatment period",
    "nothing of interest",
    "",
)
DAY_PASSAGES = (
    "\nDaily urine collection on Days -4 through -1 and days 2-3.",
    "\nBaseline period: Days -4 to -1. Treatment period: day 1 to 28. Steady-state days 15 to 28.",
    "\nComplete 24-hour urine collection; collection day begins 8:00 am.",
    "\nControlled meal from day 1 to day 5. Copper balance on day –6 through –2.",
    "\nPre-treatment days −7 to −1; active phase 1-14; daily weight days 3 to 1.",
    "\nMorning of day 1 to morning of day 2. No other days.",
    "\nnothing of interest",
    "",
)
REPEAT_PASSAGES = (
    "\nDaily urine on days 2 to 5. Glucose every 15 min, later every 2 hours.",
    "\nTreated in a 21-day cycle until disease progression.",
    "\nPK samples at 0, 30, 60, 120 and at 5, 10 minutes.",
    "\nHospitalized from day -4 to day 2; weeks 4 through 8.",
    "\nnothing of interest",
    "",
)


@query("footnote_layouts")
def footnote_layouts(spark, sf_dir):
    """Notes of every document in five layouts, with the condition that each states."""
    return notes.footnote_conditions(in_documents(spark, sf_dir, LAYOUT_PASSAGES), "label", ["k"])


@query("daily_bindings")
def daily_bindings(spark, sf_dir):
    """Daily collections of every document and the days that they are bound to."""
    found = days.daily_bindings(in_documents(spark, sf_dir, DAY_PASSAGES), "label", ["k"])
    return found.select("k", "activity", "name", F.col("days.start").alias("start_day"), F.col("days.end").alias("end_day"), "expected", "start_offset", "end_offset", "source")


def _day_sql(text: str) -> str:
    return f"TRY_CAST(regexp_replace(translate({text}, '–−—', '---'), '[^0-9-]', '', 'g') AS BIGINT)"


_WINDOWS_SQL = " UNION ALL ".join(
    f"SELECT k, '{kind}' AS kind, '{name}' AS name, unnest(regexp_extract_all(label, '{p}', 0)) AS source, unnest(list_zip(regexp_extract_all(label, '{p}', 1), regexp_extract_all(label, '{p}', 2))) AS d FROM t" for p, kind, name in days.WINDOWS
)


@query("analysis_windows", f"""
WITH t AS (SELECT k, label FROM {in_documents_sql(DAY_PASSAGES)}), w AS ({_WINDOWS_SQL})
SELECT k, kind, name, {_day_sql('d[1]')} AS start_day, {_day_sql('d[2]')} AS end_day, source FROM w
""")
def analysis_windows(spark, sf_dir):
    found = days.analysis_windows(in_documents(spark, sf_dir, DAY_PASSAGES), "label", ["k"])
    return found.select("k", "kind", "name", F.col("days.start").alias("start_day"), F.col("days.end").alias("end_day"), "source")


@query("collection_days", f"""
SELECT k, d FROM (SELECT k, coalesce({', '.join(f"nullif(regexp_extract(label, '{p}', 0), '')" for p in days.COLLECTION_DAYS)}) AS d FROM {in_documents_sql(DAY_PASSAGES)}) WHERE d IS NOT NULL
""")
def collection_days(spark, sf_dir):
    return in_documents(spark, sf_dir, DAY_PASSAGES).select("k", days.collection_day(F.col("label")).alias("d")).filter("d IS NOT NULL")


@query("repetition_details")
def repetition_details(spark, sf_dir):
    """Every repetition that a document tells of, with its interval, cycle, days and end."""
    return days.repetition_details(in_documents(spark, sf_dir, REPEAT_PASSAGES), "label", ["k"])


@query("binding_windows")
def binding_windows(spark, sf_dir):
    """Daily collections and the windows of analysis of the same document that they share days with."""
    rows = in_documents(spark, sf_dir, DAY_PASSAGES)
    met = days.interval_join(days.daily_bindings(rows, "label", ["k"]).select("k", "activity", "days"), days.analysis_windows(rows, "label", ["k"]).select("k", "kind", "days"), ["k"])
    return met.select("k", "activity", F.col("right_kind").alias("kind"), F.col("days.start").alias("start_day"), F.col("days.end").alias("end_day"), F.col("right_days.start").alias("window_start"), F.col("right_days.end").alias("window_end"), "relation")


@query("interval_overlaps", """
WITH o AS (SELECT o_custkey AS c, o_orderkey AS k, datediff('day', DATE '1990-01-01', o_orderdate::DATE)::BIGINT AS s, s + (o_orderkey % 9) * 7 AS e FROM orders)
SELECT a.k, b.k AS other, CASE WHEN a.s = b.s AND a.e = b.e THEN 'equal' WHEN a.s >= b.s AND a.e <= b.e THEN 'within' WHEN a.s <= b.s AND a.e >= b.e THEN 'contains' ELSE 'overlaps' END AS relation
FROM o a JOIN o b ON a.c = b.c AND a.k < b.k AND a.s <= b.e AND b.s <= a.e
""")
def interval_overlaps(spark, sf_dir):
    """Orders of one customer, each some weeks long, that share a day."""
    from studygraph.registry import table

    start = F.datediff("o_orderdate", F.lit("1990-01-01").cast("date")).cast("long")
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("k"), F.struct(start.alias("start"), (start + (F.col("o_orderkey") % 9) * 7).alias("end")).alias("days"))
    return days.interval_join(orders, orders, ["o_custkey"]).filter("k < right_k").select("k", F.col("right_k").alias("other"), "relation")

"""The clinical layer over visits' labels and names of the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from studygraph.functions import text as T
from studygraph.operators import clinical, match
from studygraph.plans.labels import VISITS, labels, values_sql
from studygraph.registry import query, table

NAMES = ("Visit 2 - Week 4", "Day 1: Baseline", "Screening (Day -14)", "Follow-up", "Week 12 ± 3 days", "End of Study – Day 90", "(Month 6)")


@query("split_timing", f"""
WITH x AS (SELECT k, label, nullif(regexp_extract(label, '{clinical.TIMING}', 1), '') AS timing, regexp_replace(regexp_replace(label, '{clinical.TIMING}', '', 'g'), '^[\\s\\-–—:()]+|[\\s\\-–—:()]+$', '', 'g') AS rest FROM {values_sql(NAMES)})
SELECT k, label, coalesce(nullif(rest, ''), label) AS name, timing FROM x
""")
def split_timing(spark, sf_dir):
    return labels(spark, sf_dir, NAMES, s=clinical.split_timing(F.col("label"))).select("k", "label", "s.name", "s.timing")


@query("clean_text", "SELECT conv_id, turn, trim(regexp_replace(regexp_replace(text || chr(9) || 'x' || chr(127) || chr(10), '[\\x00-\\x1f\\x7f-\\x9f]', ' ', 'g'), ' +', ' ', 'g')) AS text FROM conversations")
def clean_text(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", clinical.clean_text(F.concat("text", F.lit("\tx\x7f\n"))).alias("text"))


@query("enum_map", f"SELECT c_custkey, CASE {' '.join(f"WHEN contains(lower(v), '{w}') THEN '{x}'" for w, x in clinical.ENUMS['arm'])} ELSE 'Other' END AS arm FROM (SELECT c_custkey, ['Placebo', 'Active comparator', 'Experimental arm', 'control group', c_mktsegment][CAST(c_custkey % 5 + 1 AS INTEGER)] AS v FROM customer)")
def enum_map(spark, sf_dir):
    v = F.element_at(F.array(*map(F.lit, ("Placebo", "Active comparator", "Experimental arm", "control group")), F.col("c_mktsegment")), (F.col("c_custkey") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", clinical.enum_value("arm", v, "Other").alias("arm"))


@query("canonical_windows", """
WITH e AS (SELECT user_id, event_id AS pos, dayofyear(ts) AS day, CASE event_type WHEN 'signup' THEN 'Screening Visit' WHEN 'purchase' THEN 'End of Study' WHEN 'error' THEN 'Early Termination' WHEN 'view' THEN 'Baseline' ELSE 'Visit ' || (event_id % 3) END AS name FROM events),
c AS (SELECT *, CASE WHEN regexp_matches(lower(name), 'end of study|eos|early termination') THEN 'eos' WHEN contains(lower(name), 'screening') THEN 'screening' WHEN contains(lower(name), 'baseline') THEN 'baseline' ELSE lower(name) END AS canonical FROM e)
SELECT user_id, canonical, arg_min(name, (CASE WHEN canonical = 'eos' THEN -day WHEN canonical IN ('screening', 'baseline') THEN day ELSE pos END, pos)) AS name,
  arg_min(day, (CASE WHEN canonical = 'eos' THEN -day WHEN canonical IN ('screening', 'baseline') THEN day ELSE pos END, pos)) AS day FROM c GROUP BY user_id, canonical
""")
def canonical_windows(spark, sf_dir):
    t = F.col("event_type")
    name = F.when(t == "signup", "Screening Visit").when(t == "purchase", "End of Study").when(t == "error", "Early Termination").when(t == "view", "Baseline").otherwise(F.concat(F.lit("Visit "), F.col("event_id") % 3))
    e = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("pos"), F.dayofyear("ts").cast("long").alias("day"), name.alias("name"))
    return clinical.canonical_windows(e, ["user_id"]).select("user_id", "canonical", "name", "day")


@query("dose_elements", """
WITH r AS (SELECT o_orderkey, (o_orderkey % 3 + 1)::INTEGER AS n FROM orders), x AS (SELECT o_orderkey, unnest(range(n)) AS pos FROM r)
SELECT o_orderkey, CAST(pos AS INTEGER) AS pos, CAST((pos + 1) * 10 AS INTEGER) AS amount, lag((pos + 1) * 10) OVER (PARTITION BY o_orderkey ORDER BY pos) IS NOT NULL AS chained FROM x
""")
def dose_elements(spark, sf_dir):
    levels = F.transform(F.sequence(F.lit(1), (F.col("o_orderkey") % 3 + 1).cast("int")), lambda i: i * 10)
    made = clinical.dose_elements(table(spark, sf_dir, "orders").select("o_orderkey", levels.alias("levels")), ["o_orderkey"], "levels")
    return made.select("o_orderkey", "pos", "amount", F.col("previous_id").isNotNull().alias("chained"))


@query("visit_resolver")
def visit_resolver(spark, sf_dir):
    """Every label of a visit resolved among all of them, in each nation's document."""
    facts = clinical.visit_facts(F.col("label"))
    e = labels(spark, sf_dir, VISITS, facts=facts).select(F.col("k").alias("protocol_id"), F.col("pos").cast("string").alias("id"), F.col("label").alias("name"), "pos", "facts")
    asked = labels(spark, sf_dir, ("EOS", "Week 4", "baseline", "Day 29", "Visit 3 of 5", "Safety visit", "none of these"), facts=facts).select(F.col("k").alias("protocol_id"), F.col("label").alias("wanted"), "facts")
    return clinical.resolve_visits(asked, e, ["protocol_id"], "facts")


@query("golden_similarity")
def golden_similarity(spark, sf_dir):
    """Part names against the next part's of their brand, by the similarity that golden comparisons use."""
    from studygraph.operators.schedule import chained

    p = chained(table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_name"), "p_brand", ["p_partkey"], "p_name")
    return p.filter("next_id IS NOT NULL").select("p_partkey", F.round(clinical.similarity("p_name", "next_id"), 6).alias("similarity"))


@query("golden_match")
def golden_match(spark, sf_dir):
    """Each conversation's turns of its user, as golden entities, with the most similar free turn of the others."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return match.best_candidates(c.filter("role = 'user'"), c.filter("role <> 'user'"), "conv_id", "turn", "text", clinical.base_similarity).withColumn("score", F.round("score", 6))


@query("encounter_reconcile")
def encounter_reconcile(spark, sf_dir):
    """Labels of visits from two sources, reconciled in each nation's document."""
    base = labels(spark, sf_dir, VISITS).select(F.col("k").cast("string").alias("protocol_id"), "pos", F.col("label").alias("name"))
    day = T.study_day(F.col("name"))
    a = base.withColumns({"source": F.lit("soa"), "priority": F.lit(10), "id": F.concat(F.lit("enc_"), "pos"), "epoch_id": F.when(F.col("pos") % 4 != 0, F.lit("e1")), "study_day": F.lit(None).cast("int"), "window_before": F.lit(None).cast("int"), "window_after": F.lit(None).cast("int")})
    b = base.filter("pos % 2 = 0").withColumns({"source": F.lit("windows"), "priority": F.lit(25), "id": F.lit(None).cast("string"), "epoch_id": F.lit("e2"), "study_day": day, "window_before": F.lit(1), "window_after": F.col("pos")})
    return clinical.encounters(a.unionByName(b)).select("protocol_id", "id", "name", "epoch_id", "study_day", "window_before", "window_after", "type", "place")

"""Visits of all documents, and models and designs of studies that are made of the tables: a study for each customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studygraph.operators import models, promotion, visits
from studygraph.plans.labels import in_documents
from studygraph.registry import query, table

VISIT_PASSAGES = (
    "\nScreening Visit (within 21 days)\nBaseline\nDay 1 dosing, window of 2 days\nWeek 4 (± 3 days)\nWeek 12\nallowed deviation: 5 days",
    "\nVisit 2\nDay 15 +/- 2 days\noptional\nVisit 3 is mandatory\nMonth 6, −2 to +4 days\nEnd of Study",
    "\nFollow up\n7-day window\nEOT and EOS\nEarly Termination as needed",
    "\nVisit 5\n\nWeek 8\nVisit 5 again at day 57",
    "\nnothing of the kind",
    "",
)


@query("visit_lines")
def visit_lines(spark, sf_dir):
    """Visits that the lines of every document name, each read with the two lines after it."""
    return visits.visit_windows(in_documents(spark, sf_dir, VISIT_PASSAGES), "label", ["k"])


@query("merged_visits", """
WITH d AS (SELECT o_custkey AS k, o_orderkey, o_orderstatus, (o_orderkey % 40)::BIGINT AS day, CASE WHEN o_orderkey % 7 = 0 THEN 'Visit ' || (o_orderkey % 15) || ' extra' ELSE 'Visit ' || (o_orderkey % 15) END AS visit,
  (o_orderkey % 3)::BIGINT AS before, (o_orderkey % 2)::BIGINT AS after FROM orders),
n AS (SELECT *, o_orderstatus <> 'F' AS second FROM d),
named AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY second, k, lower(visit) ORDER BY o_orderkey) = 1),
f AS (SELECT *, min(o_orderkey) OVER (PARTITION BY second, k, day) AS nth FROM named QUALIFY row_number() OVER (PARTITION BY second, k, day ORDER BY -length(visit), o_orderkey) = 1),
p AS (SELECT * FROM f WHERE NOT second), s AS (SELECT * FROM f WHERE second),
m AS (SELECT s.k, s.nth, coalesce(max(p.nth) FILTER (lower(p.visit) = lower(s.visit)), max(p.nth)) AS link, any_value(s.before) AS before, any_value(s.after) AS after FROM s JOIN p ON p.k = s.k AND (lower(p.visit) = lower(s.visit) OR p.day = s.day) GROUP BY s.k, s.nth),
g AS (SELECT k, link, arg_min(before, nth) FILTER (before > 0) AS before, arg_min(after, nth) FILTER (after > 0) AS after FROM m GROUP BY ALL),
u AS (SELECT p.k, 0 AS o, p.nth, visit, day, coalesce(nullif(p.before, 0), g.before, p.before) AS before, coalesce(nullif(p.after, 0), g.after, p.after) AS after, 'primary' AS origin FROM p LEFT JOIN g ON g.k = p.k AND g.link = p.nth
  UNION ALL SELECT s.k, 1, s.nth, visit, day, s.before, s.after, 'secondary' FROM s ANTI JOIN m ON m.k = s.k AND m.nth = s.nth)
SELECT k, row_number() OVER (PARTITION BY k ORDER BY day, o, nth) AS number, visit, day, before, after, origin FROM u
""")
def merged_visits(spark, sf_dir):
    """Visits of a customer from two sources, finished orders and others, merged by name and day."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    visit = F.concat(F.lit("Visit "), key % 15, F.when(key % 7 == 0, " extra").otherwise(""))
    rows = o.select(F.col("o_custkey").alias("k"), key.alias("nth"), visit.alias("visit"), (key % 40).alias("day"), F.lit(None).cast("long").alias("week"), (key % 3).alias("before"), (key % 2).alias("after"), "o_orderstatus")
    done = visits.merged_visits(rows.filter("o_orderstatus = 'F'").drop("o_orderstatus"), rows.filter("o_orderstatus <> 'F'").drop("o_orderstatus"), ["k"])
    return done.drop("week")


def customer_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An execution model of each customer, by the numbers and priorities of its orders."""
    k, c, p = F.col("o_orderkey"), F.col("c_custkey"), F.substr("o_orderpriority", F.lit(1), F.lit(1))
    # collect_list leaves out nulls: these are the orders of one customer that a component is made of
    when = lambda condition, **fields: F.collect_list(F.when(condition, F.struct(*(x.alias(n) for n, x in fields.items()))))
    o = table(spark, sf_dir, "orders")
    parts = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        when(p == "1", kind=F.when(k % 3 == 0, "FirstDose").otherwise("Other"), definition=F.concat(F.lit("Order "), k % 5)).alias("anchors"),
        when(p == "2", id=k.cast("string"), kind=F.when(k % 2 == 0, "Interval").otherwise("Daily"), interval=F.when(k % 6 != 0, "P1D")).alias("repetitions"),
        when(p == "3", activity=k.cast("string"), kind=F.lit("Single")).alias("execution_types"),
        when(p == "4", structured=F.when(k % 3 == 0, "x")).alias("footnotes"),
        when(F.col("o_orderstatus") == "F", name=F.when(k % 7 == 0, "Change from Baseline").otherwise("Other"), kind=F.when(k % 4 == 0, "Primary").otherwise("Secondary"), algorithm=F.when(k % 5 != 0, "a")).alias("endpoints"),
        when(F.col("o_orderstatus") == "O", name=F.lit("v"), kind=F.when(k % 3 == 0, "ChangeFromBaseline").otherwise("Custom"), baseline=F.when(k % 2 == 0, "b"), derivation=F.when(k % 4 != 0, "d")).alias("variables"),
        when(F.col("o_orderstatus") == "P", activity=k.cast("string"), least=k % 40, timepoints=F.when(k % 2 == 0, F.array(F.lit("0"))).otherwise(F.array().cast("array<string>")), window=F.when(k % 3 == 0, "PT1H")).alias("sampling"),
    )
    texts = lambda *xs: F.array(*map(F.lit, xs)).cast("array<string>") if xs else F.array().cast("array<string>")
    cases = lambda *xs: F.try_element_at(F.array(*xs), (c % len(xs) + 1).cast("int"))
    move = lambda *pairs: F.array(*(F.struct(F.lit(a).alias("from_state"), F.lit(b).alias("to_state")) for a, b in pairs)) if pairs else F.array().cast("array<struct<from_state: string, to_state: string>>")
    machine = lambda states, terminal, *moves: F.struct(texts(*states).alias("states"), F.lit("S").alias("initial"), texts(*terminal).alias("terminal"), move(*moves).alias("transitions"))
    traversals = F.array(cases(texts("Screening", "PERIOD 1"), texts("BASELINE"), texts(), texts("SCREENING", "END")))
    crossover = F.struct((c % 3 == 0).alias("is_crossover"), (c % 4).alias("periods"), F.when(c % 5 == 0, texts()).otherwise(texts("AB")).alias("sequences"))
    machines = cases(machine(("S", "T", "E"), ("E",), ("S", "T"), ("T", "E")), machine(("S", "E"), ()), machine(("S", "T", "U", "E"), ("E",), ("S", "E"), ("T", "U")), F.lit(None).cast(models.MODEL["machine"]), machine(("S", "X", "E"), ("E",), ("S", "X"), ("S", "E")))
    return table(spark, sf_dir, "customer").join(parts, "c_custkey", "left").select(
        "c_custkey", "anchors", "repetitions", "execution_types", "footnotes", "endpoints", "variables", "sampling", F.when(c % 6 != 5, traversals).alias("traversals"), F.when(c % 2 == 0, crossover).alias("crossover"), machines.alias("machine"))


_N = "count(*) FILTER ({})"
_MODEL_SQL = f"""WITH o AS (SELECT o_custkey AS c, o_orderkey AS k, substr(o_orderpriority, 1, 1) AS p, o_orderstatus AS s FROM orders),
a AS (SELECT c_custkey AS c, {', '.join(f"{_N.format(x)} AS {n}" for n, x in {
    'anchors': "p = '1'", 'first': "p = '1' AND k % 3 = 0", 'reps': "p = '2'", 'types': "p = '3'", 'notes': "p = '4'", 'bare': "p = '4' AND k % 3 <> 0", 'ends': "s = 'F'", 'prim': "s = 'F' AND k % 4 = 0", 'noalg': "s = 'F' AND k % 5 = 0",
    'change': "s = 'F' AND k % 7 = 0", 'vars': "s = 'O'", 'cfb': "s = 'O' AND k % 3 = 0", 'nobase': "s = 'O' AND k % 3 = 0 AND k % 2 = 1", 'norule': "s = 'O' AND k % 4 = 0", 'samp': "s = 'P'", 'nowin': "s = 'P' AND k % 2 = 0 AND k % 3 <> 0",
    'gaps': "p = '2' AND k % 6 = 0", 'high': "s = 'P' AND k % 40 > 30", 'few': "s = 'P' AND k % 40 < 2"}.items())},
  count(DISTINCT k % 5) FILTER (p = '1') AS defs FROM customer LEFT JOIN o ON o.c = c_custkey GROUP BY c_custkey),
x AS (SELECT *, c % 2 = 0 AND c % 3 = 0 AS cross_, c % 6 <> 5 AS trav, c % 5 AS m FROM a),
i AS (SELECT c, unnest([
  (anchors = 0, 'warning', 1), (anchors > 0 AND first = 0, 'info', 1), (defs < anchors, 'warning', 1), (reps = 0, 'info', 1), (gaps > 0, 'warning', gaps), (types = 0, 'warning', 1), (NOT trav, 'info', 1),
  (trav AND c % 4 IN (1, 2), 'warning', 1), (trav AND c % 4 = 1, 'info', 1), (cross_ AND c % 4 < 2, 'error', 1), (cross_ AND c % 5 = 0, 'warning', 1), (notes > 100, 'warning', 1), (bare > notes * 0.5, 'info', 1),
  (ends = 0, 'info', 1), (ends > 0 AND prim = 0, 'warning', 1), (noalg > 0, 'warning', 1), (vars = 0, 'info', 1), (nobase > 0, 'warning', 1), (norule > 0, 'warning', 1), (m = 3, 'info', 1),
  (m = 1, 'warning', 1), (m = 1, 'error', 1), (m = 1, 'warning', 1), (m = 1 OR m = 2, 'warning', 1), (m = 1 OR m = 2 OR m = 4, 'warning', 1),
  (samp = 0, 'info', 1), (high > 0, 'warning', high), (few > 0, 'warning', few), (nowin > 0, 'info', 1), (cross_ AND trav AND c % 4 <> 0, 'info', 1), (ends > 0 AND vars > 0 AND change > 0 AND cfb = 0, 'info', 1)]) AS t FROM x),
n AS (SELECT c, sum(t[3]) FILTER (t[1] AND t[2] = 'error') AS e, sum(t[3]) FILTER (t[1] AND t[2] = 'warning') AS w, sum(t[3]) FILTER (t[1] AND t[2] = 'info') AS f FROM i GROUP BY c)"""


@query("model_scores", f"""{_MODEL_SQL}
SELECT c AS c_custkey, coalesce(e, 0)::BIGINT AS errors, coalesce(w, 0)::BIGINT AS warnings, coalesce(f, 0)::BIGINT AS infos, greatest(0.0::DOUBLE, 1.0::DOUBLE - coalesce(e, 0)::DOUBLE * 0.15::DOUBLE - coalesce(w, 0)::DOUBLE * 0.05::DOUBLE) AS score, coalesce(e, 0) = 0 AS valid FROM n
""")
def model_scores(spark, sf_dir):
    """Issues by severity and the score of every customer's model."""
    return models.model_scores(customer_models(spark, sf_dir), "c_custkey")


@query("model_issues")
def model_issues(spark, sf_dir):
    """Every issue of every customer's model, by name."""
    return models.model_issues(customer_models(spark, sf_dir), "c_custkey")


_ARMS = (
    (("Sequence AB", "A then B"), ("Sequence BA", "B then A")), (("Placebo", ""), ("Drug", "")), (("One", ""),), (("Low", ""), ("Mid", ""), ("High", "")),
    (("Old", "old to new"), ("New", "new")), (("Up", "dose escalation"), ("Down", "")), (("AB sequence", ""), ("BA sequence", ""), ("Other", "")),
)
#: For each set of arms, the first fault that ends it without regard to ratios, and whether that comes before ratios.
_ARM_FAULTS = (None, None, "crossover_design_mismatch", "crossover_parallel_mismatch", "crossover_switch_pattern", "crossover_titration_conflict", None)


@query("crossover_consistency", f"""
WITH s AS (SELECT s_suppkey AS k, s_suppkey % 7 AS a, [NULL, '1:1', '2:1', '1:1:1'][s_suppkey % 4 + 1] AS ratio, s_suppkey % 3 + 1 AS periods, s_suppkey % 5 AS epochs, s_suppkey % 2 + 1 AS seqs FROM supplier),
i AS (SELECT k, list_filter([
  CASE WHEN a = 2 AND seqs > 1 THEN 'crossover_design_mismatch' END, CASE WHEN a = 3 THEN 'crossover_parallel_mismatch' END, CASE WHEN a = 4 THEN 'crossover_switch_pattern' END, CASE WHEN ratio = '1:1:1' THEN 'crossover_ratio_mismatch' END,
  CASE WHEN ratio = '2:1' THEN 'crossover_unequal_ratio' END, CASE WHEN periods > epochs THEN 'crossover_period_mismatch' END, CASE WHEN a = 5 THEN 'crossover_titration_conflict' END], lambda x: x IS NOT NULL) AS f FROM s),
e AS (SELECT k, f, list_min(list_filter([list_position(f, x) FOR x IN ['crossover_design_mismatch', 'crossover_parallel_mismatch', 'crossover_switch_pattern', 'crossover_ratio_mismatch', 'crossover_titration_conflict']], lambda p: p > 0)) AS stop FROM i)
SELECT k, stop IS NULL AS keep, array_to_string(CASE WHEN stop IS NULL THEN f ELSE f[1:stop] END, ',') AS issues FROM e
""")
def crossover_consistency(spark, sf_dir):
    """Which of the crossovers of every supplier's design stay."""
    k = F.col("s_suppkey")
    arms = F.array(*(F.array(*(F.struct(F.lit(n).alias("name"), F.lit(d).alias("description")) for n, d in arm)) for arm in _ARMS))
    designs = table(spark, sf_dir, "supplier").select(
        k.alias("k"), F.element_at(arms, (k % 7 + 1).cast("int")).alias("arms"), F.element_at(F.array(F.lit(None).cast("string"), F.lit("1:1"), F.lit("2:1"), F.lit("1:1:1")), (k % 4 + 1).cast("int")).alias("ratio"),
        (k % 3 + 1).alias("periods"), (k % 5).alias("epochs"), (k % 2 + 1).alias("sequences"),
    )
    return models.crossover_consistency(designs, "k").withColumn("issues", F.array_join("issues", ","))


def customer_designs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A design with findings of each customer that has orders, by their numbers and priorities."""
    k, p = F.col("o_orderkey"), F.substr("o_orderpriority", F.lit(1), F.lit(1))
    name = lambda *xs: F.element_at(F.array(*map(F.lit, xs)), (k % len(xs) + 1).cast("int"))
    when = lambda condition, **fields: F.array_sort(F.collect_list(F.when(condition, F.struct(k.alias("_k"), *(x.alias(n) for n, x in fields.items())))))
    id_ = k.cast("string")
    parts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        when(F.lit(True), id=F.concat(F.lit("enc_"), id_), name=F.concat(F.lit("Day "), k % 30), epoch_id=F.concat(F.lit("epoch_"), k % 3)).alias("encounters"),
        when(p == "1", id=id_, name=name("First Dose", "Randomization", "Baseline", "Cycle"), class_=name("Event", "Event", "Visit", "Conceptual"), day=k % 30).alias("anchors"),
        when(p == "2", id=id_, kind=name("Daily", "Weekly", "Other"), activity=name("vital signs", "ECG", "unknown thing"), start_day=k % 10, end_day=k % 10 + 10, every=F.lit(2).cast("long")).alias("repetitions"),
        when(p == "3", id=id_, treatment=name("Drug A", "the", "Drug B"), dose=F.concat(k % 50, F.lit(" mg")), route=name("oral", "IV"), frequency=F.lit("daily")).alias("regimens"),
        when(p == "4", id=F.concat(F.lit("timing_"), id_), name=name("First Dose", "Some visit", "cycle 2", "consent"), from_instance_id=F.concat(F.lit("missing_"), k % 9)).alias("timings"),
        when(p == "5", visit=F.concat(F.lit("Day "), k % 30), day=k % 30, before=k % 4, after=k % 3).alias("visit_windows"),
        when(F.col("o_orderstatus") == "F", id=F.concat(F.lit("note_"), id_), kind=name("procedure_variant", "timing_before"), text=F.when(k % 5 != 0, "a text"), applies_to=F.array(F.lit("ecg"), F.lit("nothing"))).alias("footnotes"),
        when(F.col("o_orderstatus") == "P", id=id_, name=F.lit("Drug A"), levels=F.transform(F.array(F.lit("5 mg"), F.lit("10 mg")), lambda d: F.struct(d.alias("dose"), F.lit("P7D").alias("duration"), F.lit("tolerated").alias("criteria")))).alias("titrations"),
    )
    shaped = {
        "encounters": "x -> struct(x.id, x.name, string(null) AS label, x.epoch_id, string(null) AS timing_id, string(null) AS previous_id, string(null) AS next_id, string(null) AS start_rule, string(null) AS end_rule)",
        "anchors": "x -> struct(x.id, x.name, x.class_, x.day, 100L AS place, string(null) AS activity_id)", "repetitions": "x -> struct(x.id, x.kind, x.activity, x.start_day, x.end_day, x.every)",
        "regimens": "x -> struct(x.id, x.treatment, x.dose, x.route, x.frequency)", "timings": "x -> struct(x.id, x.name, x.from_instance_id, string(null) AS value, string(null) AS lower, string(null) AS upper, string(null) AS label)",
        "visit_windows": "x -> struct(x.visit, x.day, x.before, x.after)", "footnotes": "x -> struct(x.id, x.kind, x.text, x.applies_to)", "titrations": "x -> struct(x.id, x.name, x.levels)",
    }
    wanted = promotion.DESIGN | promotion.FINDINGS
    fixed = {
        "activities": "array(named_struct('id', 'vitals', 'name', 'Vital Signs', 'label', ''), named_struct('id', 'ecg', 'name', 'ECG', 'label', '12-lead'), named_struct('id', 'dosing', 'name', 'Drug administration', 'label', ''))",
        "epochs": "array(named_struct('id', 'epoch_0', 'name', 'Screening', 'p', string(null), 'n', string(null)), named_struct('id', 'epoch_1', 'name', 'Treatment', 'p', string(null), 'n', string(null)), named_struct('id', 'epoch_2', 'name', 'Follow-up', 'p', string(null), 'n', string(null)))",
        "interventions": "array(named_struct('id', 'drug_a', 'name', 'Drug A', 'a', array()))", "traversals": "array(array('Screening', 'epoch_1', 'FOLLOW-UP'), array('Treatment', 'unknown'))",
        "transitions": "array(named_struct('f', 'Day 1', 't', 'Day 2', 'g', 'go', 'h', 'fit'))", "endpoints": "array(named_struct('id', 'end_1', 'name', 'Weight'))",
        "estimands": "array(named_struct('id', 'est_1', 'name', 'Weight change', 'e', 'end_1', 'a', string(null)))", "algorithms": "array(named_struct('n', 'weight', 'a', 'post - pre'))",
    }
    return parts.select("o_custkey", *(F.expr(f"transform({n}, {f})").cast(wanted[n]).alias(n) for n, f in shaped.items()), *(F.expr(x).cast(wanted[n]).alias(n) for n, x in fixed.items()))


@query("promotion", """
WITH o AS (SELECT o_custkey, o_orderkey AS k, substr(o_orderpriority, 1, 1) AS p, o_orderstatus AS s FROM orders),
e AS (SELECT DISTINCT o_custkey, k % 30 AS day FROM o),
r AS (SELECT DISTINCT o.o_custkey, [ 'vitals', 'ecg', NULL][k % 3 + 1] AS activity, e.day FROM o JOIN e ON e.o_custkey = o.o_custkey AND day BETWEEN k % 10 AND k % 10 + 10 AND (day - k % 10) % [1, 7, 2][k % 3 + 1] = 0 WHERE p = '2' AND k % 3 <> 2),
rc AS (SELECT o_custkey, count(*) AS n FROM r GROUP BY 1)
SELECT o_custkey, count(DISTINCT k % 4) FILTER (p = '1' AND k % 4 <> 3) AS anchors, coalesce(any_value(rc.n), 0) AS repeated, count(*) FILTER (s = 'F' AND k % 5 <> 0 AND k % 2 = 0) AS decisions, count(*) FILTER (p = '3' AND k % 3 <> 1) AS administrations,
  count(*) FILTER (p = '3' AND k % 3 = 0) AS owned, count(*) FILTER (s = 'F' AND k % 5 <> 0) AS conditions, 2 * count(*) FILTER (s = 'P') AS elements, 'epoch_1,epoch_2' AS next_epochs, 'post - pre' AS algorithm, 0 AS dangling
FROM o LEFT JOIN rc USING (o_custkey) GROUP BY o_custkey
""")
def promotion_counts(spark, sf_dir):
    """What every customer's design has after all ten steps, and that nothing in it dangles."""
    done = promotion.promote(customer_designs(spark, sf_dir), "o_custkey")
    n = lambda array, condition: F.size(F.filter(array, condition)).cast("long")
    counts = done.select(
        "o_custkey", n("instances", lambda x: F.startswith(x["id"], F.lit("anchor_inst_"))).alias("anchors"), n("instances", lambda x: F.startswith(x["id"], F.lit("rep_"))).alias("repeated"), n("instances", lambda x: x["kind"] == "ScheduledDecisionInstance").alias("decisions"),
        F.size("administrations").cast("long").alias("administrations"), F.size(F.col("interventions")[0]["administration_ids"]).cast("long").alias("owned"), F.size("conditions").cast("long").alias("conditions"), F.size("elements").cast("long").alias("elements"),
        F.array_join(F.transform("epochs", lambda x: x["next_id"]), ",").alias("next_epochs"), F.col("estimands")[0]["algorithm"].alias("algorithm"),
    )
    wrong = promotion.promotion_issues(done, "o_custkey").groupBy("o_custkey").agg(F.count("*").cast("int").alias("wrong"))
    return counts.join(wrong, "o_custkey", "left").select(*counts.columns, F.coalesce("wrong", F.lit(0)).alias("dangling"))


@query("promotion_mapping", """
WITH o AS (SELECT o_custkey, o_orderkey AS k, substr(o_orderpriority, 1, 1) AS p, o_orderstatus AS s FROM orders)
SELECT o_custkey, 'regimen' AS kind, k::VARCHAR AS source_id, 'admin_' || k AS target_id FROM o WHERE p = '3' AND k % 3 <> 1
UNION ALL SELECT o_custkey, 'footnote', 'note_' || k, 'note_' || k FROM o WHERE s = 'F' AND k % 5 <> 0
UNION ALL SELECT o_custkey, 'titration', k::VARCHAR, 'elem_' || k || '_' || i FROM o, (VALUES (0), (1)) AS v(i) WHERE s = 'P'
""")
def promotion_mapping(spark, sf_dir):
    """What regimens, footnotes and titrations became."""
    done = promotion.promote(customer_designs(spark, sf_dir), "o_custkey")
    return done.select("o_custkey", F.explode("mapping").alias("m")).select("o_custkey", "m.*").filter("kind IN ('regimen', 'footnote', 'titration')")

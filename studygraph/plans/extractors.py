"""Rule-based extractors over all documents, each with a sentence as protocols have it behind its text."""

from __future__ import annotations

from pyspark.sql import functions as F

from studygraph.operators import extract
from studygraph.operators import rules as R
from studygraph.plans.labels import in_documents, in_documents_sql
from studygraph.registry import query, table

SENTENCES = (
    "Day 1 is defined as the first dose of study drug.",
    "Subjects attend a baseline visit 14 days after randomization, on day of randomization or later.",
    "Urine is collected daily; daily urine collection continues every 2 weeks.",
    "Treatment is given in cycles of 21 days, once daily on days 1 through 14.",
    "ECG is performed once at screening visit.",
    "Adverse events are recorded throughout, as needed upon occurrence.",
    "Screened subjects are enrolled, randomized 2:1 with a block size of 6 and receive treatment.",
    "Subjects who discontinue enter follow-up; subjects lost to follow-up or withdrawn are recorded, as is death.",
    "Dose is titrated from 10 mg to 20 mg to 40 mg.",
    "A two-period crossover with washout; sequence AB or BA.",
    "Glucose is sampled at 0, 30, 60 and 120 minutes, and within 2 hours of the meal.",
    "Change from baseline is assessed within 12 weeks.",
    "Nothing of interest here.",
    "",
)
DESIGNS = (
    "This is a 2-period crossover study: period 1 and period 2 with a washout of 14 days to prevent carryover. Sequence AB or sequence BA.",
    "A 3-way crossover trial with a 2-week washout period between treatment periods. Screening period, treatment period, follow-up.",
    "Dose escalation in a single-arm study; crossover design is not used.",
    "Screening visit, run-in phase, baseline visit on day 1, active treatment phase, end-of-treatment visit and 30-day safety follow-up. Early termination visit where subjects withdraw from the study.",
    "Nothing of interest here.",
)
OUTCOMES = (
    "Primary endpoint: Change from baseline in HbA1c at week 24. Responders are those who achieve a 30% reduction within 12 weeks after first administration.\nSecondary objective: Assess the fasting glucose, with response >= 7.0 mmol following rescue.",
    "Analysis\n1.1 Derived variable: percent change in weight is calculated as (post - pre) / pre. Baseline is defined as the last value before dosing.\n- Time to first event based on tumor size, using LOCF at week 12 ± 3 days.",
    "Safety endpoint: proportion with neutrophil < 1.5 at visit 3. Exploratory endpoint: formula: a minus b. Success is defined as more than half.",
    "Nothing of interest here.",
)
NOTES = (
    "a. Fasting for at least 10 hours before the sample\nb) Only for female subjects of childbearing potential\nc. short",
    "Table 1\nd. Collected in supine position by staff\nsee e. inline\n  f) Every 4 weeks until the end of treatment",
    "g. Any other remark of sufficient length",
    "no notes",
)


def _first_sql(rules, group: str = "regexp_extract_all(low, '({p})', 1)") -> str:
    """Of each text and kind the first rule that matches."""
    hits = " UNION ALL ".join(f"SELECT k, pos, low, {i} AS rule_no, '{kind}' AS kind, {c}::DOUBLE AS confidence, regexp_extract_all(low, '({p})', 1) AS m FROM t" for i, (p, kind, c) in enumerate(rules, 1))
    return f"t AS (SELECT k, pos, lower(label) AS low FROM {in_documents_sql(SENTENCES)}), h AS ({hits}), f AS (SELECT k, pos, kind, arg_min(confidence, rule_no) AS confidence, arg_min(m[1], rule_no) AS first, arg_min(len(m), rule_no) AS n, any_value(low) AS low FROM h WHERE len(m) > 0 GROUP BY k, pos, kind)"


@query("anchor_extract", f"""WITH {_first_sql(R.ANCHORS)}, w AS (SELECT *, strpos(low, first) AS place FROM f)
SELECT k, pos, kind, CASE kind {' '.join(f"WHEN '{k}' THEN '{d}'" for k, d in R.ANCHOR_DEFINITIONS.items())} ELSE first END AS definition, confidence,
  coalesce(TRY_CAST(nullif(regexp_extract(first || ' ' || substr(low, greatest(place - 100, 1), place + length(first) + 100 - greatest(place - 100, 1)), 'day\\s*(\\d+)', 1), '') AS INTEGER), 1) AS day, first FROM w
""")
def anchor_extract(spark, sf_dir):
    return extract.anchors(in_documents(spark, sf_dir, SENTENCES), "label", ["k", "pos"])


@query("repetition_extract", f"WITH {_first_sql(R.REPETITIONS)} SELECT k, pos, kind, confidence, first, n FROM f")
def repetition_extract(spark, sf_dir):
    return extract.first_per_kind(in_documents(spark, sf_dir, SENTENCES), "label", ["k", "pos"], R.REPETITIONS)


_KINDS = list(dict.fromkeys(k for _, k, _ in R.EXECUTION_TYPES))
_COUNTS = {k: [(f"len(regexp_extract_all(low, '{p}'))", c) for p, kind, c in R.EXECUTION_TYPES if kind == k] for k in _KINDS}


@query("execution_type", f"""
WITH t AS (SELECT k, pos, lower(label) AS low FROM {in_documents_sql(SENTENCES)}),
s AS (SELECT k, pos, [{', '.join(f"{{'n': {' + '.join(n for n, _ in found)}, 'confidence': greatest({', '.join(f'CASE WHEN {n} > 0 THEN {c}::DOUBLE ELSE 0.0 END' for n, c in found)}), 'at': {-i}, 'kind': '{kind}'}}" for i, (kind, found) in enumerate(_COUNTS.items()))}] AS s FROM t),
b AS (SELECT k, pos, list_max(s) AS b FROM s)
SELECT k, pos, CASE WHEN b.n > 0 THEN b.kind ELSE 'Single' END AS kind, CASE WHEN b.n > 0 THEN b.confidence ELSE 0.5 END AS confidence FROM b
""")
def execution_type(spark, sf_dir):
    return extract.best_kind(in_documents(spark, sf_dir, SENTENCES), "label", ["k", "pos"], R.EXECUTION_TYPES, "Single")


@query("footnote_extract", f"""
WITH l AS (SELECT k, pos, unnest(string_split(label, chr(10))) AS line FROM {in_documents_sql(NOTES)}),
n AS (SELECT k, pos, regexp_extract(line, '^\\s*([a-z])[.)]', 1) AS marker, trim(regexp_replace(line, '^\\s*[a-z][.)]\\s+', '')) AS note FROM l WHERE regexp_matches(line, '^\\s*[a-z][.)]\\s+'))
SELECT k, marker, note, CASE {' '.join(f"WHEN regexp_matches(lower(note), '{p}') THEN '{v}'" for p, v in extract.FOOTNOTE_CLASSES)} ELSE 'general' END AS kind FROM n WHERE length(note) > 15 AND length(note) < 800
""")
def footnote_extract(spark, sf_dir):
    from studygraph.functions.text import first_rule

    rows = in_documents(spark, sf_dir, NOTES).select("k", F.explode(extract.footnotes(F.col("label"))).alias("f")).select("k", "f.marker", "f.note")
    return rows.withColumn("kind", first_rule(F.lower("note"), extract.FOOTNOTE_CLASSES, "general", regex=True))


_WITHIN_SQL = r"""CASE WHEN regexp_matches({0}, 'within\s+[0-9]+\s+(minute|hour)') THEN 'PT' || regexp_extract({0}, 'within\s+([0-9]+)\s+(?:minute|hour|day|week)', 1) || upper(regexp_extract({0}, 'within\s+[0-9]+\s+([mh])', 1))
       WHEN regexp_matches({0}, 'within\s+[0-9]+\s+(day|week)') THEN 'P' || regexp_extract({0}, 'within\s+([0-9]+)\s+(?:minute|hour|day|week)', 1) || upper(regexp_extract({0}, 'within\s+[0-9]+\s+([dw])', 1)) END"""

_STATES_SQL = f"SELECT k, pos, list_filter([{', '.join(f"CASE WHEN regexp_matches(lower(label), '{p}') OR '{s}' = 'Screening' THEN '{s}' END" for s, p in extract.STATES)}], lambda x: x IS NOT NULL) AS states FROM {in_documents_sql(SENTENCES)}"


@query("state_extract", f"SELECT k, pos, array_to_string(states, ',') AS states FROM ({_STATES_SQL})")
def state_extract(spark, sf_dir):
    return extract.states(in_documents(spark, sf_dir, SENTENCES), "label", ["k", "pos"]).withColumn("states", F.array_join("states", ","))


@query("transition_extract", f"""
SELECT k, pos, f AS from_state, t AS to_state, g AS trigger FROM ({_STATES_SQL}) JOIN (VALUES {', '.join(f"('{a}', '{b}', '{c}')" for a, b, c in extract.TRANSITIONS)}) AS v(f, t, g) ON list_contains(states, f) AND list_contains(states, t)
""")
def transition_extract(spark, sf_dir):
    return extract.transitions(extract.states(in_documents(spark, sf_dir, SENTENCES), "label", ["k", "pos"]), ["k", "pos"])


@query("design_extract", f"""
SELECT k, pos, nullif(regexp_extract(lower(label), '([0-9]+(?::[0-9]+)+)', 1), '') AS ratio, TRY_CAST(nullif(regexp_extract(lower(label), 'block\\s+size\\s+(?:of\\s+)?([0-9]+)', 1), '') AS INTEGER) AS block_size,
  {_WITHIN_SQL.format('lower(label)')} AS window_iso,
  array_to_string(regexp_extract_all(regexp_extract(lower(label), 'at\\s+((?:[0-9]+(?:,\\s*|\\s+and\\s+))*[0-9]+)\\s+minutes', 1), '[0-9]+'), ',') AS minutes,
  CASE WHEN regexp_matches(lower(label), 'titrat|escalat|increase') AND len(regexp_extract_all(lower(label), '([0-9]+)\\s*mg', 1)) > 1 THEN len(regexp_extract_all(lower(label), '([0-9]+)\\s*mg', 1)) ELSE 0 END AS levels,
  ({' OR '.join(f"regexp_matches(lower(label), '{p}')" for p, _, _ in R.CROSSOVER)}) AND ({' + '.join(f"CASE WHEN regexp_matches(lower(label), '{p}') THEN 1 ELSE 0 END" for p in R.NOT_CROSSOVER)}) < 2 AS crossover
FROM {in_documents_sql(SENTENCES)}
""")
def design_extract(spark, sf_dir):
    rows = in_documents(spark, sf_dir, SENTENCES).withColumn("r", extract.randomization(F.col("label")))
    return rows.select(
        "k", "pos", "r.ratio", "r.block_size", extract.time_window(F.col("label")).alias("window_iso"), F.array_join(extract.sampling_minutes(F.col("label")), ",").alias("minutes"),
        F.size(extract.titration(F.col("label"))).cast("long").alias("levels"), extract.is_crossover(F.col("label")).alias("crossover"),
    )


def _first_of_sql(text: str, patterns) -> str:
    return "coalesce(" + ", ".join(f"nullif({_strip_sql(f"regexp_extract({text}, '{p}', 1)")}, '')" for p in patterns) + ")"


def _strip_sql(text: str) -> str:
    return f"regexp_replace({text}, '^\\s+|\\s+$', '', 'g')"


def _case_sql(text: str, pairs, default: str) -> str:
    return f"CASE {' '.join(f"WHEN regexp_matches({text}, '{p}') THEN {v}" for p, v in pairs)} ELSE {default} END"


def _rules_sql(found, default: str) -> str:
    return f"{_case_sql('low', [(p, f"'{k}'") for p, k, _ in found], f"'{default}'")} AS kind, {_case_sql('low', [(p, f'{c}::DOUBLE') for p, _, c in found], '0.5::DOUBLE')} AS confidence"


def _sections_sql(values, mark: str) -> str:
    cut = f"SELECT k, string_split(regexp_replace(label, '({mark})', chr(1) || '\\1', 'g'), chr(1)) AS parts FROM {in_documents_sql(values)}"
    return f"(SELECT k, section_no, section, lower(section) AS low FROM (SELECT k, unnest(parts) AS section, unnest(range(1, len(parts) + 1))::INTEGER AS section_no FROM ({cut})) WHERE length({_strip_sql('section')}) >= 30)"


_SEQUENCES_SQL = "list_distinct(list_transform(" + " || ".join(f"regexp_extract_all(low, '{p}', 1)" for p in R.SEQUENCES) + ", lambda x: upper(x)))"
_WASHOUT_SQL = "CASE " + " ".join(f"WHEN regexp_matches(low, '{p}') THEN 'P' || regexp_extract(low, '{p}', 1) || CASE WHEN contains(regexp_extract(low, '{p}', 0), 'week') THEN 'W' ELSE 'D' END" for p in R.WASHOUTS) + " END"


@query("crossover_extract", f"""
WITH t AS (SELECT k, lower(label) AS low FROM {in_documents_sql(DESIGNS)}),
c AS (SELECT k, low, list_max(list_filter([{', '.join(f"{{'confidence': {c}::DOUBLE, 'at': {-i}, 'source': regexp_extract(low, '({p})', 1)}}" for i, (p, _, c) in enumerate(R.CROSSOVER))}], lambda x: x.source <> '')) AS s,
  greatest(coalesce(TRY_CAST(nullif(regexp_extract(low, '(\\d+)[\\-\\s]?(?:period|way)\\s+crossover', 1), '') AS BIGINT), 2), coalesce(list_max(list_transform(regexp_extract_all(low, 'period\\s+(\\d+)', 1), lambda x: TRY_CAST(x AS BIGINT))), 0)) AS periods
  FROM t WHERE ({' OR '.join(f"regexp_matches(low, '{p}')" for p, _, _ in R.CROSSOVER)}) AND {' + '.join(f"regexp_matches(low, '{p}')::INTEGER" for p in R.NOT_CROSSOVER)} < 2)
SELECT k, s.confidence AS confidence, s.source AS source, periods, array_to_string(list_sort(CASE WHEN len({_SEQUENCES_SQL}) > 0 THEN {_SEQUENCES_SQL} WHEN periods = 2 THEN ['AB', 'BA'] WHEN periods = 3 THEN ['ABC', 'ACB', 'BAC', 'BCA', 'CAB', 'CBA'] ELSE [] END), ',') AS sequences,
  {_WASHOUT_SQL} AS washout, regexp_matches(low, '(?:prevent|minimize|avoid|reduce)\\s+(?:potential\\s+)?carry[\\-\\s]?over') AS carryover FROM c
""")
def crossover_extract(spark, sf_dir):
    return extract.crossovers(in_documents(spark, sf_dir, DESIGNS), "label", ["k"]).select("k", "confidence", "source", "periods", F.array_join(F.array_sort("sequences"), ",").alias("sequences"), "washout", "carryover")


@query("traversal_extract", f"""
WITH t AS (SELECT k, lower(label) AS low FROM {in_documents_sql(DESIGNS)}),
e AS (SELECT k, low, list_filter([{', '.join(f"CASE WHEN regexp_matches(low, '{p}') THEN '{e}' END" for e, p in R.EPOCHS)}], lambda x: x IS NOT NULL) AS e FROM t)
SELECT k, CASE WHEN len(e) = 0 THEN '{','.join(R.DEFAULT_EPOCHS)}' ELSE array_to_string(list_filter(e, lambda x: x <> 'END_OF_STUDY') || ['END_OF_STUDY'], ',') END AS epochs,
  concat_ws(',', 'Screening', {', '.join(f"CASE WHEN {' OR '.join(f"regexp_matches(low, '{p}')" for p, x in R.MANDATORY_VISITS if x == v)} THEN '{v}' END" for v in ("Day 1", "Baseline", "Randomization"))},
    CASE WHEN regexp_matches(low, '{R.MANDATORY_VISITS[3][0]}') OR regexp_matches(low, '{R.MANDATORY_VISITS[4][0]}') THEN 'End of Study' END, CASE WHEN regexp_matches(low, '{R.MANDATORY_VISITS[5][0]}') THEN 'Safety Follow-up' END,
    CASE WHEN NOT (regexp_matches(low, '{R.MANDATORY_VISITS[3][0]}') OR regexp_matches(low, '{R.MANDATORY_VISITS[4][0]}')) THEN 'End of Study' END) AS mandatory,
  {' OR '.join(f"regexp_matches(low, '{p}')" for p in R.EARLY_EXITS)} AS early_exit, concat_ws(',', {', '.join(f"CASE WHEN regexp_matches(low, '{p}') THEN '{v}' END" for p, v in R.EXIT_PROCEDURES)}) AS exit_procedures FROM e
""")
def traversal_extract(spark, sf_dir):
    found = extract.traversals(in_documents(spark, sf_dir, DESIGNS), "label", ["k"])
    return found.select("k", F.array_join("epochs", ",").alias("epochs"), F.array_join("mandatory", ",").alias("mandatory"), "early_exit", F.array_join("exit_procedures", ",").alias("exit_procedures"))


_THRESHOLD = r"(>=?|≥|<=?|≤)\s*(\d+(?:\.\d+)?)\s*(\S+)?"
_CHANGE = r"change\s+from\s+baseline\s+(?:in\s+)?(\w+)"
_BETTER = r"(\d+)%?\s+(?:or\s+more\s+)?(?:reduction|improvement|decrease)"


@query("endpoint_extract", f"""
WITH s AS (SELECT * FROM {_sections_sql(OUTCOMES, extract.ENDPOINT_MARK)}),
x AS (SELECT *, {_rules_sql(R.ENDPOINT_TYPES, "Exploratory")} FROM s)
SELECT k, section_no, kind, confidence, coalesce(substr({_first_of_sql("section", [extract.ENDPOINT_MARK + "[:\\s]*([^.]+)"])}, 1, 100), kind || ' Endpoint ' || section_no) AS name,
  array_to_string(list_sort(list_distinct(list_filter([{', '.join(f"'{x}'" for x in R.ENDPOINT_INPUTS)}], lambda i: contains(low, lower(i))) || regexp_extract_all(low, '(?:measure|assess|evaluate|determine)\\s+(?:the\\s+)?(\\w+(?:\\s+\\w+)?)', 1))), ';') AS inputs,
  {_first_of_sql("low", R.TIME_REFERENCES)} AS time_reference, {_WITHIN_SQL.format("low")} AS duration,
  coalesce({_first_of_sql("low", R.ENDPOINT_FORMULAS)}, nullif(concat_ws(' AND ',
    CASE WHEN contains(low, 'change from baseline') AND regexp_matches(low, '{_CHANGE}') THEN regexp_extract(low, '{_CHANGE}', 1) || '_postbaseline - ' || regexp_extract(low, '{_CHANGE}', 1) || '_baseline' END,
    CASE WHEN regexp_matches(section, '{_THRESHOLD}') THEN 'value ' || replace(replace(regexp_extract(section, '{_THRESHOLD}', 1), '≥', '>='), '≤', '<=') || ' ' || regexp_extract(section, '{_THRESHOLD}', 2) || regexp_extract(section, '{_THRESHOLD}', 3) END,
    CASE WHEN regexp_matches(low, 'responder|response') AND regexp_matches(low, '{_BETTER}') THEN 'improvement >= ' || regexp_extract(low, '{_BETTER}', 1) || '%' END), '')) AS algorithm,
  {_first_of_sql("low", R.SUCCESS)} AS success FROM x
""")
def endpoint_extract(spark, sf_dir):
    return extract.endpoints(in_documents(spark, sf_dir, OUTCOMES), "label", ["k"]).withColumn("inputs", F.array_join("inputs", ";"))


@query("variable_extract", f"""
WITH s AS (SELECT * FROM {_sections_sql(OUTCOMES, extract.VARIABLE_MARK)} WHERE {' OR '.join(f"contains(low, '{w}')" for w in R.VARIABLE_WORDS)}),
x AS (SELECT *, {_rules_sql(R.VARIABLE_TYPES, "Custom")} FROM s)
SELECT k, section_no, kind, confidence, coalesce(substr({_first_of_sql("section", [f"(?i){p}" for p in R.VARIABLE_NAMES])}, 1, 80), 'Derived Variable ' || section_no) AS name,
  array_to_string(list_sort(list_distinct(list_filter([{', '.join(f"'{x}'" for x in R.MEASUREMENTS)}], lambda i: contains(low, lower(i))) || regexp_extract_all(low, 'based\\s+on\\s+(?:the\\s+)?(\\w+(?:\\s+\\w+)?)', 1) || regexp_extract_all(low, 'using\\s+(?:the\\s+)?(\\w+(?:\\s+\\w+)?)', 1))), ';') AS sources,
  {_first_of_sql("low", R.BASELINES)} AS baseline, {_first_of_sql("low", R.BASELINE_VISITS)} AS baseline_visit,
  coalesce({_first_of_sql("low", R.DERIVATIONS)}, CASE kind {' '.join(f"WHEN '{k}' THEN '{d}'" for k, d in R.DERIVATION_OF_TYPE.items())} END) AS derivation, {_first_of_sql("low", R.ANALYSIS_WINDOWS)} AS analysis_window,
  {_case_sql("low", [(p, f"'{m}'") for p, m in R.IMPUTATIONS], "NULL")} AS imputation FROM x
""")
def variable_extract(spark, sf_dir):
    return extract.derived_variables(in_documents(spark, sf_dir, OUTCOMES), "label", ["k"]).withColumn("sources", F.array_join("sources", ";"))


@query("document_rules", """
WITH h AS (SELECT doc_id, 1 AS r, 'license' AS kind, len(regexp_extract_all(lower(text), 'licensed? under')) AS n FROM documents
  UNION ALL SELECT doc_id, 2, 'mail', len(regexp_extract_all(lower(text), '[a-z0-9.]+@[a-z0-9.]+')) FROM documents UNION ALL SELECT doc_id, 3, 'address', len(regexp_extract_all(lower(text), '[0-9]+\\.[0-9]+\\.[0-9]+\\.[0-9]+')) FROM documents)
SELECT doc_id, kind, n FROM h WHERE n > 0
""")
def document_rules(spark, sf_dir):
    """A generic rule table over all documents."""
    rules = ((r"licensed? under", "license", 1.0), (r"[a-z0-9.]+@[a-z0-9.]+", "mail", 1.0), (r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "address", 1.0))
    return extract.rule_hits(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", rules).select("doc_id", "kind", "n")


@query("day_range_join", """
WITH r AS (SELECT c_custkey, CAST(c_custkey % 200 AS INTEGER) AS lo, CAST(c_custkey % 200 + 10 AS INTEGER) AS hi FROM customer), d AS (SELECT dayofyear(o_orderdate) AS day, count(*) AS n FROM orders GROUP BY 1)
SELECT r.c_custkey, sum(n)::BIGINT AS bound FROM r JOIN d ON day BETWEEN lo AND hi GROUP BY 1
""")
def day_range_join(spark, sf_dir):
    """Instances whose day lies in a repetition's range: ranges are spread to days, so the join is on equal days. What is
    sent to all tasks are the days of a year with their counts, 366 rows at most, and never the ranges."""
    r = table(spark, sf_dir, "customer").select("c_custkey", F.explode(F.sequence((F.col("c_custkey") % 200).cast("int"), (F.col("c_custkey") % 200 + 10).cast("int"))).alias("day"))
    per_day = table(spark, sf_dir, "orders").groupBy(F.dayofyear("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    return r.join(F.broadcast(per_day), "day").groupBy("c_custkey").agg(F.sum("n").alias("bound"))


@query("group_header_filter", "SELECT p_partkey FROM part WHERE lower(p_name) NOT IN (SELECT lower(p_name) FROM part WHERE p_partkey % 50 = 0)")
def group_header_filter(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    heads = p.filter("p_partkey % 50 = 0").select(F.lower("p_name").alias("name")).distinct()
    return p.withColumn("name", F.lower("p_name")).join(heads, "name", "left_anti").select("p_partkey")


@query("hallucination_filter", "SELECT event_id, value >= 50 AND event_type = 'error' AS flagged FROM events WHERE NOT (value >= 90 AND event_type = 'error')")
def hallucination_filter(spark, sf_dir):
    """Events flagged with enough confidence go; the others stay, tagged."""
    e = table(spark, sf_dir, "events")
    flags = e.filter("event_type = 'error' AND value >= 50").select("event_id", F.col("value").alias("confidence"))
    return e.select("event_id").join(flags, "event_id", "left").filter("confidence IS NULL OR confidence < 90").select("event_id", F.col("confidence").isNotNull().alias("flagged"))


@query("order_overlay", """
SELECT n_nationkey, row_number() OVER (ORDER BY pos NULLS LAST, n_nationkey) AS place FROM nation LEFT JOIN (VALUES (7, 1), (3, 2), (19, 3)) AS v(k, pos) ON k = n_nationkey
""")
def order_overlay(spark, sf_dir):
    """Listed rows first, in the order listed; the others as they were."""
    from pyspark.sql import Window

    listed = spark.createDataFrame([(7, 1), (3, 2), (19, 3)], "n_nationkey int, pos int")
    n = table(spark, sf_dir, "nation").select("n_nationkey").join(F.broadcast(listed), "n_nationkey", "left")
    return n.select("n_nationkey", F.row_number().over(Window.orderBy(F.col("pos").asc_nulls_last(), "n_nationkey")).cast("long").alias("place"))  # the rows of one table on a screen



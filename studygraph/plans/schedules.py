"""Schedules, graphs, integrity, completeness and metrics over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from studygraph.operators import match, schedule, validate
from studygraph.operators.reconcile import needs_review as review_rule
from studygraph.registry import query, table

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def cells(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@query("matrix_long", """
SELECT u.user_id, t.event_type, count(e.event_id) AS n, count(e.event_id) > 0 AS ticked FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN (SELECT DISTINCT event_type FROM events) t
LEFT JOIN events e ON e.user_id = u.user_id AND e.event_type = t.event_type GROUP BY ALL
""")
def matrix_long(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return schedule.matrix(e, e, cells(spark, sf_dir), "user_id", "event_type").select("user_id", "event_type", F.coalesce("n", F.lit(0)).alias("n"), "ticked")


@query("matrix_pivot", "SELECT user_id, " + ", ".join(f"nullif(count(*) FILTER (event_type = '{t}'), 0) AS \"{t}\"" for t in EVENT_TYPES) + " FROM events GROUP BY user_id")
def matrix_pivot(spark, sf_dir):
    return schedule.wide(cells(spark, sf_dir), "user_id", "event_type", EVENT_TYPES, F.sum("n"))


@query("matrix_unpivot", "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL")
def matrix_unpivot(spark, sf_dir):
    """The wide grid back as cells."""
    return matrix_pivot(spark, sf_dir).unpivot(["user_id"], list(EVENT_TYPES), "event_type", "n").filter("n IS NOT NULL")


@query("needs_review", """
WITH c AS (SELECT user_id, event_type, min(event_id) AS f FROM events GROUP BY ALL)
SELECT user_id, event_type, coalesce(s IN ('needs_review', 'vision'), false) OR (s IS NULL AND f % 2 = 0) AS review
FROM (SELECT *, CASE f % 5 WHEN 0 THEN 'text' WHEN 1 THEN 'vision' WHEN 2 THEN 'both' WHEN 3 THEN 'needs_review' END AS s FROM c)
""")
def needs_review(spark, sf_dir):
    f = F.col("first_event") % 5
    source = F.when(f == 0, "text").when(f == 1, "vision").when(f == 2, "both").when(f == 3, "needs_review")
    return cells(spark, sf_dir).select("user_id", "event_type", review_rule(source, F.lit(True), F.col("first_event") % 2 != 0).alias("review"))


@query("prev_next_chain", """
SELECT conv_id, turn, lag(turn) OVER w AS previous_id, lead(turn) OVER w AS next_id FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
""")
def prev_next_chain(spark, sf_dir):
    return schedule.chained(table(spark, sf_dir, "conversations").select("conv_id", "turn"), "conv_id", ["turn"], "turn")


@query("sequence_edges", """
SELECT * FROM (SELECT user_id, event_id AS from_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS to_id FROM events) WHERE to_id IS NOT NULL
""")
def sequence_edges(spark, sf_dir):
    return schedule.edges(table(spark, sf_dir, "events").select("user_id", "ts", "event_id"), "user_id", ["ts", "event_id"], "event_id")


@query("graph_validation", """
WITH n AS (SELECT c_custkey AS id FROM customer WHERE c_custkey % 11 <> 0), e AS (SELECT o_orderkey AS edge, o_custkey AS node FROM orders)
SELECT edge, node, 'missing_endpoint' AS fault FROM e WHERE node NOT IN (SELECT id FROM n)
UNION ALL SELECT NULL, id, 'isolated' FROM n WHERE id NOT IN (SELECT node FROM e)
""")
def graph_validation(spark, sf_dir):
    nodes = table(spark, sf_dir, "customer").filter("c_custkey % 11 <> 0").select(F.col("c_custkey").alias("node"))
    links = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("edge"), F.col("o_custkey").alias("node"))
    missing = validate.dangling(links, "node", nodes, "node").select("edge", "node", F.lit("missing_endpoint").alias("fault"))
    return missing.union(validate.orphans(nodes, "node", links, "node").select(F.lit(None).cast("long").alias("edge"), "node", F.lit("isolated").alias("fault")))


@query("duplicate_number", """
SELECT s_suppkey, CASE WHEN count(*) OVER (PARTITION BY s_nationkey) > 1 THEN 'Site (' || row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) || ')' ELSE 'Site' END AS unique_name FROM supplier
""")
def duplicate_number(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", F.lit("Site").alias("name"))
    return schedule.numbered_names(s, "s_nationkey", "s_suppkey", "name", "unique_name").select("s_suppkey", "unique_name")


@query("running_layout", """
WITH r AS (SELECT n_regionkey, CAST(greatest(300, count(*) * 160) + 50 AS BIGINT) AS width FROM nation GROUP BY 1)
SELECT n_regionkey, width, CAST(coalesce(sum(width) OVER (ORDER BY n_regionkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS x FROM r
""")
def running_layout(spark, sf_dir):
    r = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.count("*").alias("n"))
    return schedule.running_x(r, "n_regionkey", "n").select("n_regionkey", "width", "x")


@query("recurrence_expand", """
WITH r AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderkey % 2 = 0 THEN 7 ELSE 1 END AS step, CAST(o_orderkey % 30 AS INTEGER) AS span FROM orders),
x AS (SELECT o_orderkey, CAST(unnest(generate_series(d, CAST(d + span AS DATE), to_days(step))) AS DATE) AS day FROM r)
SELECT x.o_orderkey, x.day, count(l_orderkey) AS lines FROM x LEFT JOIN lineitem ON l_orderkey = x.o_orderkey AND CAST(l_shipdate AS DATE) = x.day GROUP BY ALL
""")
def recurrence_expand(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    days = schedule.expand_recurrence(o, F.col("d"), F.date_add("d", (F.col("o_orderkey") % 30).cast("int")), F.make_dt_interval(F.when(F.col("o_orderkey") % 2 == 0, 7).otherwise(1)), "day")
    shipped = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"), F.to_date("l_shipdate").alias("day")).agg(F.count("*").alias("lines"))
    return days.select("o_orderkey", "day").join(shipped, ["o_orderkey", "day"], "left").select("o_orderkey", "day", F.coalesce("lines", F.lit(0)).alias("lines"))


@query("fk_dangling", """
SELECT o_orderkey, o_custkey, 'o_custkey->c_custkey' AS rule, 'error' AS severity FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0)
""")
def fk_dangling(spark, sf_dir):
    parents = table(spark, sf_dir, "customer").filter("c_custkey % 7 <> 0")
    return validate.dangling(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", parents, "c_custkey").select("o_orderkey", "o_custkey", "rule", "severity")


@query("orphans", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0)")
def orphans(spark, sf_dir):
    return validate.orphans(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey", table(spark, sf_dir, "orders").filter("o_orderkey % 3 = 0"), "o_custkey")


@query("missing_link", "SELECT o_orderkey FROM orders WHERE CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_custkey END IS NULL")
def missing_link(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_custkey")).alias("o_custkey"))
    return validate.issues(o, "o_orderkey", [("order without customer", "warning", F.col("o_custkey").isNull())]).select("o_orderkey")


@query("window_conflict", """
SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) AS n, min(o_orderkey) AS first_id FROM orders GROUP BY ALL HAVING count(*) > 1
""")
def window_conflict(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderkey")
    return schedule.conflicts(o, ["o_custkey", "day"], "o_orderkey")


@query("state_reachability", """
WITH e AS (SELECT user_id, event_type AS a, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events), t AS (SELECT DISTINCT user_id, a, b FROM e WHERE b IS NOT NULL AND a <> b)
SELECT DISTINCT user_id, a AS state, 'unreachable' AS fault FROM t WHERE a <> 'view' AND NOT EXISTS (SELECT 1 FROM t x WHERE x.user_id = t.user_id AND x.b = t.a)
UNION ALL SELECT DISTINCT user_id, b, 'dead_end' FROM t WHERE NOT EXISTS (SELECT 1 FROM t x WHERE x.user_id = t.user_id AND x.a = t.b)
""")
def state_reachability(spark, sf_dir):
    """Faults of each user's machine of event types, of which every event is a transition."""
    chain = schedule.chained(table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", ["ts", "event_id"], "event_type")
    t = chain.select("user_id", F.col("event_type").alias("from_state"), F.col("next_id").alias("to_state")).filter("to_state IS NOT NULL AND from_state <> to_state")
    return schedule.machine_faults(t, "user_id", "view")


_RULES = (
    ("R001", "error", "o_totalprice <= 1000"),
    ("R002", "warning", "o_orderstatus = 'P'"),
    ("R010", "warning", "o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'"),
    ("R020", "error", "o_custkey % 97 = 0"),
)


@query("conformance_rules", " UNION ALL ".join(f"SELECT o_orderkey, '{r}' AS rule, '{s}' AS severity FROM orders WHERE {p}" for r, s, p in _RULES))
def conformance_rules(spark, sf_dir):
    return validate.issues(table(spark, sf_dir, "orders"), "o_orderkey", [(r, s, F.expr(p)) for r, s, p in _RULES])


@query("execution_score", f"""
WITH i AS ({' UNION ALL '.join(f"SELECT o_custkey, '{s}' AS severity FROM orders WHERE {p}" for _, s, p in _RULES)})
SELECT c_custkey, round(greatest(0.0, least(1.0, 1.0 - 0.15 * count(*) FILTER (severity = 'error') - 0.05 * count(*) FILTER (severity = 'warning'))), 6)::DOUBLE AS score
FROM customer LEFT JOIN i ON o_custkey = c_custkey GROUP BY c_custkey
""")
def execution_score(spark, sf_dir):
    found = validate.issues(table(spark, sf_dir, "orders").withColumn("c_custkey", F.col("o_custkey")), "c_custkey", [(r, s, F.expr(p)) for r, s, p in _RULES])
    n = found.groupBy("c_custkey").agg(F.count_if(F.col("severity") == "error").alias("e"), F.count_if(F.col("severity") == "warning").alias("w"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(n, "c_custkey", "left").select("c_custkey", F.round(validate.quality_score(F.coalesce("e", F.lit(0)), F.coalesce("w", F.lit(0))), 6).alias("score"))


_PRF = """
WITH x AS (SELECT lang, quality = 1 AS g, n_chars > 1000 AS f FROM documents JOIN labels USING (doc_id)),
t AS (SELECT lang, count(*) FILTER (g AND f) AS tp, count(*) FILTER (NOT g AND f) AS fp, count(*) FILTER (g AND NOT f) AS fn FROM x GROUP BY lang),
p AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 1.0 END AS r FROM t)
"""


def _prf(spark, sf_dir):
    x = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id")
    return match.precision_recall(x, ["lang"], F.col("quality") == 1, F.col("n_chars") > 1000)


@query("prf1", _PRF + "SELECT lang, tp, fp, fn, round(p, 6)::DOUBLE AS precision, round(r, 6)::DOUBLE AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 6)::DOUBLE AS f1 FROM p")
def prf1(spark, sf_dir):
    return _prf(spark, sf_dir).select("lang", "tp", "fp", "fn", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"), F.round("f1", 6).alias("f1"))


@query("prf1_macro", _PRF + "SELECT round(avg(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END), 6)::DOUBLE AS macro_f1, count(*) AS groups FROM p WHERE tp + fn > 0")
def prf1_macro(spark, sf_dir):
    return _prf(spark, sf_dir).filter("tp + fn > 0").agg(F.round(F.avg("f1"), 6).alias("macro_f1"), F.count("*").alias("groups"))


@query("confidence_score", """
SELECT c_custkey, round(0.6 * (CASE WHEN c_acctbal > 0 THEN 1.0 ELSE 0.0 END + CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END + CASE WHEN c_mktsegment <> 'BUILDING' THEN 1.0 ELSE 0.0 END) / 3
  + 0.4 * CASE WHEN n >= 10 THEN 1.0 WHEN n > 0 THEN 0.5 ELSE 0.0 END, 6)::DOUBLE AS confidence
FROM (SELECT c_custkey, c_acctbal, c_mktsegment, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL)
""")
def confidence_score(spark, sf_dir):
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    c = table(spark, sf_dir, "customer").join(n, "c_custkey", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    score = validate.confidence([F.col("c_acctbal") > 0, F.col("n") > 0, F.col("c_mktsegment") != "BUILDING"], F.when(F.col("n") >= 10, 1.0).when(F.col("n") > 0, 0.5).otherwise(0.0))
    return c.select("c_custkey", F.round(score, 6).alias("confidence"))


@query("field_population", " UNION ALL ".join(f"SELECT '{c}' AS field, count(*) FILTER (x IS NOT NULL AND x NOT IN ('', '0')) AS populated, count(*) AS total, round(count(*) FILTER (x IS NOT NULL AND x NOT IN ('', '0')) / count(*), 6)::DOUBLE AS share FROM (SELECT CAST(CASE WHEN {k} % 6 = 0 THEN NULL ELSE {c} END AS VARCHAR) AS x FROM orders)" for c, k in (("o_orderpriority", "o_orderkey"), ("o_custkey", "o_custkey"))))
def field_population(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 6 != 0, F.col("o_orderpriority")).alias("o_orderpriority"), F.when(F.col("o_custkey") % 6 != 0, F.col("o_custkey")).alias("o_custkey"))
    return validate.field_population(o, ["o_orderpriority", "o_custkey"])


@query("linkage_pct", "SELECT round(100.0 * count(DISTINCT o_custkey) / (SELECT count(*) FROM customer), 6)::DOUBLE AS linked_pct FROM orders WHERE o_orderkey % 4 = 0")
def linkage_pct(spark, sf_dir):
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").filter("o_orderkey % 4 = 0").select(F.col("o_custkey").alias("c_custkey"), F.lit(1).alias("linked")).distinct()
    return c.join(o, "c_custkey", "left").agg(F.round(100.0 * F.count("linked") / F.count("*"), 6).alias("linked_pct"))


@query("gap_audit", """
WITH raw AS (SELECT o_orderpriority AS kind, count(*) AS n FROM orders GROUP BY 1), parsed AS (SELECT o_orderpriority AS kind, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)
SELECT kind, raw.n AS raw_n, coalesce(parsed.n, 0) AS parsed_n, raw.n - coalesce(parsed.n, 0) AS gap FROM raw LEFT JOIN parsed USING (kind) WHERE raw.n > coalesce(parsed.n, 0)
""")
def gap_audit(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("kind")).agg(F.count("*").alias("raw_n"), F.count_if(F.col("o_orderstatus") != "P").alias("parsed_n"))
    return o.withColumn("gap", F.col("raw_n") - F.col("parsed_n")).filter("gap > 0")


@query("token_rollup", """
SELECT role, CAST(sum(length(text)) AS BIGINT) AS tokens, count(*) AS calls, round(sum(length(text)) * CASE WHEN role IS NULL THEN 0.0 WHEN role = 'assistant' THEN 75.0 ELSE 15.0 END / 1000000, 6)::DOUBLE AS cost FROM conversations GROUP BY ROLLUP (role)
""")
def token_rollup(spark, sf_dir):
    n = table(spark, sf_dir, "conversations").rollup("role").agg(F.sum(F.length("text")).alias("tokens"), F.count("*").alias("calls"))
    rate = F.when(F.col("role").isNull(), 0.0).when(F.col("role") == "assistant", 75.0).otherwise(15.0)
    return n.select("role", "tokens", "calls", F.round(F.col("tokens") * rate / 1_000_000, 6).alias("cost"))


@query("cross_defaults", "SELECT r_regionkey, p AS o_orderpriority, coalesce(r_name, 'Default') || ' / ' || p AS cell FROM region CROSS JOIN (SELECT DISTINCT o_orderpriority AS p FROM orders)")
def cross_defaults(spark, sf_dir):
    arms, epochs = table(spark, sf_dir, "region"), table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    return arms.crossJoin(epochs).select("r_regionkey", "o_orderpriority", F.concat_ws(" / ", F.coalesce("r_name", F.lit("Default")), "o_orderpriority").alias("cell"))


@query("json_extension_lookup", "SELECT user_id, count(*) AS n, CAST(max(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS largest FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY user_id")
def json_extension_lookup(spark, sf_dir):
    k = F.from_json("props", "k long").getField("k")
    return table(spark, sf_dir, "events").filter(k.isNotNull()).groupBy("user_id").agg(F.count("*").alias("n"), F.max(k).alias("largest"))


@query("sites_by_country", "SELECT n_name AS country, count(s_suppkey) AS sites, coalesce(string_agg(s_name, '; ' ORDER BY s_name), '') AS names FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name")
def sites_by_country(spark, sf_dir):
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "supplier"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return n.groupBy(F.col("n_name").alias("country")).agg(F.count("s_suppkey").alias("sites"), F.array_join(F.array_sort(F.collect_list("s_name")), "; ").alias("names"))

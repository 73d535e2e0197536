"""Merging, enriching and rewriting over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from studygraph.functions.text import first_rule
from studygraph.operators import merge, validate
from studygraph.registry import query, table


@query("merge_windows", """
WITH p AS (SELECT o_custkey, dayofyear(o_orderdate) AS day, CASE WHEN count(*) % 2 = 0 THEN 0 ELSE count(*) END AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL),
s AS (SELECT o_custkey, dayofyear(o_orderdate) AS day, count(*) * 100 AS n FROM orders WHERE o_orderstatus <> 'F' GROUP BY ALL)
SELECT coalesce(p.o_custkey, s.o_custkey) AS o_custkey, coalesce(p.day, s.day) AS day, coalesce(nullif(p.n, 0), s.n) AS n, CASE WHEN p.o_custkey IS NULL THEN 'secondary' ELSE 'primary' END AS origin
FROM p FULL JOIN s ON p.o_custkey = s.o_custkey AND p.day = s.day
""")
def merge_windows(spark, sf_dir):
    """Visits of a customer by day: those of the first source, filled from and followed by those of the second."""
    o = table(spark, sf_dir, "orders").select("o_custkey", F.dayofyear("o_orderdate").cast("long").alias("day"), "o_orderstatus")
    p = o.filter("o_orderstatus = 'F'").groupBy("o_custkey", "day").agg(F.count("*").alias("c")).select("o_custkey", "day", F.when(F.col("c") % 2 == 0, 0).otherwise(F.col("c")).alias("n"))
    s = o.filter("o_orderstatus <> 'F'").groupBy("o_custkey", "day").agg((F.count("*") * 100).alias("n"))
    return merge.enhance(p, s, ["o_custkey", "day"], ["n"])


@query("dosing_consolidate", """
SELECT lower(p_type) AS key, arg_min(p_partkey, (-(CASE WHEN p_size > 25 THEN 1 ELSE 0 END + CASE WHEN p_retailprice > 1200 THEN 1 ELSE 0 END), p_partkey)) AS p_partkey FROM part GROUP BY 1
""")
def dosing_consolidate(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_type", "p_partkey", "p_size", "p_retailprice")
    return merge.most_complete(p, F.lower("p_type"), [F.col("p_size") > 25, F.col("p_retailprice") > 1200], "p_partkey").select("key", "p_partkey")


@query("component_merge", """
SELECT c_custkey AS k, c_mktsegment AS segment, NULL AS balance, 'customer' AS kind FROM customer UNION ALL SELECT s_suppkey, NULL, s_acctbal, 'supplier' FROM supplier
""")
def component_merge(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("kind"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("kind"))
    return merge.unite(c, s)


@query("ocr_refs", """
SELECT c_custkey, CASE r WHEN 'l' THEN '1' WHEN 'i' THEN '1' WHEN '0' THEN 'o' WHEN '5' THEN 's' ELSE r END AS ref FROM (SELECT c_custkey, ['l', 'i', '0', '5', 'q', 'a', '1'][CAST(c_custkey % 7 + 1 AS INTEGER)] AS r FROM customer)
""")
def ocr_refs(spark, sf_dir):
    mark = F.element_at(F.array(*map(F.lit, ("l", "i", "0", "5", "q", "a", "1"))), (F.col("c_custkey") % 7 + 1).cast("int"))
    valid = F.array(*map(F.lit, ("1", "o", "s", "a", "b")))
    return table(spark, sf_dir, "customer").select("c_custkey", merge.corrected_refs(F.array(mark), valid)[0].alias("ref"))


@query("identifier_type", f"""
SELECT s_suppkey, id, CASE {' '.join(f"WHEN regexp_matches(lower(id), '{p}') THEN '{v}'" for p, v in merge.IDENTIFIERS)} ELSE 'Sponsor' END AS kind
FROM (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'NCT' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') WHEN 1 THEN '2020-' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') || '-11' WHEN 2 THEN 'IND ' || s_suppkey ELSE 'ABC-' || s_suppkey END AS id FROM supplier)
""")
def identifier_type(spark, sf_dir):
    k = F.col("s_suppkey")
    id_ = F.when(k % 4 == 0, F.concat(F.lit("NCT"), F.lpad(k.cast("string"), 8, "0"))).when(k % 4 == 1, F.concat(F.lit("2020-"), F.lpad(k.cast("string"), 6, "0"), F.lit("-11"))).when(k % 4 == 2, F.concat(F.lit("IND "), k)).otherwise(F.concat(F.lit("ABC-"), k))
    return table(spark, sf_dir, "supplier").select("s_suppkey", id_.alias("id")).withColumn("kind", first_rule(F.lower("id"), merge.IDENTIFIERS, "Sponsor", regex=True))


_SEGMENTS = {"building": ("C1", "Building"), "machinery": ("C2", "Machinery"), "automobile": ("C3", "Automobile")}


@query("code_object", f"""
SELECT c_custkey, CASE lower(c_mktsegment) {' '.join(f"WHEN '{k}' THEN '{c}'" for k, (c, _) in _SEGMENTS.items())} ELSE c_mktsegment END AS code,
  CASE lower(c_mktsegment) {' '.join(f"WHEN '{k}' THEN '{d}'" for k, (_, d) in _SEGMENTS.items())} ELSE c_mktsegment END AS decode FROM customer
""")
def code_object(spark, sf_dir):
    return merge.coded(table(spark, sf_dir, "customer"), "c_mktsegment", _SEGMENTS, "http://www.cdisc.org", "2024-09-27").select("c_custkey", "code.code", "code.decode")


@query("enrichment_report", f"SELECT c_mktsegment AS kind, count(*) AS total, count(*) FILTER (lower(c_mktsegment) IN ({', '.join(f"'{k}'" for k in _SEGMENTS)})) AS enriched FROM customer GROUP BY 1")
def enrichment_report(spark, sf_dir):
    c = merge.coded(table(spark, sf_dir, "customer"), "c_mktsegment", _SEGMENTS, "http://www.cdisc.org", "2024-09-27")
    return c.groupBy(F.col("c_mktsegment").alias("kind")).agg(F.count("*").alias("total"), F.count_if(F.col("code.code") != F.col("c_mktsegment")).alias("enriched"))


@query("reference_rewrite", """
WITH r AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS pos FROM lineitem),
s AS (SELECT l_orderkey, string_agg('part_' || p_partkey, ',' ORDER BY pos) AS refs FROM r JOIN part ON p_partkey = l_partkey WHERE p_partkey % 3 <> 0 GROUP BY l_orderkey)
SELECT o_orderkey, coalesce(refs, '') AS refs FROM orders LEFT JOIN s ON l_orderkey = o_orderkey
""")
def reference_rewrite(spark, sf_dir):
    """References of every order to parts, by their new ids; those that are unknown go."""
    held = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"))), lambda s: F.concat(F.lit("p"), s["l_partkey"])).alias("refs"))
    o = table(spark, sf_dir, "orders").select("o_orderkey").join(held, "o_orderkey", "left")
    known = table(spark, sf_dir, "part").filter("p_partkey % 3 <> 0").select(F.concat(F.lit("p"), "p_partkey").alias("old"), F.concat(F.lit("part_"), "p_partkey").alias("new"))
    return merge.rewrite_references(o, "o_orderkey", "refs", known, "old", "new").select("o_orderkey", F.array_join("refs", ",").alias("refs"))


@query("cell_precedence", "SELECT user_id, event_type, arg_min(event_id, (event_id % 3 = 0, ts, event_id)) AS event_id FROM events GROUP BY ALL")
def cell_precedence(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", (F.col("event_id") % 3 == 0).alias("enriched"), F.struct("ts", "event_id").alias("o"))
    return merge.precedence(e, ["user_id", "event_type"], "enriched", "o").select("user_id", "event_type", "event_id")


@query("activity_source", "SELECT p_partkey, CASE WHEN p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_orderkey % 4 = 0) THEN 'soa' ELSE 'procedure_enrichment' END AS source FROM part")
def activity_source(spark, sf_dir):
    ticked = table(spark, sf_dir, "lineitem").filter("l_orderkey % 4 = 0").select(F.col("l_partkey").alias("p_partkey"), F.lit("soa").alias("source")).distinct()
    return table(spark, sf_dir, "part").select("p_partkey").join(ticked, "p_partkey", "left").select("p_partkey", F.coalesce("source", F.lit("procedure_enrichment")).alias("source"))


@query("sorted_entities", "SELECT s_nationkey, s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY coalesce(CASE WHEN s_suppkey % 3 <> 0 THEN CAST(s_acctbal AS INTEGER) % 50 END, 9999), s_name) AS place FROM supplier")
def sorted_entities(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").withColumn("day", F.when(F.col("s_suppkey") % 3 != 0, F.rint("s_acctbal").cast("int") % 50))
    return merge.placed(s, [F.coalesce("day", F.lit(9999)), F.col("s_name")], "s_nationkey").select("s_nationkey", "s_suppkey", "place")


_METHODS = "(VALUES ('ANCOVA model'), ('t test'), ('Kaplan Meier'), ('Cox'), ('Log-Rank test'), ('Bayesian'), ('MMRM'), ('Fisher exact')) AS v(method)"
_PLAIN = "regexp_replace(lower(method), '[\\s-]', '', 'g')"


@query("method_operations", f"SELECT c_custkey, method, CASE {' '.join(f"WHEN contains({_PLAIN}, '{n.replace('-', '')}') OR contains('{n.replace('-', '')}', {_PLAIN}) THEN {k}" for n, k in merge.METHOD_OPERATIONS)} ELSE 2 END AS operations FROM customer CROSS JOIN {_METHODS}")
def method_operations(spark, sf_dir):
    m = spark.createDataFrame([(x,) for x in ("ANCOVA model", "t test", "Kaplan Meier", "Cox", "Log-Rank test", "Bayesian", "MMRM", "Fisher exact")], "method string")
    return table(spark, sf_dir, "customer").select("c_custkey").crossJoin(F.broadcast(m)).withColumn("operations", merge.method_operations(F.col("method")))


@query("distinct_notes")
def distinct_notes(spark, sf_dir):
    """The turns of each conversation that repeat no earlier one."""
    return merge.distinct_notes(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), "conv_id", "turn", "text")


@query("required_fields", """
SELECT o_orderkey, 'o_orderpriority' AS attribute, 'missing' AS problem FROM orders WHERE o_orderkey % 6 = 0
UNION ALL SELECT o_orderkey, 'lines', 'empty' FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)
""")
def required_fields(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").filter("l_quantity > 45").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set("l_linenumber").alias("lines"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 6 != 0, F.col("o_orderpriority")).alias("o_orderpriority")).join(lines, "o_orderkey", "left")
    return merge.catalogue_issues(o, "o_orderkey", [("o_orderpriority", "1"), ("lines", "1..*"), ("o_orderkey", "0..1")])


@query("terminology_check", "SELECT p_partkey, p_brand FROM part WHERE p_brand NOT IN (SELECT DISTINCT p_brand FROM part WHERE p_partkey % 20 = 0 AND p_size > 10)")
def terminology_check(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    codes = table(spark, sf_dir, "part").filter("p_partkey % 20 = 0 AND p_size > 10").select("p_brand")
    return validate.dangling(p, "p_brand", codes, "p_brand").select("p_partkey", "p_brand")


@query("clinical_epoch_type", """
SELECT user_id, 'Study Period ' || user_id || coalesce(' | ' || CASE WHEN bool_or(event_type = 'signup') THEN 'Screening' WHEN bool_or(event_type = 'purchase') THEN 'Treatment' WHEN bool_or(event_type = 'error') THEN 'Follow-up' END, '') AS name FROM events GROUP BY user_id
""")
def clinical_epoch_type(spark, sf_dir):
    """Periods named by what their visits are, in order of precedence."""
    has = lambda t: F.bool_or(F.col("event_type") == t)
    kind = F.when(has("signup"), "Screening").when(has("purchase"), "Treatment").when(has("error"), "Follow-up")
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(kind.alias("kind"))
    return e.select("user_id", F.concat_ws(" | ", F.concat(F.lit("Study Period "), "user_id"), "kind").alias("name"))


@query("window_propagation", """
WITH w AS (SELECT c_custkey AS id, 'v' || (c_custkey % 40) AS name, c_custkey % 9 AS days FROM customer WHERE c_custkey % 5 = 0), n AS (SELECT name, arg_min(days, id) AS days FROM w GROUP BY name)
SELECT c_custkey, coalesce(w.days, n.days) AS days, CASE WHEN w.days IS NOT NULL THEN 1 WHEN n.days IS NOT NULL THEN 2 END AS tier
FROM customer LEFT JOIN w ON w.id = c_custkey LEFT JOIN n ON n.name = 'v' || (c_custkey % 40)
""")
def window_propagation(spark, sf_dir):
    """Windows carried to encounters by id, else by name."""
    from studygraph.operators.match import cascade, first_per_key

    c = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("v"), F.col("c_custkey") % 40).alias("name"))
    w = c.filter("c_custkey % 5 = 0").withColumn("days", F.col("c_custkey") % 9)
    by_name = first_per_key(w, ["name"], [F.col("c_custkey")])
    return cascade(c, [(w, "c_custkey", "days"), (by_name, "name", "days")], "days").select("c_custkey", "days", "tier")


@query("model_comparison", "SELECT l_shipmode AS model, count(*) AS runs, round(avg(l_quantity), 6) AS mean_count, count(*) FILTER (l_returnflag <> 'R') AS succeeded FROM (SELECT l_linestatus || l_returnflag AS l_shipmode, l_quantity, l_returnflag FROM lineitem) GROUP BY 1")
def model_comparison(spark, sf_dir):
    """Runs of each model: how many, how many succeeded, and what they found on average."""
    l = table(spark, sf_dir, "lineitem").withColumn("model", F.concat("l_linestatus", "l_returnflag"))
    return l.groupBy("model").agg(F.count("*").alias("runs"), F.round(F.avg("l_quantity"), 6).alias("mean_count"), F.count_if(F.col("l_returnflag") != "R").alias("succeeded"))

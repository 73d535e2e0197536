"""Graphs, marks and distinct counts over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studygraph.operators import diagram, distinct, marks
from studygraph.registry import query, table


def nation_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The graph of a study for each nation: segments are its epochs, customers its encounters, orders its instances."""
    c = table(spark, sf_dir, "customer").withColumn("study", F.col("c_nationkey").cast("long"))
    o = table(spark, sf_dir, "orders").join(c.select("study", "c_custkey"), F.col("o_custkey") == F.col("c_custkey"))
    key = F.col("c_custkey")
    epochs = c.filter("c_mktsegment <> 'MACHINERY'").select("study", F.col("c_mktsegment").alias("id"), F.col("c_mktsegment").alias("pos"), F.lower("c_mktsegment").alias("name")).distinct()
    encounters = c.select("study", key.alias("pos"), key.cast("string").alias("id"), F.when(key % 5 == 0, "Day 1").otherwise(F.concat(F.lit("Visit "), key)).alias("name"), F.col("c_mktsegment").alias("epoch_id"), F.when(key % 3 == 0, F.concat(F.lit("±"), key % 4)).alias("window"))
    activities = o.select("study", F.substr("o_orderpriority", F.lit(1), F.lit(1)).alias("id"), F.col("o_orderpriority").alias("name"), F.lit(None).cast("string").alias("label")).filter("id <> '5'").distinct()
    instances = o.select("study", F.col("o_orderkey").alias("pos"), F.col("o_orderkey").cast("string").alias("id"), F.when(F.col("o_orderstatus") == "P", "Other").otherwise("ScheduledActivityInstance").alias("kind"), F.col("o_custkey").cast("string").alias("encounter_id"), F.array(F.substr("o_orderpriority", F.lit(1), F.lit(1))).alias("activity_ids"))
    timings = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("long").alias("study"), F.col("s_suppkey").alias("pos"), F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"), F.lit("P1D").alias("value"), F.lit(None).cast("string").alias("window"), F.lit("").alias("relative_to"), (F.col("s_suppkey") % 2 == 0).alias("is_anchor"))
    anchors = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("study"), F.when(F.col("n_regionkey") == 0, "Baseline").otherwise("Other").alias("kind"))
    return diagram.graph(epochs, encounters, activities, instances, timings, anchors)


_ENC = """e AS (SELECT DISTINCT c_nationkey::BIGINT AS study, c_mktsegment AS id FROM customer WHERE c_mktsegment <> 'MACHINERY'),
w AS (SELECT study, id, greatest(300, (SELECT count(*) FROM customer c WHERE c.c_nationkey = e.study AND c.c_mktsegment = e.id) * 160) + 50 AS width FROM e),
p AS (SELECT study, id, 80 + coalesce(sum(width) OVER (PARTITION BY study ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS x, lead(id) OVER (PARTITION BY study ORDER BY id) AS next FROM w),
c AS (SELECT p.study, c_custkey AS k, p.x + 160 * (row_number() OVER (PARTITION BY p.study, p.id ORDER BY c_custkey) - 1) AS x, lead(c_custkey) OVER (PARTITION BY p.study ORDER BY c_custkey) AS next FROM customer JOIN p ON p.study = c_nationkey AND p.id = c_mktsegment),
a AS (SELECT c.study, c.k, c.x, o_orderkey AS o, substr(o_orderpriority, 1, 1) AS act, o_orderpriority AS label, 250 + 55 * (row_number() OVER (PARTITION BY c.study, c.k ORDER BY o_orderkey) - 1) AS y FROM orders JOIN c ON o_custkey = c.k WHERE o_orderstatus <> 'P' AND o_orderpriority NOT LIKE '5%')"""


@query("graph_nodes", f"""
WITH {_ENC}
SELECT study, 'epoch_' || id AS id, lower(id) AS label, 'epoch' AS type, id AS ref, x::BIGINT AS x, 50::BIGINT AS y, FALSE AS is_anchor FROM p
UNION ALL SELECT study, 'enc_' || k, CASE WHEN k % 5 = 0 THEN 'Day 1' ELSE 'Visit ' || k END, 'timing', k::VARCHAR, x::BIGINT, 150, k % 5 = 0 AND n_regionkey = 0 FROM c JOIN nation ON n_nationkey = study
UNION ALL SELECT study, 'window_' || k, '±' || (k % 4), 'window', k::VARCHAR, x::BIGINT, 120, FALSE FROM c WHERE k % 3 = 0
UNION ALL SELECT study, 'act_' || o || '_' || act, label, 'activity', act, x::BIGINT, y::BIGINT, FALSE FROM a
UNION ALL SELECT s_nationkey, 'timing_' || s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN '⚓' || chr(10) ELSE '' END || s_name || chr(10) || 'P1D', CASE WHEN s_suppkey % 2 = 0 THEN 'anchor' ELSE 'timing' END, s_suppkey::VARCHAR,
  (80 + 140 * (row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1))::BIGINT, 320, s_suppkey % 2 = 0 FROM supplier
""")
def graph_nodes(spark, sf_dir):
    return nation_graph(spark, sf_dir)[0]


@query("graph_edges", f"""
WITH {_ENC}
SELECT study, 'window_edge_' || k AS id, 'window_' || k AS source, 'enc_' || k AS target, 'window' AS type FROM c WHERE k % 3 = 0
UNION ALL SELECT study, 'seq_' || k || '_' || next, 'enc_' || k, 'enc_' || next, 'sequence' FROM c WHERE next IS NOT NULL
UNION ALL SELECT study, 'link_' || k || '_' || act, 'enc_' || k, 'act_' || o || '_' || act, 'activity' FROM a
UNION ALL SELECT study, 'epoch_trans_' || id || '_' || next, 'epoch_' || id, 'epoch_' || next, 'transition' FROM p WHERE next IS NOT NULL
""")
def graph_edges(spark, sf_dir):
    return nation_graph(spark, sf_dir)[1]


@query("graph_faults", f"""
WITH {_ENC}
SELECT study, 'missing_endpoint' AS fault, 'link_' || k || '_' || act AS id FROM a WHERE y > 400 GROUP BY ALL
UNION ALL SELECT study, 'missing_endpoint', 'seq_' || k || '_' || next FROM c WHERE next % 4 = 0 OR (next IS NOT NULL AND k % 4 = 0)
UNION ALL SELECT study, 'missing_endpoint', 'window_edge_' || k FROM c WHERE k % 12 = 0
UNION ALL SELECT study, 'missing_endpoint', 'link_' || k || '_' || act FROM a WHERE k % 4 = 0 AND 'link_' || k || '_' || act NOT IN (SELECT 'link_' || k || '_' || act FROM a WHERE y > 400) GROUP BY ALL
UNION ALL SELECT study, 'duplicate_id', 'epoch_' || id FROM p WHERE study % 2 = 0
UNION ALL SELECT study, 'invalid_position', 'window_' || k FROM c WHERE k % 3 = 0 AND k % 7 = 0
""")
def graph_faults(spark, sf_dir):
    """The graph after some of its nodes were lost, doubled or displaced."""
    nodes, edges = nation_graph(spark, sf_dir)
    left = nodes.filter("NOT (type = 'activity' AND y > 400) AND NOT (id LIKE 'enc_%' AND CAST(ref AS BIGINT) % 4 = 0)")
    moved = left.withColumn("x", F.when(~((F.col("type") == "window") & (F.col("ref").try_cast("long") % 7 == 0)), F.col("x")))
    return diagram.graph_faults(moved.unionByName(nodes.filter("type = 'epoch' AND study % 2 = 0")), edges)


@query("schedule_marks", """
WITH s AS (SELECT s_suppkey AS k, s_suppkey % 4 AS m FROM supplier)
SELECT k, 'Screening' AS epoch, 'a' AS epoch_refs, 'Visit ' || k || ' here' AS encounter, CASE WHEN m = 1 THEN 'lb' ELSE '1b' END AS encounter_refs, 'Weight' AS activity, CASE WHEN m = 3 THEN 'Zx' ELSE 'zx' END AS activity_refs,
  CASE WHEN m = 1 THEN 1 ELSE 0 END AS corrected, CASE m WHEN 0 THEN 4 WHEN 1 THEN 3 WHEN 2 THEN 2 ELSE 0 END AS invalid FROM s
""")
def schedule_marks(spark, sf_dir):
    """The marks of every supplier's schedule: notes with the marks a; with a, l; with a, b, 1; and without marks."""
    k = F.col("s_suppkey")
    item = lambda id_, name, *refs: F.array(F.struct(F.lit(id_).alias("id"), name.alias("name"), F.array(*map(F.lit, refs)).cast("array<string>").alias("refs")))
    notes = F.element_at(F.array(F.array(F.lit("a. first")), F.array(F.lit("A) first"), F.lit("l second")), F.array(F.lit("a. x"), F.lit("b. y"), F.lit("1. z")), F.array(F.lit("no mark"))), (k % 4 + 1).cast("int"))
    schedules = table(spark, sf_dir, "supplier").select(k.alias("k"), item("p", F.lit("Screeningᵃ")).alias("epochs"), item("e", F.concat(F.lit("Visit "), k, F.lit(" here¹ᵇ"))).alias("encounters"), item("a", F.lit("Weightˣ "), "Z").alias("activities"), notes.alias("notes"))
    done = marks.normalized_schedule(schedules, ["k"])
    refs = lambda p: F.array_join(F.col(p)[0]["refs"], "")
    return done.select("k", F.col("epochs")[0]["name"].alias("epoch"), refs("epochs").alias("epoch_refs"), F.col("encounters")[0]["name"].alias("encounter"), refs("encounters").alias("encounter_refs"), F.col("activities")[0]["name"].alias("activity"), refs("activities").alias("activity_refs"), F.size("corrections").alias("corrected"), F.size("invalid").alias("invalid"))


@query("merged_distinct", """
SELECT l_returnflag, l_linestatus, GROUPING(l_returnflag, l_linestatus)::INTEGER AS grouping, count(*) AS n_rows, count(DISTINCT l_partkey) AS exact, TRUE AS near FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)
""")
def merged_distinct(spark, sf_dir):
    """Distinct parts by return flag and line status and over both, from sketches kept for each supplier: within five
    standard errors of the exact count."""
    lines = table(spark, sf_dir, "lineitem")
    kept = distinct.kept_sketches(lines, ["l_suppkey", "l_returnflag", "l_linestatus"], "l_partkey")
    found = distinct.merged_counts(kept, ["l_returnflag", "l_linestatus"])
    exact = lines.cube("l_returnflag", "l_linestatus").agg(F.countDistinct("l_partkey").alias("exact")).select(F.col("l_returnflag").alias("f"), F.col("l_linestatus").alias("s"), "exact")
    both = found.join(exact, F.col("l_returnflag").eqNullSafe(F.col("f")) & F.col("l_linestatus").eqNullSafe(F.col("s")))
    return both.select("l_returnflag", "l_linestatus", "grouping", F.col("rows").alias("n_rows"), "exact", (F.abs(F.col("distinct") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * 0.08)).alias("near"))

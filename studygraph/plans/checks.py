"""Composite checks and views: cross references, execution integrity, analyses, ordered footnotes, filtered provenance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studygraph.operators import merge, reconcile, schedule, validate
from studygraph.plans.entities import _TAGS, tags
from studygraph.registry import query, table


@query("cross_references", """
WITH c AS (SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0), p AS (SELECT p_partkey FROM part WHERE p_partkey % 5 <> 0),
o AS (SELECT s_suppkey FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_quantity > 49.5))
SELECT 'order' AS entity, o_orderkey AS id, 'o_custkey->c_custkey' AS rule, 'error' AS severity FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM c)
UNION ALL SELECT 'line', l_orderkey, 'l_partkey->p_partkey', 'warning' FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM p)
UNION ALL SELECT 'supplier', s_suppkey, 'orphan', 'warning' FROM o WHERE (SELECT count(*) FROM o) < 10
""")
def cross_references(spark, sf_dir):
    """Dangling references by severity; orphans only where there are fewer than ten."""
    c, p = table(spark, sf_dir, "customer").filter("c_custkey % 7 <> 0"), table(spark, sf_dir, "part").filter("p_partkey % 5 <> 0")
    orders = validate.dangling(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", c, "c_custkey").select(F.lit("order").alias("entity"), F.col("o_orderkey").alias("id"), "rule", "severity")
    lines = validate.dangling(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey"), "l_partkey", p, "p_partkey", "warning").select(F.lit("line").alias("entity"), F.col("l_orderkey").alias("id"), "rule", "severity")
    lonely = validate.orphans(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey", table(spark, sf_dir, "lineitem").filter("l_quantity > 49.5").select("l_suppkey"), "l_suppkey")
    few = lonely.crossJoin(lonely.agg(F.count("*").alias("n"))).filter("n < 10")  # the count is one row
    return orders.union(lines).union(few.select(F.lit("supplier"), "s_suppkey", F.lit("orphan"), F.lit("warning")))


@query("semantic_validity", """
SELECT o_custkey, count(*) FILTER (o_totalprice <= 1000 OR o_custkey % 97 = 0) = 0 AS valid FROM orders GROUP BY o_custkey
""")
def semantic_validity(spark, sf_dir):
    """A document is valid unless it has an error."""
    found = validate.issues(table(spark, sf_dir, "orders"), "o_custkey", [("price", "error", F.col("o_totalprice") <= 1000), ("customer", "error", F.col("o_custkey") % 97 == 0), ("status", "warning", F.col("o_orderstatus") == "P")])
    wrong = found.groupBy("o_custkey").agg(F.bool_or(F.col("severity") == "error").alias("wrong"))
    return table(spark, sf_dir, "orders").select("o_custkey").distinct().join(wrong, "o_custkey", "left").select("o_custkey", (~F.coalesce("wrong", F.lit(False))).alias("valid"))


@query("execution_integrity", """
WITH e AS (SELECT user_id, event_id, event_type, value, dayofyear(ts) AS day FROM events)
SELECT user_id, 'sign_mismatch' AS fault, count(*) AS n FROM e WHERE value > 90 AND day < 100 GROUP BY user_id
UNION ALL SELECT user_id, 'duplicate_name', sum(n)::BIGINT FROM (SELECT user_id, event_type, day, count(*) AS n FROM e GROUP BY ALL HAVING count(*) > 1) GROUP BY user_id
""")
def execution_integrity(spark, sf_dir):
    """Days whose sign does not fit, and names that a day has more than once."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", F.dayofyear("ts").alias("day"))
    sign = e.filter("value > 90 AND day < 100").groupBy("user_id").agg(F.count("*").alias("n")).select("user_id", F.lit("sign_mismatch").alias("fault"), "n")
    same = schedule.conflicts(e, ["user_id", "event_type", "day"], "event_id").groupBy("user_id").agg(F.sum("n").alias("n")).select("user_id", F.lit("duplicate_name").alias("fault"), "n")
    return sign.union(same)


@query("analysis_linkage", """
WITH s AS (SELECT n_nationkey AS set_id, n_regionkey AS kind FROM nation WHERE n_nationkey % 3 = 0), f AS (SELECT min(n_nationkey) AS d FROM nation WHERE n_nationkey % 3 = 0)
SELECT s_suppkey, coalesce(x.set_id, f.d) AS set_id, CASE WHEN s_suppkey % 2 = 0 THEN 'AC_Primary' ELSE 'AC_Sensitivity' END AS reason
FROM supplier CROSS JOIN f LEFT JOIN (SELECT kind, min(set_id) AS set_id FROM s GROUP BY kind) x ON x.kind = s_nationkey % 7
""")
def analysis_linkage(spark, sf_dir):
    """Analyses linked to the first set of their population's kind, else to the default set."""
    sets = table(spark, sf_dir, "nation").filter("n_nationkey % 3 = 0").select(F.col("n_nationkey").alias("set_id"), F.col("n_regionkey").alias("kind"))
    by_kind, default = sets.groupBy("kind").agg(F.min("set_id").alias("set_id")), sets.agg(F.min("set_id").alias("d"))
    a = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_nationkey") % 7).alias("kind")).join(by_kind, "kind", "left").crossJoin(default)  # the default is one row
    return a.select("s_suppkey", F.coalesce("set_id", "d").alias("set_id"), F.when(F.col("s_suppkey") % 2 == 0, "AC_Primary").otherwise("AC_Sensitivity").alias("reason"))


@query("footnote_sort", """
WITH m AS (SELECT DISTINCT CASE WHEN c_custkey % 3 = 0 THEN chr(97 + CAST(c_custkey % 26 AS INTEGER)) ELSE CAST(c_custkey % 40 AS VARCHAR) END AS mark FROM customer)
SELECT mark, row_number() OVER (ORDER BY TRY_CAST(mark AS INTEGER) NULLS LAST, mark) AS place FROM m
""")
def footnote_sort(spark, sf_dir):
    """Footnote marks, numbers first and by their value."""
    mark = F.when(F.col("c_custkey") % 3 == 0, F.char(97 + F.col("c_custkey") % 26)).otherwise((F.col("c_custkey") % 40).cast("string"))
    marks = table(spark, sf_dir, "customer").select(mark.alias("mark")).distinct()
    return merge.placed(marks, [F.col("mark").try_cast("int").asc_nulls_last(), F.col("mark").asc()])


@query("provenance_filter", f"""
SELECT user_id, event_type FROM (SELECT user_id, event_type, CASE WHEN count(DISTINCT source) > 1 THEN 'both' ELSE min(source) END AS source FROM {_TAGS} GROUP BY ALL) WHERE source <> 'both' AND contains(event_type, 'i')
""")
def provenance_filter(spark, sf_dir):
    """Cells of one source class whose name holds a text."""
    return reconcile.merge_provenance(tags(spark, sf_dir), ["user_id", "event_type"]).filter((F.col("source") != "both") & F.contains("event_type", F.lit("i"))).select("user_id", "event_type")


@query("enrichment_epochs", """
WITH k AS (SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM'))
SELECT l_orderkey, count(*) AS instances FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM k) GROUP BY l_orderkey
""")
def enrichment_epochs(spark, sf_dir):
    """Only epochs that the schedule has stay, and only their instances."""
    wanted = spark.createDataFrame([("1-URGENT",), ("3-MEDIUM",)], "o_orderpriority string")
    kept = table(spark, sf_dir, "orders").join(F.broadcast(wanted), "o_orderpriority", "left_semi").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, sf_dir, "lineitem").join(kept, "l_orderkey", "left_semi").groupBy("l_orderkey").agg(F.count("*").alias("instances"))


@query("document_inventory", """
SELECT 'customer' AS kind, count(*) AS n FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'order', count(*) FROM orders UNION ALL SELECT 'line', count(*) FROM lineitem
""")
def document_inventory(spark, sf_dir):
    """How many entities there are of each kind."""
    def counted(name: str, kind: str) -> DataFrame:
        return table(spark, sf_dir, name).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")

    return reduce(DataFrame.union, [counted(*x) for x in (("customer", "customer"), ("supplier", "supplier"), ("orders", "order"), ("lineitem", "line"))])

"""Answers of models, nested values and study structures, made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from studygraph.functions import text as T
from studygraph.operators import reconcile, validate
from studygraph.plans.entities import _TAGS
from studygraph.registry import query, scratch, table
from studygraph.streaming.provenance import stored_stream

_ANSWER = """'{"user": ' || user_id || ', "type": "' || event_type || '", "props": ' || props || '}'"""


@query("json_continuation", f"""
WITH j AS (SELECT event_id, {_ANSWER} AS j FROM events), c AS (SELECT event_id, j, (5 + event_id % (length(j) - 10))::INTEGER AS cut FROM j),
p AS (SELECT event_id, rtrim(left(j, cut)) AS b, ltrim(substr(j, (cut + 1 - least(cut, (event_id % 3) * 11))::INTEGER)) AS m FROM c),
o AS (SELECT event_id, b, m, list_filter(range(least(100, length(b), length(m)), 10, -10), lambda n: ends_with(b, left(m, n::INTEGER)))[1] AS n FROM p)
SELECT event_id, CASE WHEN left(m, 1) IN ('}}', ']') THEN b || m WHEN n IS NOT NULL THEN b || substr(m, n + 1) WHEN regexp_matches(right(b, 1), '["}}0-9]') AND left(m, 1) = '{{' THEN b || ',' || chr(10) || m ELSE b || m END AS answer FROM o
""")
def json_continuation(spark, sf_dir):
    """Answers cut short, with continuations that repeat some of the end."""
    answer = F.concat(F.lit('{"user": '), "user_id", F.lit(', "type": "'), "event_type", F.lit('", "props": '), "props", F.lit("}"))
    j = table(spark, sf_dir, "events").select("event_id", answer.alias("j")).withColumn("cut", (5 + F.col("event_id") % (F.length("j") - 10)).cast("int"))
    more = F.expr("substr(j, CAST(cut + 1 - least(cut, (event_id % 3) * 11) AS INT))")
    return j.select("event_id", T.continued_json(F.expr("left(j, cut)"), more).alias("answer"))


_SHAPES = (
    ('{"activities": [{"id": "a", "name": "n"}, {"id": "b", "name": "m"}], "k": 1}', None),
    ('{"activities": [{"id": "a", "name": "n"}, {"id": "b"}]}', "Activity 1 missing 'name'"),
    ('{"activities": [{"name": "n"}]}', "Activity 0 missing 'id'"),
    ('{"study": {}}', "Response has wrong structure"),
    ('{"x": 1}', "Missing 'activities' key in response"),
    ('{"activities": {}}', "'activities' must be an array"),
    ('{"activities": []}', "Expected at least 1 activities, got 0"),
    ('{"activities": [1]}', "Activity 0 is not an object"),
    ("no JSON", "Missing 'activities' key in response"),
)


@query("response_shape", f"SELECT event_id, CASE event_id % {len(_SHAPES)} {' '.join(f"WHEN {i} THEN '{w.replace(chr(39), chr(39) * 2)}'" for i, (_, w) in enumerate(_SHAPES) if w)} END AS fault FROM events")
def response_shape(spark, sf_dir):
    answer = F.element_at(F.array(*[F.lit(a) for a, _ in _SHAPES]), (F.col("event_id") % len(_SHAPES) + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", T.response_fault(answer).alias("fault"))


@query("canonical_values", """SELECT value, count(*) AS n FROM (SELECT '{"a":{"x":"' || event_type || '","y":1},"b":' || user_id || '}' AS value FROM events) GROUP BY value""")
def canonical_values(spark, sf_dir):
    """Nested values as keys: those with other orders of keys and other spaces are equal."""
    e = table(spark, sf_dir, "events")
    one, two = F.format_string('{"b": %s, "a": {"y": 1, "x": "%s"}}', "user_id", "event_type"), F.format_string('{ "a" :{"x":"%s", "y":1},"b":%s}', "event_type", "user_id")
    return e.select(T.canonical_json(F.when(F.col("event_id") % 2 == 0, one).otherwise(two)).alias("value")).groupBy("value").agg(F.count("*").alias("n"))


@query("map_merge", """
WITH c AS (SELECT user_id, event_type, event_id, CASE WHEN event_id % 3 = 0 THEN 20 ELSE 10 END AS priority, CASE WHEN event_id % 3 = 0 THEN 'vision' ELSE 'text' END AS source FROM events WHERE event_type <> 'error')
SELECT user_id, event_type, arg_max(event_id, (-priority, source, event_id)) AS event_id FROM c GROUP BY ALL
""")
def map_merge(spark, sf_dir):
    """Maps of several sources merged key by key."""
    e = table(spark, sf_dir, "events").withColumn("found", F.when(F.col("event_type") != "error", F.create_map("event_type", "event_id")))
    vision = F.col("event_id") % 3 == 0
    both = reconcile.contribute(e.filter(vision), "vision", 20, "event_id").unionByName(reconcile.contribute(e.filter(~vision), "text", 10, "event_id"))
    return reconcile.reconcile(both, ["user_id"], {"found": "map"}).select("user_id", F.explode("found").alias("event_type", "event_id"))


@query("deep_merge", """
SELECT c_custkey, coalesce(CASE WHEN c_custkey % 2 = 0 THEN 'new' END, c_mktsegment) AS segment, coalesce(CASE WHEN c_custkey % 3 = 0 THEN 0.0 END, c_acctbal) AS balance, CASE WHEN c_custkey % 5 = 0 THEN 'x' WHEN c_custkey % 7 = 0 THEN 'y' ELSE NULL END AS tag,
  c_custkey % 5 = 0 OR c_custkey % 7 = 0 AS tagged FROM customer
""")
def deep_merge(spark, sf_dir):
    """Nested values with overrides: only what the override has is replaced."""
    k = F.col("c_custkey")
    base = F.struct(F.col("c_mktsegment").alias("segment"), F.struct(F.col("c_acctbal").alias("balance"), F.when(k % 7 == 0, F.create_map(F.lit("t"), F.lit("y"))).alias("tags")).alias("more"))
    over = F.struct(F.when(k % 2 == 0, F.lit("new")).alias("segment"), F.when((k % 3 == 0) | (k % 5 == 0), F.struct(F.when(k % 3 == 0, F.lit(0.0)).alias("balance"), F.when(k % 5 == 0, F.create_map(F.lit("t"), F.lit("x"))).alias("tags"))).alias("more"))
    c = table(spark, sf_dir, "customer").select("c_custkey", base.alias("b"), over.alias("o"))
    out = c.select("c_custkey", reconcile.deep_merged(F.col("b"), F.col("o"), c.schema["b"].dataType).alias("m"))
    tag = F.try_element_at("m.more.tags", F.lit("t"))
    return out.select("c_custkey", "m.segment", "m.more.balance", tag.alias("tag"), tag.isNotNull().alias("tagged"))


@query("study_conformance", """
WITH v AS (SELECT o_custkey AS id, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1)::INTEGER AS version, o_orderkey AS o FROM orders WHERE o_custkey % 11 NOT IN (0, 1)),
d AS (SELECT id, version, (row_number() OVER (PARTITION BY id, version ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1)::INTEGER AS design, l_partkey AS p FROM v JOIN lineitem ON l_orderkey = o AND l_quantity > 25)
SELECT c_custkey AS id, 'USDM001' AS rule, 'ERROR' AS severity, NULL::INTEGER AS version, NULL::INTEGER AS design FROM customer WHERE c_custkey % 11 = 0
UNION ALL SELECT c_custkey, 'USDM002', 'ERROR', NULL, NULL FROM customer WHERE c_custkey NOT IN (SELECT id FROM v)
UNION ALL SELECT id, 'USDM010', 'WARNING', version, NULL FROM v WHERE o % 3 = 0 UNION ALL SELECT id, 'USDM011', 'WARNING', version, NULL FROM v WHERE o % 5 = 0
UNION ALL SELECT id, 'USDM020', 'WARNING', version, NULL FROM v WHERE (id, version) NOT IN (SELECT (id, version) FROM d)
UNION ALL SELECT id, 'USDM030', 'WARNING', version, design FROM d WHERE p % 2 = 0 UNION ALL SELECT id, 'USDM031', 'WARNING', version, design FROM d WHERE p % 3 = 0 UNION ALL SELECT id, 'USDM032', 'WARNING', version, design FROM d WHERE p % 7 = 0
""")
def study_conformance(spark, sf_dir):
    """Customers as studies, their orders as versions and large lines as designs, parts of which are missing."""
    some = lambda c, n: F.when(F.col(c) % n != 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    lines = table(spark, sf_dir, "lineitem").filter("l_quantity > 25").withColumn("s", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", some("l_partkey", 2).alias("scheduleTimelines"), some("l_partkey", 3).alias("eligibilityCriteria"), some("l_partkey", 7).alias("objectives")))
    designs = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list("s")).alias("studyDesigns"))
    orders = table(spark, sf_dir, "orders").filter("o_custkey % 11 > 1").join(designs, "o_orderkey", "left")
    version = F.struct("o_orderkey", some("o_orderkey", 3).alias("titles"), some("o_orderkey", 5).alias("studyIdentifiers"), "studyDesigns")
    versions = orders.groupBy(F.col("o_custkey").alias("id")).agg(F.array_sort(F.collect_list(version)).alias("versions"))
    studies = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")).join(versions, "id", "left").select("id", F.when(F.col("id") % 11 != 0, F.struct("versions")).alias("study"))
    return validate.study_conformance(studies, "id", "study")


@query("traversal_contribution", """
WITH e AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n, max(o_orderkey) OVER (PARTITION BY o_custkey) AS last FROM orders)
SELECT o_custkey, o_orderkey, 1 AS sequence_order, 'main' AS category FROM e WHERE n = 2 UNION ALL SELECT o_custkey, o_orderkey, 2, 'main' FROM e WHERE o_orderkey = last UNION ALL SELECT o_custkey, o_orderkey, 4, 'main' FROM e WHERE n = 1
""")
def traversal_contribution(spark, sf_dir):
    """Of each customer's orders as epochs: those that its sequence names by number or by id."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    last = orders.groupBy("o_custkey").agg(F.array(F.lit("epoch_2"), F.max("o_orderkey").cast("string"), F.lit("epoch_9999"), F.lit("epoch_1")).alias("sequence"))
    return reconcile.contribute_traversal(orders.join(last, "o_custkey"), "o_custkey", "o_orderkey", "o_orderkey", "sequence").select("o_custkey", "o_orderkey", "sequence_order", "category")


@query("stream_provenance", f"SELECT user_id, event_type, CASE WHEN count(DISTINCT source) > 1 THEN 'both' ELSE min(source) END AS source FROM {_TAGS} GROUP BY ALL")
def stream_provenance(spark, sf_dir):
    """provenance_merge from a stream over the events."""
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parque[t]")
    source = F.when(F.col("event_id") % 3 == 0, F.lit("vision")).otherwise(F.lit("text"))
    folder = scratch(spark, "stream")
    return stored_stream(stream.select("user_id", "event_type", source.alias("source")), ["user_id", "event_type"], f"{folder}/merged", f"{folder}/checkpoint")

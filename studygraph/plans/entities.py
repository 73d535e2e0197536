"""Matching, reconciling and provenance over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from studygraph.operators import match, reconcile
from studygraph.registry import query, table


@query("exact_name_join", """
SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON lower(trim(replace(c_name, 'Customer', 'Entity'))) = lower(trim(replace(s_name, 'Supplier', 'Entity')))
""")
def exact_name_join(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.lower(F.trim(F.replace("c_name", F.lit("Customer"), F.lit("Entity")))).alias("name"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.lower(F.trim(F.replace("s_name", F.lit("Supplier"), F.lit("Entity")))).alias("name"))
    return c.join(s, "name").select("c_custkey", "s_suppkey")


@query("cascade_link", """
WITH p AS (SELECT p_partkey AS l_partkey, 'part ' || p_name AS v FROM part WHERE p_partkey % 3 = 0), s AS (SELECT s_suppkey AS l_suppkey, 'supplier ' || s_name AS v FROM supplier WHERE s_suppkey % 2 = 0),
o AS (SELECT o_orderkey AS l_orderkey, 'order ' || o_orderstatus AS v FROM orders WHERE o_orderkey % 5 <> 0)
SELECT l_orderkey, l_linenumber, coalesce(p.v, s.v, o.v) AS target, CASE WHEN p.v IS NOT NULL THEN 1 WHEN s.v IS NOT NULL THEN 2 WHEN o.v IS NOT NULL THEN 3 END AS tier
FROM lineitem LEFT JOIN p USING (l_partkey) LEFT JOIN s USING (l_suppkey) LEFT JOIN o USING (l_orderkey)
""")
def cascade_link(spark, sf_dir):
    p = table(spark, sf_dir, "part").filter("p_partkey % 3 = 0").select(F.col("p_partkey").alias("l_partkey"), F.concat(F.lit("part "), "p_name").alias("v"))
    s = table(spark, sf_dir, "supplier").filter("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("l_suppkey"), F.concat(F.lit("supplier "), "s_name").alias("v"))
    o = table(spark, sf_dir, "orders").filter("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("l_orderkey"), F.concat(F.lit("order "), "o_orderstatus").alias("v"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return match.cascade(lines, [(p, "l_partkey", "v"), (s, "l_suppkey", "v"), (o, "l_orderkey", "v")], "target").select("l_orderkey", "l_linenumber", "target", "tier")


@query("substring_link", """
WITH d AS (SELECT doc_id, text FROM documents), b AS (SELECT item_id, text AS t FROM benchmark)
SELECT item_id, count(*) AS n, min(doc_id) AS first_doc FROM d JOIN b ON contains(d.text, b.t) GROUP BY item_id
""")
def substring_link(spark, sf_dir):
    hits = match.contained(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), "item_id", "doc_id")
    return hits.groupBy("item_id").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))


@query("fuzzy_levenshtein", """
WITH c AS (SELECT c_nationkey AS k, c_custkey, replace(c_name, 'Customer', 'Entity') AS n FROM customer), s AS (SELECT s_nationkey AS k, s_suppkey, replace(s_name, 'Supplier', 'Entity') AS n FROM supplier)
SELECT c_custkey, s_suppkey, round(1 - levenshtein(c.n, s.n) / greatest(length(c.n), length(s.n)), 6) AS similarity FROM c JOIN s USING (k)
WHERE round(1 - levenshtein(c.n, s.n) / greatest(length(c.n), length(s.n)), 6) >= 0.85
""")
def fuzzy_levenshtein(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"), "c_custkey", F.replace("c_name", F.lit("Customer"), F.lit("Entity")).alias("n"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"), "s_suppkey", F.replace("s_name", F.lit("Supplier"), F.lit("Entity")).alias("n"))
    return match.levenshtein_pairs(c, s, "k", "n", 0.85).select(F.col("l_c_custkey").alias("c_custkey"), F.col("r_s_suppkey").alias("s_suppkey"), "similarity")


@query("fuzzy_ratcliff")
def fuzzy_ratcliff(spark, sf_dir):
    """Part names against the names of parts of one brand and size, by Ratcliff-Obershelp ratio."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", F.lower("p_name").alias("name"))
    q = p.select(F.col("p_partkey").alias("other_key"), "p_brand", "p_size", F.col("name").alias("other"))
    alike = match.ratcliff_names(p.select("p_brand", "p_size", "name"), ["p_brand", "p_size"], "name", 0.6)
    pairs = p.join(alike, "name").join(q, ["p_brand", "p_size", "other"]).filter("p_partkey < other_key")
    return pairs.select("p_partkey", "other_key", F.round("ratio", 6).alias("ratio"))


@query("greedy_match")
def greedy_match(spark, sf_dir):
    """Customers matched one to one with the suppliers of their nation, by edit similarity of their names."""
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_custkey").alias("id"), F.replace("c_name", F.lit("Customer"), F.lit("Entity")).alias("n"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"), F.col("s_suppkey").alias("id"), F.replace("s_name", F.lit("Supplier"), F.lit("Entity")).alias("n"))
    return match.greedy_names(c, s, "k", "id", "n", 0.7)


@query("leader_clusters")
def leader_clusters(spark, sf_dir):
    """Part names clustered by leader within brand."""
    return match.leader_clusters(table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_name"), "p_brand", "p_partkey", "p_name", 0.85)


@query("term_lookup", """
WITH terms(pos, term, code) AS (VALUES (1, 'ECONOMY', 'T1'), (2, 'STANDARD', 'T2'), (3, 'PROMO', 'T3'), (4, 'SMALL PLATED BRASS', 'T4'), (5, 'BRASS', 'T5'), (6, 'STEEL', 'T6')),
m AS (SELECT p_partkey, code, CASE WHEN p_type = term THEN 0 ELSE 1 END AS partial, pos FROM part JOIN terms ON contains(p_type, term) OR contains(term, p_type))
SELECT p_partkey, first(code ORDER BY partial, pos) AS code FROM m GROUP BY p_partkey
""")
def term_lookup(spark, sf_dir):
    terms = spark.createDataFrame([(1, "ECONOMY", "T1"), (2, "STANDARD", "T2"), (3, "PROMO", "T3"), (4, "SMALL PLATED BRASS", "T4"), (5, "BRASS", "T5"), (6, "STEEL", "T6")], "pos int, term string, code string")
    # types are few, so they are looked up once each, and parts join their type's code
    types = table(spark, sf_dir, "part").select("p_type").distinct()
    hits = types.join(F.broadcast(terms), F.contains("p_type", F.col("term")) | F.contains("term", F.col("p_type")))
    best = match.first_per_key(hits.select("p_type", "code", (F.col("p_type") != F.col("term")).cast("int").alias("partial"), "pos"), ["p_type"], [F.col("partial"), F.col("pos")])
    return table(spark, sf_dir, "part").select("p_partkey", "p_type").join(best, "p_type").select("p_partkey", "code")


@query("jaccard_dedup_pairs", """
WITH w AS (SELECT doc_id, list_sort(list_distinct(string_split(regexp_replace(lower(trim(text)), '\\s+', ' ', 'g'), ' '))) AS w FROM documents WHERE text IS NOT NULL),
r AS (SELECT min(doc_id) AS rep, len(w) AS n, w FROM w GROUP BY w), e AS (SELECT rep, n, unnest(w) AS word FROM r),
c AS (SELECT a.rep AS a, b.rep AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM e a JOIN e b ON a.word = b.word AND a.rep < b.rep WHERE least(a.n, b.n) > 0.8 * greatest(a.n, b.n) GROUP BY a.rep, b.rep)
SELECT a, b, round(c / (na + nb - c), 6) AS similarity FROM c WHERE c > 0.8 * (na + nb - c)
UNION ALL SELECT rep, doc_id, 1.0 FROM w JOIN r ON w.w = r.w WHERE doc_id <> rep
""")
def jaccard_dedup_pairs(spark, sf_dir):
    """Documents of any source with a word Jaccard above 0.8; of documents with equal words only the first is compared."""
    w = table(spark, sf_dir, "documents").select("doc_id", F.array_distinct(F.split(F.regexp_replace(F.lower(F.trim("text")), r"\s+", " "), " ")).alias("w"))
    return match.near_sets(w, "doc_id", "w", 80).select("a", "b", F.round("similarity", 6).alias("similarity"))


@query("reconcile_priority", """
WITH c AS (
  SELECT o_orderkey AS key, 'orders' AS source, 10 AS priority, o_orderkey * 10 AS pos, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS label, o_orderstatus = 'F' AS closed FROM orders
  UNION ALL SELECT l_orderkey, 'lines', 20, l_orderkey * 10 + l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN l_returnflag || l_linestatus END, l_linestatus = 'F' FROM lineitem)
SELECT key, first(label ORDER BY priority DESC, source, pos, label) FILTER (label IS NOT NULL) AS label, bool_or(closed) AS any_closed, bool_and(closed) AS all_closed, list_sort(list(DISTINCT source)) AS sources FROM c GROUP BY key
""")
def reconcile_priority(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), (F.col("o_orderkey") * 10).alias("at"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("label"), (F.col("o_orderstatus") == "F").alias("closed"))
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at"), F.when(F.col("l_linenumber") % 3 == 0, F.concat("l_returnflag", "l_linestatus")).alias("label"), (F.col("l_linestatus") == "F").alias("closed"))
    both = reconcile.contribute(o, "orders", 10, "at").unionByName(reconcile.contribute(l, "lines", 20, "at")).withColumns({"any_closed": F.col("closed"), "all_closed": F.col("closed"), "sources": F.col("source")})
    return reconcile.reconcile(both, ["key"], {"label": "first", "any_closed": "any", "all_closed": "all", "sources": "set"})


@query("main_flag_fallback", """
WITH e AS (SELECT user_id, event_id, ts, event_type = 'purchase' AS is_main FROM events),
f AS (SELECT *, bool_or(is_main) OVER (PARTITION BY user_id) AS has, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS a, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS z FROM e),
g AS (SELECT user_id, event_id, ts, CASE WHEN has THEN is_main ELSE a = 1 OR z = 1 END AS is_main FROM f)
SELECT user_id, event_id, is_main, CASE WHEN is_main THEN CAST(sum(CASE WHEN is_main THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) END AS main_order FROM g
""")
def main_flag_fallback(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", (F.col("event_type") == "purchase").alias("is_main"))
    return reconcile.main_fallback(e, "user_id", ["ts", "event_id"], "is_main").select("user_id", "event_id", "is_main", "main_order")


@query("dedup_keep_first", "SELECT source, lang, min(doc_id) AS doc_id, arg_min(n_chars, doc_id) AS n_chars FROM documents GROUP BY source, lang")
def dedup_keep_first(spark, sf_dir):
    return match.first_per_key(table(spark, sf_dir, "documents").select("source", "lang", "doc_id", "n_chars"), ["source", "lang"], [F.col("doc_id")])


@query("dedup_canonical_best", """
SELECT o_custkey, p, arg_min(o_orderkey, struct_pack(k := CASE WHEN p = '1' THEN -v ELSE v END, o := o_orderkey)) AS o_orderkey
FROM (SELECT o_custkey, substr(o_orderpriority, 1, 1) AS p, o_orderkey, dayofyear(o_orderdate) AS v FROM orders) GROUP BY o_custkey, p
""")
def dedup_canonical_best(spark, sf_dir):
    """Of a customer's orders of one priority: for the most urgent the latest day of the year, else the earliest."""
    o = table(spark, sf_dir, "orders").select("o_custkey", F.substring("o_orderpriority", 1, 1).alias("p"), "o_orderkey", F.dayofyear("o_orderdate").alias("v"))
    return match.first_per_key(o, ["o_custkey", "p"], [F.when(F.col("p") == "1", -F.col("v")).otherwise(F.col("v")), F.col("o_orderkey")]).select("o_custkey", "p", "o_orderkey")


_TAGS = "(SELECT user_id, event_type, 'text' AS source FROM events WHERE event_id % 3 <> 0 UNION ALL SELECT user_id, event_type, 'vision' FROM events WHERE event_id % 3 = 0)"


def tags(spark, sf_dir):
    return table(spark, sf_dir, "events").select("user_id", "event_type", F.when(F.col("event_id") % 3 == 0, F.lit("vision")).otherwise(F.lit("text")).alias("source"))


@query("provenance_merge", f"SELECT user_id, event_type, CASE WHEN count(DISTINCT source) > 1 THEN 'both' ELSE min(source) END AS source FROM {_TAGS} GROUP BY ALL")
def provenance_merge(spark, sf_dir):
    return reconcile.merge_provenance(tags(spark, sf_dir), ["user_id", "event_type"])


@query("provenance_stats", f"""
SELECT event_type, source, count(*) AS n FROM (SELECT user_id, event_type, CASE WHEN count(DISTINCT source) > 1 THEN 'both' ELSE min(source) END AS source FROM {_TAGS} GROUP BY ALL) GROUP BY ROLLUP (event_type, source)
""")
def provenance_stats(spark, sf_dir):
    return reconcile.provenance_stats(reconcile.merge_provenance(tags(spark, sf_dir), ["user_id", "event_type"]), "event_type")


@query("cell_compare", f"""
WITH t AS (SELECT DISTINCT user_id, event_type FROM {_TAGS} WHERE source = 'text'), v AS (SELECT DISTINCT user_id, event_type FROM {_TAGS} WHERE source = 'vision')
SELECT coalesce(t.user_id, v.user_id) AS user_id, coalesce(t.event_type, v.event_type) AS event_type,
  CASE WHEN v.user_id IS NULL THEN 'possible_hallucination' WHEN t.user_id IS NULL THEN 'missed' ELSE 'confirmed' END AS verdict
FROM t FULL JOIN v ON t.user_id = v.user_id AND t.event_type = v.event_type
""")
def cell_compare(spark, sf_dir):
    both = tags(spark, sf_dir).groupBy("user_id", "event_type").agg(F.bool_or(F.col("source") == "text").alias("t"), F.bool_or(F.col("source") == "vision").alias("v"))
    return both.select("user_id", "event_type", F.when(~F.col("v"), "possible_hallucination").when(~F.col("t"), "missed").otherwise("confirmed").alias("verdict"))


@query("fallback_coalesce", """
SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END, o.p) AS label FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderpriority) AS p FROM orders GROUP BY 1) o ON o_custkey = c_custkey
""")
def fallback_coalesce(spark, sf_dir):
    now = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).alias("label"))
    old = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderpriority").alias("label"))
    return reconcile.fall_back(now, old, ["c_custkey"], ["label"])


@query("semantic_resolve", """
WITH e AS (SELECT vec_id, embedding, label FROM embeddings), q AS (SELECT * FROM e WHERE vec_id % 100 = 0),
s AS (SELECT q.vec_id, e.vec_id AS best, list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) AS c FROM q JOIN e ON q.vec_id <> e.vec_id)
SELECT vec_id, first(best ORDER BY c DESC, best) AS best, round(max(c), 6) AS cosine FROM s GROUP BY vec_id
""")
def semantic_resolve(spark, sf_dir):
    """For a stated query set (ids divisible by 100) the most similar other vector of all."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    best = match.nearest_vectors(e.filter("vec_id % 100 = 0"), e, "vec_id", "embedding")
    return best.select(F.col("id").alias("vec_id"), "best", F.round("cosine", 6).alias("cosine"))

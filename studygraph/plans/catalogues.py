"""Catalogues written from the tables, read back as YAML, and the entities held against them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studygraph.registry import cut, drop, query, scratch, table
from studygraph.sources import catalogue


def segment_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The attributes of a catalogue with an entity for each market segment and an attribute for each order priority of its
    customers, required where their orders are odd in number, and a list where a multiple of three; written as YAML, read
    back and kept as a table."""
    counts = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment", "o_orderpriority").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("most"))
    cardinality = F.concat(F.when(F.col("n") % 2 == 1, "1").otherwise("0"), F.when(F.col("n") % 3 == 0, "..*").otherwise(F.when(F.col("n") % 2 == 1, "").otherwise("..1")))
    lines = F.concat_ws(
        "\n", F.concat(F.lit("    '"), "o_orderpriority", F.lit("':  # an attribute")), F.concat(F.lit('      Cardinality: "'), cardinality, F.lit('"')), F.lit("      Type:"), F.concat(F.lit("      - $ref: '#/"), F.when(F.col("n") % 5 == 0, "Code").otherwise("string"), F.lit("'")),
        F.concat(F.lit("      Definition: Orders: at most"), F.lit("\n        "), F.col("most").cast("decimal(20,2)").cast("string"), F.lit(" each\n        # no comment in a text")),
    )
    entity = F.concat(F.col("c_mktsegment"), F.lit(":\n  NCI C-Code: C1\n  Super Classes:\n    - $ref: '#/Customer'\n  Attributes:\n"), F.array_join(F.array_sort(F.collect_list(lines)), "\n"), F.lit("\n"))  # priorities are five
    path = scratch(spark, "catalogue")
    counts.groupBy("c_mktsegment").agg(entity.alias("value")).select("value").write.text(path)
    kept = cut(catalogue.read_catalogues(spark, path))
    drop(spark, path)
    return kept


_COUNTS = "(SELECT c_mktsegment, o_orderpriority, count(*) AS n, max(o_totalprice) AS most FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"
_CARDINALITY = "(CASE n % 2 WHEN 1 THEN '1' ELSE '0' END || CASE WHEN n % 3 = 0 THEN '..*' WHEN n % 2 = 1 THEN '' ELSE '..1' END)"


@query("catalogue_attributes", f"""
SELECT c_mktsegment AS entity, 'Concrete' AS modifier, 'C1' AS entity_code, 'Customer' AS super_classes, o_orderpriority AS attribute, CASE WHEN n % 5 = 0 THEN '#/Code' ELSE '#/string' END AS type_ref, {_CARDINALITY} AS cardinality,
  n % 2 = 1 AS required, n % 3 = 0 AS is_list, 'Value' AS relationship, 'Orders: at most ' || most::DECIMAL(20,2) || ' each' AS definition FROM {_COUNTS}
""")
def catalogue_attributes(spark, sf_dir):
    found = segment_catalogue(spark, sf_dir).select("entity", "modifier", "entity_code", "super_classes", "attribute", "type_ref", "cardinality", "required", "is_list", "relationship", "definition")
    return found.withColumn("super_classes", F.array_join("super_classes", ","))


@query("catalogue_required", f"""
WITH e AS (SELECT c_mktsegment, o_custkey, o_orderpriority, count(*) AS k FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
c AS (SELECT DISTINCT c_mktsegment, o_custkey FROM e),
r AS (SELECT c.c_mktsegment AS entity, c.o_custkey AS id, s.o_orderpriority AS attribute, CASE WHEN e.k IS NULL AND s.n % 2 = 1 THEN 'required' WHEN e.k = 1 AND s.n % 3 = 0 THEN 'list expected' WHEN e.k > 1 AND s.n % 3 <> 0 THEN 'single value expected' END AS issue
  FROM c JOIN {_COUNTS} s USING (c_mktsegment) LEFT JOIN e ON e.o_custkey = c.o_custkey AND e.o_orderpriority = s.o_orderpriority)
SELECT * FROM r WHERE issue IS NOT NULL
""")
def catalogue_required(spark, sf_dir):
    """Customers with orders as entities, their fields by priority: a value where they have one order, else a list."""
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    fields = orders.groupBy("c_mktsegment", "o_custkey", "o_orderpriority").agg(F.count("*").alias("k")).withColumn("field", F.when(F.col("k") > 1, F.concat(F.lit("["), "k", F.lit("]"))).otherwise(F.lit('"one"')))
    entities = fields.groupBy(F.col("c_mktsegment").alias("entity"), F.col("o_custkey").alias("id")).agg(F.map_from_entries(F.collect_list(F.struct("o_orderpriority", "field"))).alias("fields"))
    return catalogue.catalogue_issues(entities, segment_catalogue(spark, sf_dir))

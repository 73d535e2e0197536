"""Connected components of a graph too large for one machine, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studygraph.llm.shared import Written


def stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a, b): links each node's neighbours to the least of them and the node. Large-star links
    the larger neighbours of every node, small-star the smaller ones. The least neighbour comes from a partial
    aggregation, so a node with very many neighbours is no single task's burden; the join may split it."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    around = both if large else both.filter("b < a")
    least = around.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
    joined = around.join(least, around["a"] == least["node"])
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("node").alias("a"), F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def connected_components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, component) of every node in edges (a, b), where component is the least node that can be reached. Nodes can
    be of any type that has an order; null ends are left out, loops and repeated edges make no difference.

    Every round is written to the shared folder; rounds end when the edges no longer change, after about the logarithm
    of the longest path. Raises if they still change after most_rounds."""
    tables = Written(edges.sparkSession)
    flat = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL")
    nodes = flat.select(F.col("a").alias("node")).union(flat.select(F.col("b").alias("node"))).distinct()
    now = tables.put("edges0", flat.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for step in range(1, most_rounds + 1):
        now = tables.put(f"edges{step}", stars(stars(now, large=True), large=False))
        tables.drop(f"edges{step - 1}")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components still change after {most_rounds} rounds")
    return nodes.join(now.groupBy("a").agg(F.min("b").alias("b")), F.col("node") == F.col("a"), "left").select("node", F.coalesce("b", "node").alias("component"))

"""State graphs over the tables: a machine for each supplier, whose states are the quantities of its lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from studygraph.operators import reach
from studygraph.registry import query, table


def supplier_machines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(edges, initial, terminal): returned lines that follow one another lead from quantity to quantity; the first line
    begins, returned lines without discount at the highest tax end."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("machine"), F.col("l_quantity").cast("int").alias("state"), "l_returnflag", "l_discount", "l_tax", F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity").alias("at"))
    w = Window.partitionBy("machine").orderBy("at")  # the lines of one supplier
    steps = lines.withColumn("before", F.lag("state").over(w)).withColumn("flag", F.lag("l_returnflag").over(w)).filter("flag = 'R' AND l_returnflag = 'R'")
    initial = lines.groupBy("machine").agg(F.min_by("state", "at").alias("state"))
    terminal = lines.filter("l_returnflag = 'R' AND l_discount = 0 AND l_tax = 0.08").select("machine", "state").distinct()
    return steps.select("machine", F.col("before").alias("from_state"), F.col("state").alias("to_state")), initial, terminal


_MACHINES = """RECURSIVE l AS (SELECT l_suppkey AS machine, l_quantity::INTEGER AS state, l_returnflag, l_discount, l_tax, row_number() OVER w AS nth, lag(l_quantity::INTEGER) OVER w AS before, lag(l_returnflag) OVER w AS flag FROM lineitem
  WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity)),
e AS (SELECT DISTINCT machine, before AS f, state AS t FROM l WHERE flag = 'R' AND l_returnflag = 'R'), i AS (SELECT machine, state FROM l WHERE nth = 1), z AS (SELECT DISTINCT machine, state FROM l WHERE l_returnflag = 'R' AND l_discount = 0 AND l_tax = 0.08),
fwd(machine, state) AS (SELECT machine, state FROM i UNION SELECT e.machine, e.t FROM fwd JOIN e ON e.machine = fwd.machine AND e.f = fwd.state),
back(machine, state) AS (SELECT machine, state FROM z UNION SELECT e.machine, e.f FROM back JOIN e ON e.machine = back.machine AND e.t = back.state),
s AS (SELECT machine, f AS state FROM e UNION SELECT machine, t FROM e UNION SELECT machine, state FROM i UNION SELECT machine, state FROM z)"""


@query("state_paths", f"""
WITH {_MACHINES}
SELECT machine, state, fwd.state IS NOT NULL AS reached, back.state IS NOT NULL AS ends,
  CASE WHEN machine NOT IN (SELECT machine FROM z) THEN 'no terminal states' WHEN fwd.state IS NULL THEN 'unreachable' WHEN back.state IS NULL THEN 'dead end' END AS issue
FROM s LEFT JOIN fwd USING (machine, state) LEFT JOIN back USING (machine, state)
""")
def state_paths(spark, sf_dir):
    """Unreachable states and dead ends of every supplier's machine, at any distance."""
    found = reach.state_paths(*supplier_machines(spark, sf_dir))
    return found.select("machine", "state", F.col("hops").isNotNull().alias("reached"), F.col("hops_to_end").isNotNull().alias("ends"), "issue")


@query("state_distances", f"""
WITH {_MACHINES.replace('fwd(machine, state) AS (SELECT machine, state FROM i UNION SELECT e.machine, e.t FROM fwd JOIN e ON e.machine = fwd.machine AND e.f = fwd.state)', 'fwd(machine, state, hops) AS (SELECT machine, state, 0 FROM i UNION SELECT e.machine, e.t, hops + 1 FROM fwd JOIN e ON e.machine = fwd.machine AND e.f = fwd.state WHERE hops < 60)')}
SELECT machine, state, min(hops)::INTEGER AS hops FROM fwd GROUP BY ALL
""")
def state_distances(spark, sf_dir):
    """The fewest steps from each machine's first state to every state that it reaches; the SQL walks 60 steps, as many as a
    machine of 50 states can need."""
    edges, initial, _ = supplier_machines(spark, sf_dir)
    return reach.reached(edges, initial)

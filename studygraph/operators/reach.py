"""Reachability at any distance in state graphs, many graphs at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studygraph.registry import cut

#: Frontiers are joined with those before as they are; after so many the union is cut to one table.
_APART = 8


def reached(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """(machine, state, hops) of every state that can be reached from the starts (machine, state) of its machine along
    edges (machine, from_state, to_state), with the fewest hops; starts have 0. Cycles end, as a state is taken once.
    Repeated edges and starts make no difference, edges with a null end lead nowhere, starts need be no end of an edge.

    A round joins the newest states with the edges, and is cut from what came before; there are as many rounds as the
    longest of the shortest ways, for all machines together. Nothing but a test for emptiness reaches the driver."""
    edges = cut(edges.select("machine", F.col("from_state").alias("state"), "to_state").dropna().distinct())
    newest = cut(starts.select("machine", "state").dropna().distinct().withColumn("hops", F.lit(0)))
    seen, apart = newest, 0
    while not newest.isEmpty():
        ahead = newest.join(edges, ["machine", "state"]).select("machine", F.col("to_state").alias("state"), (F.col("hops") + 1).alias("hops")).distinct()
        newest = cut(ahead.join(seen.select("machine", "state"), ["machine", "state"], "left_anti"))
        seen, apart = seen.union(newest), apart + 1
        if apart == _APART:
            seen, apart = cut(seen), 0
    return seen


def state_paths(edges: DataFrame, initial: DataFrame, terminal: DataFrame) -> DataFrame:
    """(machine, state, hops, hops_to_end, issue) of every state that edges, initial or terminal name: its distance from an
    initial state and to a terminal one, null where there is no way. issue: "no terminal states" for each state of a
    machine without any, else "unreachable" where no initial state leads to it, "dead end" where it is reached but leads to
    no terminal state, at whatever distance."""
    ends = edges.select("machine", F.explode(F.array("from_state", "to_state")).alias("state"))
    states = ends.union(initial.select("machine", "state")).union(terminal.select("machine", "state")).dropna().distinct()
    backward = edges.select("machine", F.col("to_state").alias("from_state"), F.col("from_state").alias("to_state"))
    there, back = reached(edges, initial), reached(backward, terminal).withColumnRenamed("hops", "hops_to_end")
    with_end = terminal.select("machine").dropna().distinct().withColumn("_ends", F.lit(True))
    found = states.join(there, ["machine", "state"], "left").join(back, ["machine", "state"], "left").join(with_end, "machine", "left")
    issue = F.when(F.col("_ends").isNull(), "no terminal states").when(F.col("hops").isNull(), "unreachable").when(F.col("hops_to_end").isNull(), "dead end")
    return found.select("machine", "state", "hops", "hops_to_end", issue.alias("issue"))

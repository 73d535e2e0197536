"""Schedules: matrices, chains, edges, layout, recurrences, conflicts and state machines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def matrix(rows: DataFrame, columns: DataFrame, ticks: DataFrame, row: str, column: str) -> DataFrame:
    """Every cell of rows x columns, with the ticks' other columns and ticked. columns is the short side, a visit each."""
    cells = rows.select(row).distinct().crossJoin(columns.select(column).distinct())
    marks = ticks.withColumn("_tick", F.lit(True))
    return cells.join(marks, [row, column], "left").withColumn("ticked", F.coalesce("_tick", F.lit(False))).drop("_tick")


def wide(ticks: DataFrame, row: str, column: str, names: Sequence[str], value: Column) -> DataFrame:
    """One row per row key and one column per name."""
    return ticks.groupBy(row).pivot(column, list(names)).agg(value)


def chained(df: DataFrame, group: str, order: Sequence[str], id_: str) -> DataFrame:
    """Adds previous_id and next_id along a group's order."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumns({"previous_id": F.lag(id_).over(w), "next_id": F.lead(id_).over(w)})


def edges(df: DataFrame, group: str, order: Sequence[str], id_: str) -> DataFrame:
    """(group, from_id, to_id) of neighbours along a group's order."""
    return chained(df, group, order, id_).filter("next_id IS NOT NULL").select(group, F.col(id_).alias("from_id"), F.col("next_id").alias("to_id"))


def numbered_names(df: DataFrame, group: str, order: str, name: str, out: str) -> DataFrame:
    """Names made unique within a group: those that occur more than once get their number, as in 'Visit (2)'."""
    key = Window.partitionBy(group, name)
    n, many = F.row_number().over(key.orderBy(order)), F.count("*").over(key)
    return df.withColumn(out, F.when(many > 1, F.concat(F.col(name), F.lit(" ("), n.cast("string"), F.lit(")"))).otherwise(F.col(name)))


def running_x(df: DataFrame, order: str, children: str, each: int = 160, least: int = 300, gap: int = 50) -> DataFrame:
    """The x of boxes side by side, each as wide as its children need: the widths before it, summed."""
    width = F.greatest(F.lit(least), F.col(children) * each) + gap
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)  # a row per epoch of a study
    return df.withColumn("width", width).withColumn("x", F.coalesce(F.sum("width").over(before), F.lit(0)))


def expand_recurrence(df: DataFrame, start: Column, end: Column, step: Column, out: str) -> DataFrame:
    """One row for each day from start to end by step; none where start is after end."""
    return df.filter(start <= end).withColumn(out, F.explode(F.sequence(start, end, step)))


def conflicts(df: DataFrame, keys: Sequence[str], id_: str) -> DataFrame:
    """Keys that more than one row has: n, how many, and first_id, the smallest id. Null keys count as equal; a ValueError
    if a key has one of these names."""
    if clash := {"n", "first_id"} & set(keys):
        raise ValueError(f"keys with names made here: {sorted(clash)}")
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.min(id_).alias("first_id")).filter("n > 1")


def machine_faults(transitions: DataFrame, machine: str, initial: str) -> DataFrame:
    """(machine, state, fault): states that nothing leads to ('unreachable', the initial one excepted), and states that
    nothing leaves ('dead_end')."""
    to, source = transitions.select(machine, F.col("to_state").alias("state")).distinct(), transitions.select(machine, F.col("from_state").alias("state")).distinct()
    unreachable = source.join(to, [machine, "state"], "left_anti").filter(F.col("state") != initial).withColumn("fault", F.lit("unreachable"))
    dead = to.join(source, [machine, "state"], "left_anti").withColumn("fault", F.lit("dead_end"))
    return unreachable.union(dead)

"""Reconciling contributions from several sources, and where each value came from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, StructType


def contribute(df: DataFrame, source: str, priority: int, order: str) -> DataFrame:
    """Rows tagged with their source, its priority and their position."""
    return df.withColumns({"source": F.lit(source), "priority": F.lit(priority), "pos": F.col(order).cast("long")})


def merged(column: str, policy: str) -> Column:
    """The aggregate that merges a column of a cluster. first: the non-null value of the highest priority, ties by
    position, then value; seen: the first by position, then priority number; any, all: booleans; union: sorted distinct values of an array; set: of a scalar; map: the entries of all maps, of a key
    that several have that of the lowest priority, then of the last source and position (null maps are left out)."""
    if policy == "first":
        best = F.struct((-F.col("priority")).alias("p"), F.col("source").alias("s"), F.col("pos").alias("o"), F.col(column).alias("v"))
        return F.min_by(column, F.when(F.col(column).isNotNull(), best))
    if policy == "seen":
        return F.min_by(column, F.struct("pos", "priority", "source"))
    if policy in ("any", "all"):
        return F.bool_or(column) if policy == "any" else F.bool_and(column)
    if policy == "union":
        return F.array_sort(F.array_distinct(F.flatten(F.collect_set(column))))
    if policy == "map":
        last = F.struct((-F.col("priority")).alias("p"), F.col("source").alias("s"), F.col("pos").alias("o"), F.map_entries(column).alias("m"))
        held = F.transform(F.array_sort(F.collect_list(F.when(F.col(column).isNotNull(), last))), lambda x: F.map_from_entries(x["m"]))
        none = F.get(held, F.lit(0))
        return F.coalesce(F.aggregate(held, F.map_filter(none, lambda k, v: F.lit(False)), lambda a, x: F.map_concat(F.map_filter(a, lambda k, v: ~F.map_contains_key(x, k)), x)), none)
    if policy == "set":
        return F.array_sort(F.collect_set(column))
    raise ValueError(f"no policy {policy}")


def reconcile(contributions: DataFrame, keys: Sequence[str], policies: Mapping[str, str]) -> DataFrame:
    """One row per cluster (equal keys), each column merged by its policy."""
    return contributions.groupBy(*keys).agg(*[merged(c, p).alias(c) for c, p in policies.items()])


def main_fallback(df: DataFrame, group: str, order: Sequence[str], flag: str) -> DataFrame:
    """Where no row of a group has the flag, its first and last get it; adds main_order, 1 for the first flagged and so
    on (null for the others)."""
    up, down = (Window.partitionBy(group).orderBy(*[F.col(c).asc() if d else F.col(c).desc() for c in order]) for d in (True, False))
    whole = Window.partitionBy(group)
    out = df.withColumn("_some", F.max(F.col(flag).cast("int")).over(whole)).withColumn("_first", F.row_number().over(up)).withColumn("_last", F.row_number().over(down))
    out = out.withColumn(flag, F.when(F.col("_some") == 1, F.col(flag)).otherwise((F.col("_first") == 1) | (F.col("_last") == 1)))
    nth = F.sum(F.col(flag).cast("int")).over(up.rowsBetween(Window.unboundedPreceding, 0))
    return out.withColumn("main_order", F.when(F.col(flag), nth)).drop("_some", "_first", "_last")


def merge_provenance(tags: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One tag per key: its source, or 'both' where sources differ (a merged 'both' stays). In any order and any number of
    times the same."""
    return tags.groupBy(*keys).agg(F.when(F.min("source") == F.max("source"), F.min("source")).otherwise(F.lit("both")).alias("source"))


def provenance_stats(tags: DataFrame, kind: str) -> DataFrame:
    """Counts by kind and source, by kind, and in all (nulls stand for all)."""
    return tags.rollup(kind, "source").agg(F.count("*").alias("n"))


def needs_review(source: Column, linked: Column, enriched: Column) -> Column:
    """A cell is to be reviewed if it was seen in the picture only or marked so, or is linked without any source and is
    no enrichment."""
    return F.coalesce(source.isin("needs_review", "vision"), F.lit(False)) | (linked & source.isNull() & ~enriched)


def fall_back(current: DataFrame, previous: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The current rows, with values that are missing there taken from the previous run."""
    old = previous.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in columns])
    return current.join(old, list(keys), "left").select(*keys, *[F.coalesce(c, f"_old_{c}").alias(c) for c in columns])


def deep_merged(base: Column, override: Column, kind: DataType) -> Column:
    """Two values of one type merged: structs field by field, maps entry by entry (values of the override first), and
    everything else replaced where the override has a value. Arrays are replaced whole."""
    if isinstance(kind, StructType):
        fields = [deep_merged(base[f.name], override[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(base.isNull(), override).when(override.isNull(), base).otherwise(F.struct(*fields))
    if isinstance(kind, MapType):
        return F.when(base.isNull(), override).when(override.isNull(), base).otherwise(F.map_concat(F.map_filter(base, lambda k, v: ~F.map_contains_key(override, k)), override))
    return F.coalesce(override, base)


def contribute_traversal(epochs: DataFrame, group: str, id_: str, order: str, sequence: str) -> DataFrame:
    """The epochs that a group's sequence (array<string>, the same on each of its rows) names, by id or as epoch_1, epoch_2 ...
    in order, with category 'main' and sequence_order, their place in it. An epoch named twice comes twice; names
    of no epoch, and null sequences, give none. The other columns are kept."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(order))
    numbered = epochs.withColumn("_index", F.concat(F.lit("epoch_"), rank))
    hit = F.filter(F.transform(F.col(sequence), lambda x, i: F.when((x == F.col("_index")) | (x == F.col(id_).cast("string")), i + 1)), lambda x: x.isNotNull())
    return numbered.select(*epochs.columns, F.explode(hit).alias("sequence_order")).withColumn("category", F.lit("main"))

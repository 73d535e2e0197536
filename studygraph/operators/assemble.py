"""Documents to entity tables and back: exploding, ids, links, defaults and nesting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studygraph.functions.text import needs_id, stable_id

#: The minimal schedule document.
TIMELINE = """struct<
  activities: array<struct<id: string, activityId: string, name: string, activityGroupId: string, instanceType: string>>,
  plannedTimepoints: array<struct<id: string, plannedTimepointId: string, encounterId: string, name: string>>,
  encounters: array<struct<id: string, name: string, epochId: string>>,
  epochs: array<struct<id: string, name: string>>,
  activityTimepoints: array<struct<activityId: string, plannedTimepointId: string>>,
  activityGroups: array<struct<activityGroupId: string, plannedTimepointIds: array<string>>>>"""


def timelines(documents: DataFrame) -> DataFrame:
    """(protocol_id, t): the timeline of each document (protocol_id, raw), with or without the study wrapper."""
    shape = f"study struct<versions: array<struct<timeline: {TIMELINE}>>>, versions array<struct<timeline: {TIMELINE}>>, timeline {TIMELINE}"
    d = F.from_json("raw", shape)
    return documents.select("protocol_id", d.alias("d")).select("protocol_id", F.coalesce(F.try_element_at("d.study.versions", F.lit(1))["timeline"], F.try_element_at("d.versions", F.lit(1))["timeline"], F.col("d.timeline")).alias("t"))


def entity(found: DataFrame, array: str, ids: Sequence[str]) -> DataFrame:
    """The members of one array as rows with pos (from 0) and id, the first of `ids` that is there."""
    rows = found.select("protocol_id", F.posexplode(f"t.{array}").alias("pos", "e"))
    given = F.coalesce(*[F.nullif(F.col(f"e.{i}"), F.lit("")) for i in ids])
    return rows.select("protocol_id", "pos", given.alias("_id"), "e.*").drop(*ids).withColumnRenamed("_id", "id")


def valid_ticks(found: DataFrame) -> DataFrame:
    """(protocol_id, activity_id, timepoint_id) of ticks whose both ends exist."""
    a = entity(found, "activities", ["id", "activityId"]).select("protocol_id", F.col("id").alias("activity_id")).distinct()
    p = entity(found, "plannedTimepoints", ["id", "plannedTimepointId"]).select("protocol_id", F.col("id").alias("timepoint_id")).distinct()
    ticks = found.select("protocol_id", F.explode("t.activityTimepoints").alias("e")).select("protocol_id", F.col("e.activityId").alias("activity_id"), F.col("e.plannedTimepointId").alias("timepoint_id")).distinct()
    return ticks.join(a, ["protocol_id", "activity_id"], "left_semi").join(p, ["protocol_id", "timepoint_id"], "left_semi").select("protocol_id", "activity_id", "timepoint_id")


def renamed_ids(df: DataFrame, columns: Sequence[str], scope: str = "protocol_id") -> DataFrame:
    """Simple ids in columns replaced by stable UUIDs, the same id of a document by the same one."""
    return df.withColumns({c: F.when(needs_id(F.col(c)), stable_id(F.col(scope), F.col(c))).otherwise(F.col(c)) for c in columns})


def rewritten_cells(cells: DataFrame, names: DataFrame) -> DataFrame:
    """Provenance cells (protocol_id, key 'activity|encounter', source) by current ids; names is (protocol_id, old_id, id).
    Ends without a current id keep their own; pt_N is read as enc_N."""
    parts = F.split("key", r"\|")
    split = cells.select("protocol_id", "source", parts[0].alias("a"), F.regexp_replace(parts[1], "^pt_", "enc_").alias("e"))
    a, e = (names.select("protocol_id", F.col("old_id").alias(c), F.col("id").alias(f"new_{c}")) for c in ("a", "e"))
    out = split.join(a, ["protocol_id", "a"], "left").join(e, ["protocol_id", "e"], "left")
    return out.select("protocol_id", F.concat_ws("|", F.coalesce("new_a", "a"), F.coalesce("new_e", "e")).alias("key"), "source")


def default_cells(arms: DataFrame, epochs: DataFrame) -> DataFrame:
    """A cell for each arm and epoch of a document."""
    a, e = arms.select("protocol_id", F.col("id").alias("arm_id")), epochs.select("protocol_id", F.col("id").alias("epoch_id"))
    return a.join(e, "protocol_id").select("protocol_id", F.concat_ws("_", F.lit("cell"), "arm_id", "epoch_id").alias("id"), "arm_id", "epoch_id")


def first_epoch_fallback(encounters: DataFrame, epochs: DataFrame) -> DataFrame:
    """Encounters whose epoch exists; others get their document's first epoch."""
    first = epochs.groupBy("protocol_id").agg(F.min_by("id", "pos").alias("_first"))
    known = epochs.select("protocol_id", F.col("id").alias("epochId"), F.lit(True).alias("_ok")).distinct()
    joined = encounters.join(known, ["protocol_id", "epochId"], "left").join(first, "protocol_id", "left")
    return joined.withColumn("epochId", F.when(F.col("_ok"), F.col("epochId")).otherwise(F.col("_first"))).drop("_ok", "_first")


def nested(parents: DataFrame, children: DataFrame, key: Sequence[str], order: str, name: str) -> DataFrame:
    """parents with an array of their children's structs, in order; empty where there are none."""
    rest = [c for c in children.columns if c not in key]
    inner = [c for c in rest if c != order]
    arrays = children.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), *inner))).alias("_c"))
    joined = parents.join(arrays, list(key), "left")
    kind = "array<struct<" + ",".join(f"{c}:{children.schema[c].dataType.simpleString()}" for c in inner) + ">>"
    return joined.withColumn(name, F.coalesce(F.transform("_c", lambda c: F.struct(*[c[i].alias(i) for i in inner])), F.array().cast(kind))).drop("_c")


def documents_of(studies: DataFrame) -> DataFrame:
    """(protocol_id, raw): each row as a JSON document under study."""
    return studies.select("protocol_id", F.to_json(F.struct(F.struct(*[c for c in studies.columns if c != "protocol_id"]).alias("study"))).alias("raw"))


def safe_get(column: Column, *path: str, default: Column | None = None) -> Column:
    """A nested field; the default where it, or what holds it, is null."""
    for p in path:
        column = column[p]
    return column if default is None else F.coalesce(column, default)

"""The graph of a study's schedule: nodes with places and edges, built from its tables, and what is wrong with a graph."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The layout, in pixels.
EPOCH_WIDTH, EPOCH_GAP, EPOCH_Y = 300, 50, 50
ENCOUNTER_STEP, ENCOUNTER_Y, WINDOW_RISE = 160, 150, 30
ACTIVITY_DROP, ACTIVITY_STEP = 100, 55
START_X, TIMING_STEP, TIMING_Y = 80, 140, 320

NODE = ["study", "id", "label", "type", "ref", "x", "y", "is_anchor"]
EDGE = ["study", "id", "source", "target", "type"]


def _node(df: DataFrame, id_: Column, label: Column, kind: Column | str, x: Column, y: Column, anchor: Column | None = None) -> DataFrame:
    kind = kind if isinstance(kind, Column) else F.lit(kind)
    anchor = F.lit(False) if anchor is None else anchor
    return df.select("study", id_.alias("id"), label.alias("label"), kind.alias("type"), F.col("id").alias("ref"), x.cast("long").alias("x"), y.cast("long").alias("y"), F.coalesce(anchor, F.lit(False)).alias("is_anchor"))


def _edge(df: DataFrame, id_: Column, source: Column, target: Column, kind: str) -> DataFrame:
    return df.select("study", id_.alias("id"), source.alias("source"), target.alias("target"), F.lit(kind).alias("type"))


def _text(*parts: str | Column) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def graph(epochs: DataFrame, encounters: DataFrame, activities: DataFrame, instances: DataFrame, timings: DataFrame, anchors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of all studies, of epochs (study, pos, id, name), encounters (study, pos, id, name, epoch_id, window),
    activities (study, id, name, label), instances (study, pos, id, kind, encounter_id, activity_ids), timings (study, pos, id,
    name, value, window, relative_to, is_anchor) and anchors (study, kind).

    Epochs stand side by side, each as wide as its encounters need; encounters stand in their epoch in order of pos, their
    windows above and their activities below them. Encounters of no epoch, instances of no encounter or of other kinds, and
    activities that are none, have no node. Encounters follow one another across epochs, and so do epochs. An encounter or
    timing that an anchor of the study speaks of is marked as one. Null names are empty labels, null in ids is kept out of
    joins. Windows are of one study, encounter or epoch."""
    o = lambda *by: Window.partitionBy(*by).orderBy("pos", "id")
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    per_epoch = encounters.groupBy("study", F.col("epoch_id").alias("id")).agg(F.count("*").alias("_n"))
    wide = epochs.join(per_epoch, ["study", "id"], "left").withColumn("_width", F.greatest(F.lit(EPOCH_WIDTH), F.coalesce("_n", F.lit(0)) * ENCOUNTER_STEP) + EPOCH_GAP)
    ahead = o("study").rowsBetween(Window.unboundedPreceding, -1)
    placed = wide.withColumn("_x", START_X + F.coalesce(F.sum("_width").over(ahead), F.lit(0))).withColumn("_next", F.lead("id").over(o("study")))
    low = F.lower("_label")
    kinds = anchors.groupBy("study").agg(F.bool_or(F.lower("kind") == "baseline").alias("_baseline"), F.bool_or(F.lower("kind") == "firstdose").alias("_first_dose"))
    spoken = (F.col("_baseline") & low.rlike("baseline|day 1|screening")) | (F.col("_first_dose") & low.rlike("first dose|day 1|treatment"))
    known = encounters.join(placed.select("study", F.col("id").alias("epoch_id"), "_x"), ["study", "epoch_id"])
    stood = known.withColumn("_x", F.col("_x") + ENCOUNTER_STEP * (F.row_number().over(o("study", "epoch_id")) - 1)).withColumn("_next", F.lead("id").over(o("study")))
    stood = stood.withColumn("_label", blank("name")).join(kinds, "study", "left")
    shown = instances.filter("kind = 'ScheduledActivityInstance' AND encounter_id IS NOT NULL").select("study", "pos", F.col("id").alias("_instance"), "encounter_id", F.posexplode("activity_ids").alias("_i", "id"))
    named = shown.join(activities.select("study", "id", F.coalesce("label", "name", F.lit("Activity")).alias("_label")), ["study", "id"]).join(stood.select("study", F.col("id").alias("encounter_id"), "_x"), ["study", "encounter_id"])
    below = Window.partitionBy("study", "encounter_id").orderBy("pos", "_instance", "_i")
    done = named.withColumn("_y", ENCOUNTER_Y + ACTIVITY_DROP + ACTIVITY_STEP * (F.row_number().over(below) - 1)).withColumn("_node", _text("act_", F.col("_instance"), "_", F.col("id")))
    windows = stood.filter("window <> ''")
    parts = F.concat_ws("\n", F.when(F.col("is_anchor"), "⚓"), F.nullif(F.col("name"), F.lit("")), F.nullif(F.col("value"), F.lit("")), F.when(F.col("window") != "", _text("(", F.col("window"), ")")), F.when(F.col("relative_to") != "", _text("→ ", F.col("relative_to"))))
    timed = timings.withColumn("_label", F.coalesce(F.nullif(parts, F.lit("")), F.lit("Timing"))).withColumn("_x", START_X + TIMING_STEP * (F.row_number().over(o("study")) - 1)).join(kinds, "study", "left")
    anchor_kind = F.when(F.col("is_anchor"), "anchor").otherwise("timing")
    id_ = F.col("id")
    nodes = [
        _node(placed, _text("epoch_", id_), blank("name"), "epoch", F.col("_x"), F.lit(EPOCH_Y)),
        _node(stood, _text("enc_", id_), F.col("_label"), "timing", F.col("_x"), F.lit(ENCOUNTER_Y), spoken),
        _node(windows, _text("window_", id_), F.col("window"), "window", F.col("_x"), F.lit(ENCOUNTER_Y - WINDOW_RISE)),
        _node(done, F.col("_node"), F.col("_label"), "activity", F.col("_x"), F.col("_y")),
        _node(timed, _text("timing_", id_), F.col("_label"), anchor_kind, F.col("_x"), F.lit(TIMING_Y), F.coalesce(F.col("is_anchor"), F.lit(False)) | F.coalesce(spoken, F.lit(False))),
    ]
    edges = [
        _edge(windows, _text("window_edge_", id_), _text("window_", id_), _text("enc_", id_), "window"),
        _edge(stood.filter("_next IS NOT NULL"), _text("seq_", id_, "_", F.col("_next")), _text("enc_", id_), _text("enc_", F.col("_next")), "sequence"),
        _edge(done, _text("link_", F.col("encounter_id"), "_", id_), _text("enc_", F.col("encounter_id")), F.col("_node"), "activity"),
        _edge(placed.filter("_next IS NOT NULL"), _text("epoch_trans_", id_, "_", F.col("_next")), _text("epoch_", id_), _text("epoch_", F.col("_next")), "transition"),
    ]
    return reduce(DataFrame.unionByName, nodes), reduce(DataFrame.unionByName, edges)


def graph_faults(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(study, fault, id): node ids that stand more than once in a study ("duplicate_id"), nodes without a place
    ("invalid_position"), and edges whose source or target is no node of the study ("missing_endpoint")."""
    twice = nodes.groupBy("study", "id").count().filter("count > 1").select("study", F.lit("duplicate_id").alias("fault"), "id")
    astray = nodes.filter("x IS NULL OR y IS NULL").select("study", F.lit("invalid_position").alias("fault"), "id")
    ids = nodes.select("study", F.col("id").alias("_end")).distinct()
    ends = edges.select("study", "id", F.explode(F.array("source", "target")).alias("_end"))
    missing = ends.join(ids, ["study", "_end"], "left_anti").select("study", F.lit("missing_endpoint").alias("fault"), "id").distinct()
    return twice.unionByName(astray).unionByName(missing)

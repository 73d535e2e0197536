"""Graphs, schedule marks and distinct counts on odd rows; the queries are held against SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from studygraph.operators import diagram, distinct, marks


def frames(spark, **rows):
    schemas = {
        "epochs": "study int, pos int, id string, name string, x int", "encounters": "study int, pos int, id string, name string, epoch_id string, window string, x int", "activities": "study int, id string, name string, label string",
        "instances": "study int, pos int, id string, kind string, encounter_id string, activity_ids array<string>, y int", "timings": "study int, pos int, id string, name string, value string, window string, relative_to string, is_anchor boolean", "anchors": "study int, kind string",
    }
    return [spark.createDataFrame(rows.get(n, []), s) for n, s in schemas.items()]


def test_graph(spark):
    kind = "ScheduledActivityInstance"
    given = frames(
        spark,
        epochs=[(1, 1, "p", "Screening", 0), (1, 2, "q", None, 0), (2, 1, "p", "Other", 0)],
        encounters=[(1, 1, "a", "First Dose", "q", "±2", 0), (1, 2, "b", None, "p", "", 0), (1, 3, "c", "x", "p", None, 0), (1, 4, "d", "x", "p", None, 0), (1, 5, "lost", "x", "none", None, 0), (1, 6, "lost2", "x", None, None, 0)],
        activities=[(1, "act", "Name", None), (1, "act2", None, None)],
        instances=[(1, 1, "i", kind, "b", ["act", "unknown", "act2"], 0), (1, 2, "j", kind, "b", ["act"], 0), (1, 3, "k", "Decision", "b", ["act"], 0), (1, 4, "l", kind, None, ["act"], 0), (1, 5, "m", kind, "lost", ["act"], 0), (1, 6, "n", kind, "c", None, 0)],
        timings=[(1, 1, "t", "Start", "P1D", "-1..1 days", "i", True), (1, 2, "u", None, None, None, None, None)], anchors=[(1, "FirstDose"), (1, None), (3, "Baseline")],
    )
    nodes, edges = diagram.graph(*given)
    got = {(r["study"], r["id"]): (r["type"], r["label"], r["x"], r["y"], r["is_anchor"]) for r in nodes.collect()}
    assert got == {
        (1, "epoch_p"): ("epoch", "Screening", 80, 50, False), (1, "epoch_q"): ("epoch", "", 610, 50, False), (2, "epoch_p"): ("epoch", "Other", 80, 50, False),
        (1, "enc_a"): ("timing", "First Dose", 610, 150, True), (1, "enc_b"): ("timing", "", 80, 150, False), (1, "enc_c"): ("timing", "x", 240, 150, False), (1, "enc_d"): ("timing", "x", 400, 150, False), (1, "window_a"): ("window", "±2", 610, 120, False),
        (1, "act_i_act"): ("activity", "Name", 80, 250, False), (1, "act_i_act2"): ("activity", "Activity", 80, 305, False), (1, "act_j_act"): ("activity", "Name", 80, 360, False),
        (1, "timing_t"): ("anchor", "⚓\nStart\nP1D\n(-1..1 days)\n→ i", 80, 320, True), (1, "timing_u"): ("timing", "Timing", 220, 320, False),
    }
    assert sorted((r["type"], r["source"], r["target"]) for r in edges.collect()) == [
        ("activity", "enc_b", "act_i_act"), ("activity", "enc_b", "act_i_act2"), ("activity", "enc_b", "act_j_act"), ("sequence", "enc_a", "enc_b"), ("sequence", "enc_b", "enc_c"), ("sequence", "enc_c", "enc_d"), ("transition", "epoch_p", "epoch_q"), ("window", "window_a", "enc_a"),
    ]
    assert diagram.graph_faults(nodes, edges).count() == 0
    twice = nodes.union(nodes.filter("id = 'enc_c'")).filter("id <> 'enc_b'").withColumn("x", F.when(F.col("id") != "enc_d", F.col("x")))
    assert sorted(tuple(r)[1:] for r in diagram.graph_faults(twice, edges).collect()) == [("duplicate_id", "enc_c"), ("invalid_position", "enc_d"), ("missing_endpoint", "link_b_act"), ("missing_endpoint", "link_b_act2"), ("missing_endpoint", "seq_a_b"), ("missing_endpoint", "seq_b_c")]
    nodes, edges = diagram.graph(*frames(spark))
    assert nodes.count() == edges.count() == diagram.graph_faults(nodes, edges).count() == 0


def test_marks(spark):
    shape = "array<struct<id: string, name: string, refs: array<string>>>"
    frame = spark.createDataFrame(
        [(1, [("e", "UNS¹ EOS or ETᵃ", ["Q"]), ("f", "Plain", None), ("g", None, None)], None, [("h", "ᵇ", [])], ["A. first", " i) second", "none here"], 0), (2, [("e", "Xⁱ", ["b"])], [], None, None, 0), (3, None, None, None, [], 0), (None, None, [("z", "Cuⁿ", None)], None, ["n text"], 0)],
        f"k int, epochs {shape}, encounters {shape}, activities {shape}, notes array<string>, corrections int",
    )
    got = {r["k"]: r for r in marks.normalized_schedule(frame, ["k"]).collect()}
    assert [tuple(x) for x in got[1]["epochs"]] == [("e", "UNS EOS or ET", "UNS¹ EOS or ETᵃ", ["q", "i", "a"]), ("f", "Plain", None, []), ("g", None, None, [])]
    assert [tuple(x) for x in got[1]["activities"]] == [("h", "", "ᵇ", ["b"])] and got[1]["encounters"] == []
    assert [tuple(x) for x in got[1]["corrections"]] == [("epochs", "e", "1", "i")] and [tuple(x) for x in got[1]["invalid"]] == [("epochs", "e", "Q"), ("activities", "h", "b")]
    assert got[2]["epochs"][0]["refs"] == ["b", "i"] and got[2]["corrections"] == got[2]["invalid"] == []
    assert got[3]["epochs"] == [] and got[None]["encounters"][0]["refs"] == ["n"] and got[None]["invalid"] == []
    assert marks.normalized_schedule(frame.limit(0), ["k"]).count() == 0


def test_sketches_merge(spark):
    """Exact for some hundred, within four standard errors beyond, whichever way the rows were kept."""
    rows = spark.range(60_000).selectExpr("id % 7 AS a", "CASE WHEN id % 3 < 2 THEN id % 3 END AS b", "CASE WHEN id % 10 > 0 THEN id * 2654435761 % 40009 END AS v", "0 AS sketch", "1 AS rows")
    kept = distinct.kept_sketches(rows.filter("v < 20000 OR v IS NULL"), ["a", "b"], "v").unionByName(distinct.kept_sketches(rows.filter("v >= 20000"), ["a", "b"], "v"))
    got = {(r["a"], r["b"], r["grouping"]): (r["rows"], r["distinct"]) for r in distinct.merged_counts(kept, ["a", "b"]).collect()}
    exact = rows.groupingSets([["a", "b"], ["a"], ["b"], []], "a", "b").agg(F.grouping_id("a", "b").alias("g"), F.count("*").alias("n"), F.countDistinct("v").alias("d")).collect()
    assert len(got) == len(exact) == 8 * 4
    errors = [abs(got[r["a"], r["b"], r["g"]][1] / r["d"] - 1) for r in exact]
    assert all(got[r["a"], r["b"], r["g"]][0] == r["n"] for r in exact) and max(errors) < 4 * 1.04 / 64
    small = spark.createDataFrame([("x", i % 150) for i in range(600)] + [("y", None), (None, 5)], "k string, v int")
    assert {(r["k"], r["grouping"]): (r["rows"], r["distinct"]) for r in distinct.merged_counts(distinct.kept_sketches(small, ["k"], "v"), ["k"]).collect()} == {("x", 0): (600, 150), ("y", 0): (1, 0), (None, 0): (1, 1), (None, 1): (602, 150)}
    empty = distinct.merged_counts(distinct.kept_sketches(small.limit(0), ["k"], "v"), ["k"])
    assert [tuple(r) for r in empty.collect()] in ([], [(None, 1, 0, 0)])

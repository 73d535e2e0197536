"""Visits, execution models and promotion: rows worked out by hand."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from studygraph.operators import models, promotion, visits
from studygraph.plans import models as plans


def test_visits_of_lines(spark):
    rows = spark.createDataFrame([(i, t, 0, "") for i, t in enumerate([*plans.VISIT_PASSAGES, None])], "k long, label string, nth int, visit string")
    got = {}
    for r in visits.visit_windows(rows, "label", ["k"]).orderBy("k", "nth").collect():
        got.setdefault(r["k"], []).append(tuple(r)[2:])
    assert got[0] == [("Screening", -14, None, 21, 21, True), ("Baseline", 0, None, 3, 3, True), ("Day 1", 1, None, 3, 3, True), ("Week 4", 22, 4, 3, 3, True), ("Week 12", 78, 12, 5, 5, True)]
    assert got[1] == [("Visit 2", 15, None, 2, 2, False), ("Day 15", 15, None, 2, 2, False), ("Visit 3", None, None, 2, 4, True), ("Month 6", None, None, 2, 4, True), ("End of Study", None, None, 3, 7, True)]
    assert got[2] == [("Follow-up", 365, None, 7, 7, True), ("EOT", None, None, 3, 3, False), ("Early Termination", None, None, 0, 0, False)]
    assert got[3] == [("Visit 5", 50, 8, 3, 3, True), ("Week 8", 50, 8, 3, 3, True), ("Day 57", 57, None, 3, 3, True)]
    assert 5 not in got and 6 not in got
    assert visits.visit_windows(rows.limit(0), "label", ["k"]).count() == 0
    names = spark.createDataFrame([("EOT",), ("Day 1 (CRU Discharge)",), ("Week 2 - visit b",), ("early withdrawal",), (None,)], "n string").select(visits.canonical_visit(F.col("n")).alias("c")).collect()
    assert [r["c"] for r in names] == ["end of treatment", "day 1", "week 2", "early termination", None]


def test_merged_visits(spark):
    schema = "s int, nth int, visit string, day long, week long, before long, after long"
    primary = spark.createDataFrame([(1, 1, "Day 1", 1, None, 0, 2), (1, 2, "Day 1 visit here", 1, None, 1, 1), (1, 3, "EOT", None, None, None, None), (1, 4, "eot", 9, None, 5, 5), (None, 1, "Day 3", 3, None, 0, 0)], schema)
    secondary = spark.createDataFrame([(1, 1, "end of treatment", 40, None, 4, 0), (1, 2, "Anything", 1, None, 9, 9), (1, 3, "Week 2", 8, 2, 1, 1), (1, 4, "week 2", 99, 2, 1, 1), (1, 5, "Other", 8, None, 1, 1), (None, 1, "x", 3, None, 6, 0), (2, 1, "Only", None, None, 1, 0)], schema)
    got = sorted(((r["s"] or 0), r["number"], r["visit"], r["day"], r["before"], r["after"], r["origin"]) for r in visits.merged_visits(primary, secondary, ["s"]).collect())
    assert got == [
        (0, 1, "Day 3", 3, 6, 0, "primary"), (1, 1, "EOT", None, 4, None, "primary"), (1, 2, "Day 1 visit here", 1, 1, 1, "primary"), (1, 3, "Week 2", 8, 1, 1, "secondary"), (2, 1, "Only", None, 1, 0, "secondary"),
    ]
    assert visits.merged_visits(primary.limit(0), secondary.limit(0), ["s"]).count() == 0


GOOD = {
    "anchors": [{"kind": "FirstDose", "definition": "a"}], "repetitions": [{"id": "1", "kind": "Daily"}], "execution_types": [{"activity": "x", "kind": "Single"}], "traversals": [["SCREENING", "PERIOD_1"]],
    "crossover": {"is_crossover": True, "periods": 2, "sequences": ["AB"]}, "footnotes": [{"structured": "x"}], "endpoints": [{"name": "e", "kind": "Primary", "algorithm": "a"}], "variables": [{"name": "v", "kind": "Custom", "derivation": "d"}],
    "machine": {"states": ["S", "T", "E"], "initial": "S", "terminal": ["E"], "transitions": [{"from_state": "S", "to_state": "T"}, {"from_state": "T", "to_state": "E"}]}, "sampling": [{"activity": "pk", "least": 5, "timepoints": [], "window": None}],
}
FAULTS = [
    ({"anchors": []}, [("TimeAnchors", "warning", "No time anchors extracted")]),
    ({"anchors": [{"kind": "Other", "definition": "A"}, {"kind": None, "definition": "a"}]}, [("TimeAnchors", "info", "No first dose or randomization anchor found"), ("TimeAnchors", "warning", "Duplicate anchor definitions detected")]),
    ({"repetitions": [{"id": "7", "kind": "Interval"}, {"id": "8", "kind": "Interval", "interval": ""}]}, [("Repetitions", "warning", f"Interval repetition '{i}' missing interval duration") for i in (7, 8)]),
    ({"execution_types": None}, [("ExecutionTypes", "warning", "No execution types classified")]),
    ({"traversals": [["baseline"], []]}, [("TraversalConstraints", "warning", "Traversal sequence too short")] * 2 + [("TraversalConstraints", "info", "Sequence doesn't start with SCREENING"), ("Consistency", "info", "Crossover detected but traversal doesn't show period structure")]),
    ({"crossover": {"is_crossover": True, "periods": 1, "sequences": None}}, [("CrossoverDesign", "error", "Crossover design must have at least 2 periods"), ("CrossoverDesign", "warning", "Crossover missing treatment sequences")]),
    ({"footnotes": [{"structured": None}] * 101}, [("FootnoteConditions", "warning", "Unusually high number of footnotes (101)"), ("FootnoteConditions", "info", "101 footnotes lack structured conditions")]),
    ({"endpoints": [{"name": "Change from Baseline", "kind": "Other"}]}, [("EndpointAlgorithms", "warning", "No primary endpoint extracted"), ("EndpointAlgorithms", "warning", "1 endpoints missing algorithm/calculation logic"), ("Consistency", "info", "Change-from-baseline endpoints found but no CFB derived variables")]),
    ({"variables": [{"name": "v", "kind": "ChangeFromBaseline"}]}, [("DerivedVariables", "warning", "1 change-from-baseline vars missing baseline definition"), ("DerivedVariables", "warning", "1 variables missing derivation rule")]),
    ({"machine": None}, [("StateMachine", "info", "No state machine generated")]),
    ({"machine": {"states": ["S", "E"], "initial": "S"}}, [("StateMachine", "warning", "State machine has too few states"), ("StateMachine", "error", "State machine has no terminal states"), ("StateMachine", "warning", "State machine has no transitions"), ("StateMachine", "warning", "Unreachable states: E"), ("StateMachine", "warning", "Non-terminal dead-end states: E, S")]),
    ({"sampling": [{"activity": "a", "least": 31, "timepoints": ["0"]}, {"activity": "b", "least": 1}]}, [("SamplingConstraints", "warning", "Unusually high sample count (31) for a"), ("SamplingConstraints", "warning", "Very low sample count (1) for b"), ("SamplingConstraints", "info", "1 constraints have timepoints but no window duration")]),
    ({}, []),
]


def test_model_checks(spark):
    lines = [(i, json.dumps(GOOD | change)) for i, (change, _) in enumerate(FAULTS)]
    frame = spark.createDataFrame(lines, "study int, j string").select("study", F.from_json("j", ", ".join(f"{n} {k}" for n, k in models.MODEL.items())).alias("m")).select("study", "m.*", F.lit("x").alias("issues"), F.lit(1).alias("component"))
    got = {}
    for r in models.model_issues(frame, "study").collect():
        got.setdefault(r["study"], []).append((r["component"], r["severity"], r["message"]))
    for i, (_, want) in enumerate(FAULTS):
        assert sorted(got.get(i, [])) == sorted(want), i
    scores = {r["study"]: (r["errors"], r["warnings"], r["infos"], round(r["score"], 9), r["valid"]) for r in models.model_scores(frame, "study", require_machine=True).collect()}
    assert scores[5] == (1, 1, 0, 0.8, False) and scores[9] == (1, 0, 0, 0.85, False) and scores[12] == (0, 0, 0, 1.0, True)
    bare = models.model_issues(spark.createDataFrame([(1,), (None,)], "study int"), "study").collect()
    assert len(bare) == 2 * 8 and models.model_issues(frame.limit(0), "study").count() == 0


def test_crossovers(spark):
    schema = "k int, arms array<struct<name: string, description: string>>, ratio string, periods long, epochs long, sequences long, issues int"
    pair = [("Sequence AB", "A then B"), ("x", "B then A")]
    rows = [
        (1, pair, "1:1", 2, 3, 2), (2, [("One", None)], None, 2, 3, 2), (3, None, None, 2, 3, 1), (4, [("a", "b"), ("c", ""), ("d", "")], None, 2, 3, 2), (5, [("MTX to New", ""), ("New", "")], None, 2, 3, 2),
        (6, pair, "1:1:2", 2, 3, 2), (7, pair, "2:1", 4, 3, 2), (8, [*pair, ("up", "titration of dose")], "2:1", 4, None, 2), (9, pair, "no ratio", None, None, None),
    ]
    got = {r["k"]: (r["keep"], r["issues"]) for r in models.crossover_consistency(spark.createDataFrame([(*r, 0) for r in rows], schema), "k").collect()}
    assert got == {
        1: (True, []), 2: (False, ["crossover_design_mismatch"]), 3: (True, []), 4: (False, ["crossover_parallel_mismatch"]), 5: (False, ["crossover_switch_pattern"]), 6: (False, ["crossover_ratio_mismatch"]),
        7: (True, ["crossover_unequal_ratio", "crossover_period_mismatch"]), 8: (False, ["crossover_unequal_ratio", "crossover_period_mismatch", "crossover_titration_conflict"]), 9: (True, []),
    }


STUDY = {
    "activities": [{"id": "a1", "name": "Drug administration"}, {"id": "a2", "name": "ECG", "label": "12-lead"}, {"id": "a3", "name": "Consent form"}],
    "epochs": [{"id": "p1", "name": "Screening"}, {"id": "p2", "name": "Treatment Phase"}, {"id": "p3", "name": "Follow-up"}],
    "encounters": [{"id": "e1", "name": "Screening 1", "epoch_id": "p1"}, {"id": "e2", "name": "Day 1", "epoch_id": "p2", "timing_id": "t1"}, {"id": "e3", "name": "Day 8", "label": "Week 2", "epoch_id": "p2"}, {"id": "e4", "name": "Day 8 again", "epoch_id": "p2"}],
    "instances": [{"id": "i1", "name": "Baseline visit", "day": 0}, {"id": "i2", "name": "ECG", "activity_id": "a2", "encounter_id": "e3"}],
    "timings": [{"id": "t1", "name": "x", "from_instance_id": "i1"}, {"id": "t2", "name": "from dose", "from_instance_id": "n1"}, {"id": "t3", "name": "Day 0 later", "from_instance_id": "gone"}, {"id": "t4", "name": "End of study", "from_instance_id": "gone2"},
                {"id": "t5", "name": "dose event", "from_instance_id": "gone3"}, {"id": "t6", "name": "a cycle", "from_instance_id": "gone4"}, {"id": "t7", "name": "nothing"}, {"id": "t8", "name": "enrolment", "from_instance_id": "gone5"}, {"id": "t9", "name": "z", "from_instance_id": "n4"}],
    "interventions": [{"id": "v1", "name": "Placebo"}, {"id": "v2", "name": "Newdrug 10 mg"}], "endpoints": [{"id": "q1", "name": "Weight"}], "estimands": [{"id": "m1", "name": "Main", "endpoint_id": "q1"}, {"id": "m2", "name": "Height gain"}],
    "anchors": [{"id": "n1", "name": "First Dose", "class": "Event", "day": 1}, {"id": "n2", "name": "Randomization", "class": "Visit", "day": 1, "place": 5}, {"id": "n3", "name": "first dose", "class": "Event", "day": 3}, {"id": "n4", "name": "Cycle start", "class": "Conceptual"}, {"id": "n5", "name": "Baseline visit", "class": "Visit"}],
    "repetitions": [{"id": "r1", "kind": "Daily", "activity": "ECG", "start_day": 1, "end_day": 10}, {"id": "r2", "kind": "Weekly", "activity": "12-LEAD", "start_day": 1, "end_day": 30}, {"id": "r3", "kind": "Daily", "activity": "unknown", "start_day": 1, "end_day": 3}, {"id": "r4", "kind": "Other", "activity": "consent", "start_day": 0, "end_day": 9, "every": 8}],
    "regimens": [{"id": "g1", "treatment": "newdrug", "dose": "10.5 mg twice", "route": "IV", "frequency": "daily"}, {"id": "g2", "treatment": "for the"}, {"id": "g3", "treatment": "Unlisted", "route": "nasal"}],
    "visit_windows": [{"visit": "week 2", "day": 8, "before": 2, "after": 0}, {"visit": "Day 1", "day": 1, "after": 3}, {"visit": "Day 8", "day": 8, "before": 1, "after": 1}, {"visit": "nowhere", "day": 5}, {"visit": "Day 1"}],
    "traversals": [["Screening", "p2", "FOLLOW-UP"], ["p1", "nothing", "p3"]],
    "footnotes": [{"id": "c1", "kind": "procedure_variant", "text": "if needed", "applies_to": ["ecg", "a1", "none"]}, {"id": "c2", "kind": "timing_before", "text": "before"}, {"id": "c3", "text": ""}, {"id": "c1", "text": "again"}, {"id": "c4", "text": "x", "applies_to": None}],
    "transitions": [{"from_state": "screening 1", "to_state": "Day 1", "trigger": "fit", "guard": "ok"}, {"from_state": "Day 1", "to_state": "Day 8", "trigger": ""}],
    "algorithms": [{"name": "weight", "algorithm": "post - pre"}, {"name": "height", "algorithm": "h"}, {"name": "gain", "algorithm": "late"}, {"name": "weight"}],
    "titrations": [{"id": "z1", "name": "Up", "levels": [{"dose": "5", "criteria": "ok"}, {"dose": "10", "duration": "P7D"}]}, {"id": "z2", "levels": []}, {"id": "z3", "levels": [{}]}],
}


@pytest.fixture(scope="module")
def promoted(spark):
    rows = [(1, json.dumps(STUDY)), (2, "{}"), (3, json.dumps({"anchors": [{"id": "n", "name": "", "class": "Visit"}], "timings": [{"id": "t", "name": "visit", "from_instance_id": "g"}], "visit_windows": [{"visit": "anchor", "day": 2}]}))]
    frame = spark.createDataFrame(rows, "s int, j string").select("s", F.from_json("j", promotion.SCHEMA).alias("d")).select("s", "d.*", F.lit(5).alias("mapping"), F.lit(6).alias("_new"))
    done = promotion.promote(frame, "s")
    return done, {r["s"]: r.asDict(recursive=True) for r in done.collect()}


def test_promotion(promoted):
    done, got = promoted
    d = got[1]
    by = lambda array: {x["id"]: x for x in d[array]}
    i = by("instances")
    assert list(i) == ["i1", "i2", "anchor_inst_n2", "anchor_inst_n1", "rep_r1_day_1", "rep_r4_day_8", "gone2", "entry_1", "sdi_c1"]
    assert (i["anchor_inst_n1"]["activity_id"], i["anchor_inst_n1"]["epoch_id"], i["anchor_inst_n1"]["encounter_id"]) == ("a1", "p2", None) and i["anchor_inst_n2"]["encounter_id"] == "e2"
    assert (i["rep_r1_day_1"]["encounter_id"], i["rep_r4_day_8"]["activity_id"], i["gone2"]["encounter_id"], i["sdi_c1"]["target_id"]) == ("e2", "a3", "e2", "a2")
    mapping = {(m["kind"], m["source_id"]): m["target_id"] for m in d["mapping"]}
    assert {k[1]: v for k, v in mapping.items() if k[0] == "anchor"} == {"n1": "anchor_inst_n1", "n2": "anchor_inst_n2", "n3": "anchor_inst_n1", "n4": "timing_ref_n4", "n5": "i1"}
    assert {k: t["from_instance_id"] for k, t in by("timings").items()} == {"t1": "i1", "t2": "anchor_inst_n1", "t3": "i1", "t4": "gone2", "t5": "anchor_inst_n1", "t6": "gone4", "t7": None, "t8": "gone5", "t9": "timing_ref_n4", "timing_e3": "entry_1"}
    assert {x["category"] for x in d["issues"]} == {"timing_reference_remapped", "visit_anchor_created", "event_anchor_linked", "event_anchor_unresolved", "conceptual_anchor_stored"}
    assert {x["id"]: x["class"] for x in d["conceptual"]} == {"timing_ref_n4": "Conceptual", "gone4": "Conceptual", "gone5": "Event"}
    t = by("timings")
    assert (t["t1"]["window_lower"], t["t1"]["window_upper"], t["t1"]["window_label"]) == ("P0D", "P3D", "Day 1 (−0/+3)") and (t["timing_e3"]["window_lower"], t["timing_e3"]["window_upper"], t["timing_e3"]["value"]) == ("-P1D", "P1D", "P8D")
    assert by("encounters")["e3"]["timing_id"] == "timing_e3" and by("encounters")["e2"]["timing_id"] == "t1"
    assert [(x["previous_id"], x["next_id"]) for x in d["epochs"]] == [(None, "p2"), ("p1", "p3"), ("p2", None)]
    assert [(x["previous_id"], x["next_id"]) for x in d["encounters"]] == [(None, None), (None, "e3"), ("e2", "e4"), ("e3", None)]
    assert [(x["start_rule"], x["end_rule"]) for x in d["encounters"]] == [(None, "fit [Guard: ok]"), ("fit [Guard: ok]", None), (None, None), (None, None)]
    assert [(x["id"], x["dose"], x["unit"], x["route_code"], x["route"], x["description"]) for x in d["administrations"]] == [("admin_g1", 10.5, "mg", "C38276", "Intravenous", "10.5 mg twice IV daily"), ("admin_g3", None, None, "C38288", "nasal", "nasal")]
    assert [x["administration_ids"] for x in d["interventions"]] == [[], ["admin_g1"]]
    assert [(x["id"], x["name"], x["applies_to"]) for x in d["conditions"]] == [("c1", "Procedure Variant", ["a2", "a1"]), ("c2", "Timing Before", []), ("c4", "Conditional Rule", [])]
    assert [x["algorithm"] for x in d["estimands"]] == ["post - pre", "h"]
    assert [(x["id"], x["name"], x["previous_id"], x["start_rule"]) for x in d["elements"]] == [("elem_z1_0", "Up - Step 1: 5", None, "ok"), ("elem_z1_1", "Up - Step 2: 10", "elem_z1_0", None), ("elem_z3_0", "Dose Step 1", None, None)]


def test_promotion_of_little(promoted):
    done, got = promoted
    assert all(not v for k, v in got[2].items() if k != "s")
    d = got[3]
    assert [x["id"] for x in d["encounters"]] == ["enc_anchor_3"] and [x["id"] for x in d["instances"]] == ["anchor_inst_n", "g", "entry_3"] and d["encounters"][0]["timing_id"] == "timing_enc_anchor_3"


def test_after_promotion(spark, promoted):
    done, _ = promoted
    assert promotion.promotion_issues(done, "s").count() == 0 and promotion.promote(done.limit(0), "s").count() == 0
    broken = {
        "conditions": [{"id": "c", "applies_to": ["none", "a"]}], "activities": [{"id": "a"}], "timings": [{"id": "t", "from_instance_id": "none"}, {"id": "u", "from_instance_id": ""}, {"id": "w", "from_instance_id": "held"}], "conceptual": [{"id": "held"}],
        "instances": [{"id": "i", "kind": "ScheduledDecisionInstance", "target_id": "none"}, {"id": "j", "kind": "ScheduledDecisionInstance", "target_id": "a"}], "encounters": [{"id": "e", "previous_id": "none", "next_id": "e"}], "epochs": [{"id": "p", "next_id": "none"}],
        "estimands": [{"id": "m", "endpoint_id": "none"}],
    }
    frame = spark.createDataFrame([(1, json.dumps(broken))], "s int, j string").select("s", F.from_json("j", promotion.SCHEMA).alias("d")).select("s", *(F.coalesce(f"d.{n}", F.array().cast(k)).alias(n) for n, k in promotion.DESIGN.items()))
    got = sorted(tuple(r)[1:] for r in promotion.promotion_issues(frame, "s").collect())
    assert got == sorted([("orphan_reference", "c", "none"), ("dangling_reference", "t", "none"), ("invalid_condition_target", "i", "none"), ("broken_chain", "e", "none"), ("broken_chain", "p", "none"), ("orphan_reference", "m", "none")])

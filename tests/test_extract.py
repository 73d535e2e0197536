"""Extractors against rows worked out by hand, and over nulls, empty texts and tables, and names that clash."""

from __future__ import annotations

import pytest

from studygraph.operators import extract, rules


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "k long, t string, kind string, _low string")


def test_tables_are_whole():
    assert (len(rules.ANCHORS), len(rules.REPETITIONS), len(rules.EXECUTION_TYPES)) == (55, 79, 88)


def test_anchors(spark):
    got = extract.anchors(rows(spark, [
        "First dose of study drug on Day 1. A baseline visit takes place on day 3.", "C1D1 is the first day; informed consent before surgery", "Post-randomization follow-up", None, "", "Nothing", "Week 0 of treatment",
    ]), "t", ["k"]).collect()
    assert {(r["k"], r["kind"], r["confidence"], r["day"], r["first"]) for r in got} == {
        (0, "FirstDose", 0.95, 1, "first dose of study drug"), (0, "Baseline", 0.8, 1, "baseline visit"), (1, "CycleStart", 0.8, 1, "c1d1"), (1, "InformedConsent", 0.75, 1, "informed consent"), (1, "Custom", 0.85, 1, "surgery"),
        (2, "Randomization", 0.8, 1, "post-randomization"), (6, "Baseline", 0.8, 1, "week 0 of treatment"),
    }
    assert {r["definition"] for r in got if r["kind"] == "Custom"} == {"surgery"} and {r["definition"] for r in got if r["kind"] == "FirstDose"} == {"First administration of investigational product"}
    assert [r["day"] for r in extract.anchors(rows(spark, ["Screening visit on day 14"]), "t", ["k"]).collect()] == [14]


@pytest.mark.parametrize(("text", "kind", "confidence"), [
    ("ECG monitoring from Day 1 to Day 5 in the inpatient period", "Window", 0.90), ("If glucose < 70, administer rescue therapy until resolved", "Episode", 0.95), ("Performed once at screening visit", "Single", 0.85),
    ("Vital signs at each visit", "Recurring", 0.90), ("Nothing", "Single", 0.5), (None, "Single", 0.5), ("informed consent", "Single", 0.90),
])
def test_execution_type(spark, text, kind, confidence):
    got = extract.best_kind(rows(spark, [text]), "t", ["k"], rules.EXECUTION_TYPES, "Single").collect()
    assert [(r["kind"], r["confidence"]) for r in got] == [(kind, confidence)]


def test_repetitions(spark):
    got = extract.first_per_kind(rows(spark, ["Daily urine collection, every 2 hours", "21-day cycle until disease progression, days -4 to -1", None]), "t", ["k"], rules.REPETITIONS).collect()
    assert {(r["k"], r["kind"], r["first"]) for r in got} == {(0, "Daily", "daily urine"), (0, "Interval", "every 2 hours"), (1, "Cycle", "21-day cycle"), (1, "Continuous", "days -4 to -1")}


def test_crossovers(spark):
    got = {r["k"]: r for r in extract.crossovers(rows(spark, [
        "A 2-period crossover study with a 14-day washout; sequence AB and sequence BA", "Three-way crossover trial, period 1, period 2, period 3; minimize carry-over", "Dose escalation in a single-arm crossover study", "No such thing", None,
        "Crossover design with washout of 2 weeks",
    ]), "t", ["k"]).collect()}
    assert sorted(got) == [0, 1, 5]
    assert (got[0]["periods"], got[0]["sequences"], got[0]["washout"], got[0]["confidence"], got[0]["carryover"]) == (2, ["AB", "BA"], "P14D", 0.95, False)
    assert (got[1]["periods"], len(got[1]["sequences"]), got[1]["washout"], got[1]["carryover"]) == (3, 6, None, True)
    assert (got[5]["washout"], got[5]["sequences"], got[5]["washout_required"]) == ("P2W", ["AB", "BA"], True)


def test_traversals(spark):
    got = {r["k"]: r for r in extract.traversals(rows(spark, ["A treatment phase and end of study. Baseline visit on Day 1. Early termination visit.", None]), "t", ["k"]).collect()}
    assert got[0]["epochs"] == ["BASELINE", "TREATMENT", "END_OF_STUDY"]
    assert got[0]["mandatory"] == ["Screening", "Day 1", "Baseline", "End of Study"] and got[0]["early_exit"] and got[0]["exit_procedures"] == ["Early Termination Visit"]
    assert got[1]["epochs"] == ["SCREENING", "TREATMENT", "FOLLOW_UP", "END_OF_STUDY"] and got[1]["mandatory"] == ["Screening", "End of Study"] and not got[1]["early_exit"]


def test_endpoints(spark):
    got = extract.endpoints(rows(spark, ["Primary endpoint: Change from baseline in HbA1c at week 24. A responder is defined as one with 30% reduction within 12 weeks. Safety endpoint: number of events after the first dose.", None, "short"]), "t", ["k"]).collect()
    assert [(r["k"], r["kind"], r["name"], r["confidence"]) for r in got] == [(0, "Primary", "Change from baseline in HbA1c at week 24", 0.95), (0, "Safety", "number of events after the first dose", 0.90)]
    assert (got[0]["duration"], got[0]["inputs"], got[0]["success"]) == ("P12W", ["HbA1c", "PR"], "one with 30% reduction within 12 weeks")
    assert got[1]["time_reference"] == "the first"


def test_derived_variables(spark):
    got = extract.derived_variables(rows(spark, ["Intro without any of the words that count.\n1.1 Percent change in weight is calculated as (post - pre) / pre, using LOCF.\n- Time to first event: a derived variable based on tumor size at week 12", None]), "t", ["k"]).collect()
    assert [(r["section_no"], r["kind"], r["imputation"]) for r in got] == [(2, "PercentChange", "LOCF"), (3, "TimeToEvent", None)]
    assert got[0]["derivation"] == "(post - pre) / pre, using locf" and got[1]["derivation"] == "event_date - reference_date" and got[1]["analysis_window"] == "at week 12"
    assert "weight" in got[0]["sources"] and "tumor size" in got[1]["sources"]


def test_empty_tables(spark):
    none = rows(spark, ["x"]).limit(0)
    for f in (extract.anchors, extract.crossovers, extract.traversals, extract.endpoints, extract.derived_variables):
        assert f(none, "t", ["k"]).count() == 0


def test_texts_that_patterns_need():
    """Whatever a rule matches holds one of its required texts, and most rules have one."""
    from studygraph.functions.literals import required
    from studygraph.operators import rules as R

    assert required(r"(?:24|48)[\s-]*(?:hour|hr)\s+blood\s+pressure") == ("pressure",)
    assert required(r"x?(?:a|bc)*") == () and required(r"on(?:ce)?\s+daily") == ("daily",) and set(required(r"(?:day|week)s?\s*\d+")) == {"day", "week"}
    patterns = [r[0] for r in (*R.ANCHORS, *R.REPETITIONS, *R.EXECUTION_TYPES)]
    assert sum(bool(required(p)) and min(map(len, required(p))) > 2 for p in patterns) > 0.8 * len(patterns)


def test_ranges_stay_where_they_are(spark):
    """The join sends the counted days to all tasks, not the ranges, which grow with the customers."""
    from studygraph import plans

    plan = plans.queries()["day_range_join"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan

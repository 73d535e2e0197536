from __future__ import annotations

from pyspark.sql import functions as F

from studygraph.operators import clinical, match, merge
from studygraph.plans import queries


def test_epochs(spark):
    rows = [("p", "soa", 10, 0, "e1", "Screening a", None, 2), ("p", "execution", 20, 0, None, "screening", None, 1), ("p", "soa", 10, 1, "e2", "Treatment", None, None), ("p", "soa", 10, 2, "e3", " (b)", None, None), ("p", "soa", 10, 3, "e4", "Follow-up", None, 3), ("q", "soa", 10, 0, "x", "A", True, None), ("q", "soa", 10, 1, "y", "B", False, None)]
    df = spark.createDataFrame(rows, "protocol_id string, source string, priority int, pos int, id string, name string, is_main boolean, sequence int")
    got = {(r["protocol_id"], r["name"]): r for r in clinical.epochs(df).collect()}
    assert set(got) == {("p", "Screening"), ("p", "Treatment"), ("p", "Follow-up"), ("q", "A"), ("q", "B")}
    s = got["p", "Screening"]
    assert (s["id"], s["sequence"], s["sources"], s["footnotes"], s["is_main"], s["place"]) == ("e1", 1, ["execution", "soa"], ["a"], True, 1)
    assert got["p", "Treatment"]["is_main"] and not got["p", "Follow-up"]["is_main"] and got["p", "Treatment"]["previous_id"] == "e1"
    assert got["q", "A"]["is_main"] and not got["q", "B"]["is_main"] and got["q", "B"]["main_order"] is None


def test_encounters_and_activities(spark):
    got = {r["name"]: r for r in queries()["encounter_reconcile"](spark, "/root/testdata/sf0.001").filter("protocol_id = '3'").collect()}
    assert got["Day -7"]["study_day"] == -7 and got["Day -7"]["id"] == "enc_3" and got["Day 1"]["window_after"] == 2 and got["Day 1"]["epoch_id"] == "e2"
    assert "Week 2" in got and got["Screening"]["epoch_id"] == "e2"
    places = [r["place"] for r in sorted(got.values(), key=lambda r: r["place"])]
    assert places == list(range(1, len(got) + 1))
    acts = spark.createDataFrame([("p", "soa", 100, 0, "a1", "ECG", "g", True, False), ("p", "procedures", 20, 0, "b1", "ecg", None, False, True), ("p", "soa", 100, 1, "a2", "Labs", None, True, None)], "protocol_id string, source string, priority int, pos int, id string, name string, group_id string, is_required boolean, is_conditional boolean")
    out = clinical.activities(acts, spark.createDataFrame([("p", "LABS")], "protocol_id string, name string")).collect()
    assert [(r["id"], r["is_required"], r["is_conditional"], r["group_id"]) for r in out] == [("a1", False, True, "g")]


def test_visit_resolver(spark):
    got = {r["wanted"]: (r["id"], r["tier"]) for r in queries()["visit_resolver"](spark, "/root/testdata/sf0.001").filter("protocol_id = 1").collect()}
    assert got["EOS"] == ("9", 3) and got["Week 4"] == ("5", 2) and got["baseline"] == ("1", 2) and got["Day 29"] == ("11", 2) and got["Visit 3 of 5"] == ("7", 5) and got["Safety visit"] == ("8", 3) and got["none of these"] == (None, None)


def test_anchors(spark):
    df = spark.createDataFrame([("p", "Baseline", 1), ("p", "Screening", -14), ("p", "Randomization", 1), ("p", "Custom", 0)], "protocol_id string, kind string, day int")
    assert [(r["kind"], r["place"]) for r in clinical.promoted_anchors(df).orderBy("place").collect()] == [("Screening", 1), ("Randomization", 2), ("Baseline", 3)]


def test_similarity():
    f = clinical.base_similarity
    assert f("tbd", None) == 1.0 and f("abc", "") == 0.0 and f("Overall survival", "overall  SURVIVAL") == 1.0
    assert f("overall survival", "the overall survival of all subjects here") >= 0.89 and f("a b c d", "a b x y") >= 0.75 and f("abcdefgh", "zz abcdefgh zz yy ww") >= 0.85


def test_matching(spark):
    pairs = spark.createDataFrame([("g", 1, 10, 0.9), ("g", 1, 11, 0.8), ("g", 2, 10, 0.95), ("g", 2, 11, 0.7), ("g", 3, 12, 0.5)], "g string, l int, r int, s double")
    assert sorted(tuple(r) for r in match.greedy_match(pairs, "g", "l", "r", "s", 0.7).collect()) == [("g", 1, 10, 0.9), ("g", 2, 11, 0.7)]
    names = spark.createDataFrame([("g", 1, "vital signs"), ("g", 2, "vital sign"), ("g", 3, "ecg"), ("h", 1, "ecg")], "g string, o int, n string")
    assert sorted((r["g"], r["o"], r["leader"]) for r in match.leader_clusters(names, "g", "o", "n", 0.85).collect()) == [("g", 1, 1), ("g", 2, 1), ("g", 3, 3), ("h", 1, 1)]
    notes = spark.createDataFrame([("d", 1, "Fasting for ten hours"), ("d", 2, "fasting for ten hours before"), ("d", 3, "Only for women"), ("e", 1, "Only for women")], "d string, o int, n string")
    assert sorted((r["d"], r["o"]) for r in merge.distinct_notes(notes, "d", "o", "n").collect()) == [("d", 1), ("d", 3), ("e", 1)]
    ratio = spark.createDataFrame([("abcd", "bcde"), (None, "x")], "a string, b string").select(match.ratcliff_ratio("a", "b").alias("r")).collect()
    assert [r["r"] for r in ratio] == [0.75, None]


def test_every_query_runs(spark):
    from studygraph.plans import oracle_sql

    for name, run in queries().items():
        if name not in oracle_sql():
            assert run(spark, "/root/testdata/sf0.001").agg(F.count("*")).first()[0] > (-1 if name == "fuzzy_ratcliff" else 0), name  # the smallest tables have no such names


def test_visits_resolved_on_odd_rows(spark):
    encounters = spark.createDataFrame([(1, "a", "Week 4", 2), (1, "b", "WEEK 4 ", 1), (1, "c", None, 0), (1, "d", "", 3), (2, "e", "End of Study", 1), (None, "f", "Week 4", 1), (1, "g", "Day 29 visit", 4)], "protocol_id int, id string, name string, pos int")
    asked = spark.createDataFrame([(1, "week 4"), (1, None), (1, ""), (2, "EOS"), (3, "week 4"), (None, "week 4"), (1, "at day 29"), (1, "visit 9")], "protocol_id int, wanted string")
    got = {(r["protocol_id"], r["wanted"]): (r["id"], r["tier"]) for r in clinical.resolve_visits(asked, encounters, ["protocol_id"]).collect()}
    assert got[1, "week 4"] == ("b", 1) and got[1, ""] == ("d", 1) and got[2, "EOS"] == ("e", 3) and got[1, "at day 29"] == ("g", 6)
    assert {got[k] for k in ((1, None), (3, "week 4"), (None, "week 4"), (1, "visit 9"))} == {(None, None)} and len(got) == 8
    empty = clinical.resolve_visits(asked, encounters.limit(0), ["protocol_id"]).collect()
    assert len(empty) == 8 and all(r["id"] is None for r in empty) and clinical.resolve_visits(asked.limit(0), encounters, ["protocol_id"]).count() == 0


def test_visits_with_known_facts(spark):
    """Facts that the tables hold already give what names do."""
    e = spark.createDataFrame([(1, "a", "Screening", 0), (1, "b", "Week 4", 1), (2, "c", None, 0)], "protocol_id int, id string, name string, pos int")
    asked = spark.createDataFrame([(1, "week 4 visit"), (1, "screen"), (2, "Day 1"), (1, None)], "protocol_id int, wanted string")
    known = clinical.resolve_visits(asked.withColumn("f", clinical.visit_facts(F.col("wanted"))), e.withColumn("f", clinical.visit_facts(F.col("name"))), ["protocol_id"], "f")
    assert sorted(map(str, known.collect())) == sorted(map(str, clinical.resolve_visits(asked, e, ["protocol_id"]).collect()))


def test_encounters_in_as_many_tasks_as_they_need(spark, monkeypatch):
    """More contributions make more tasks, not larger ones, and they move once."""
    monkeypatch.setattr(clinical, "ROWS", 100)
    plan = queries()["encounter_reconcile"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    rows = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").count() * 27
    assert f", {-(-rows // 100)}), REPARTITION_BY_NUM" in plan and plan.count("Exchange hashpartitioning") == 1

"""Operators over nulls, ties, repeated rows, empty tables and columns whose names clash with theirs."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from studygraph.functions import text as T
from studygraph.operators import match, merge, pages, reconcile, schedule, validate
from studygraph.streaming.provenance import stored_stream


def test_cascade(spark):
    df = spark.createDataFrame([(1, 10, "a", "b"), (None, 10, "c", "d"), (3, None, "e", "f"), (3, None, "e", "f")], "k long, m long, _k1 string, __v2 string")
    first, second = spark.createDataFrame([(1, "one"), (None, "never")], "k long, v string"), spark.createDataFrame([(10, "ten")], "m long, v string")
    got = match.cascade(df, [(first, "k", "v"), (second, "m", "v")], "out")
    assert sorted(got.columns) == sorted(["k", "m", "_k1", "__v2", "out", "tier"])
    assert sorted(((r["k"], r["out"], r["tier"]) for r in got.collect()), key=str) == sorted([(1, "one", 1), (None, "ten", 2), (3, None, None), (3, None, None)], key=str)
    assert match.cascade(df.limit(0), [(first, "k", "v")], "out").count() == 0


def test_leader_clusters(spark):
    names = [("g", 1, "alpha beta"), ("g", 2, "alpha bet"), ("g", 3, None), ("g", 4, None), ("g", 5, "gamma"), ("g", 6, "alpha beta"), (None, 7, "gamma"), (None, 8, "gamma"), ("g", 9, "")]
    df = spark.createDataFrame([(*x, 0) for x in names], "g string, o long, n string, leader int")
    got = {r["o"]: r["leader"] for r in match.leader_clusters(df, "g", "o", "n", 0.85).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 1, 7: 7, 8: 7, 9: 9}
    assert match.leader_clusters(df.limit(0), "g", "o", "n", 0.85).count() == 0


def test_distinct_notes(spark):
    df = spark.createDataFrame([(1, 1, "Fasting is needed"), (1, 2, "fasting IS needed"), (1, 3, None), (1, 4, "Another note"), (2, 1, None), (None, 1, "Fasting is needed")], "g long, o long, n string")
    assert sorted(((r["g"], r["o"]) for r in merge.distinct_notes(df, "g", "o", "n").collect()), key=str) == sorted([(1, 1), (1, 4), (None, 1)], key=str)
    assert merge.distinct_notes(df.limit(0), "g", "o", "n").count() == 0


def test_first_per_key_and_ties(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 1, "a"), (1, None, "b"), (1, 2, "c")], "k long, o long, v string")
    got = {r["k"]: r["v"] for r in match.first_per_key(df, ["k"], [F.col("o"), F.col("v")]).collect()}
    assert got[None] == "a" and set(got) == {None, 1}
    assert match.first_per_key(df.limit(0), ["k"], [F.col("o")]).count() == 0


def test_levenshtein_pairs(spark):
    l = spark.createDataFrame([(1, "abcdef"), (1, None), (None, "abcdef")], "k long, n string")
    got = match.levenshtein_pairs(l, l, "k", "n", 0.8).collect()
    assert [(r["l_n"], r["r_n"], r["similarity"]) for r in got] == [("abcdef", "abcdef", 1.0)]


def test_schedule(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (1, 3, None), (None, 4, "b")], "g long, o long, n string")
    assert {(r["g"], r["previous_id"], r["next_id"]) for r in schedule.chained(df, "g", ["o"], "o").collect()} == {(1, None, 2), (1, 1, 3), (1, 2, None), (None, None, None)}
    assert {(r["o"], r["u"]) for r in schedule.numbered_names(df, "g", "o", "n", "u").collect()} == {(1, "a (1)"), (2, "a (2)"), (3, None), (4, "b")}
    assert [(r["g"], r["m"], r["n"], r["first_id"]) for r in schedule.conflicts(df.withColumnRenamed("n", "m"), ["g", "m"], "o").collect()] == [(1, "a", 2, 1)]
    with pytest.raises(ValueError):
        schedule.conflicts(df, ["g", "n"], "o")
    days = spark.createDataFrame([(1, 3), (5, 2), (None, 4)], "a int, b int")
    assert schedule.expand_recurrence(days, F.col("a"), F.col("b"), F.lit(1), "d").count() == 3
    assert schedule.machine_faults(spark.createDataFrame([], "m long, from_state string, to_state string"), "m", "x").count() == 0


def test_validate(spark):
    child, parent = spark.createDataFrame([(1, 5), (2, None), (3, 9), (3, 9)], "id long, fk long"), spark.createDataFrame([(5, 0), (5, 0), (None, 0)], "pk long, fk long")
    assert [r["fk"] for r in validate.dangling(child, "fk", parent, "pk").collect()] == [9, 9]
    assert validate.orphans(parent, "pk", child, "fk").count() == 1
    assert validate.issues(child, "id", [("r", "error", F.col("fk") > 7)]).count() == 2
    population = {r["field"]: (r["populated"], r["total"]) for r in validate.field_population(spark.createDataFrame([("", 0.0), (None, None), ("x", 1.0)], "a string, b double"), ["a", "b"]).collect()}
    assert population == {"a": (1, 3), "b": (1, 3)}
    study = "id long, study struct<versions:array<struct<titles:array<string>,studyIdentifiers:array<string>,studyDesigns:array<struct<scheduleTimelines:array<string>,eligibilityCriteria:array<string>,objectives:array<string>>>>>>"
    found = validate.study_conformance(spark.createDataFrame([(1, None), (2, (None,)), (3, ([],)), (4, ([(["t"], None, None), (["t"], ["i"], [(["x"], ["x"], []), (["x"], ["x"], ["x"])])],))], study), "id", "study").collect()
    assert {(r["id"], r["rule"], r["version"], r["design"]) for r in found} == {(1, "USDM001", None, None), (1, "USDM002", None, None), (2, "USDM002", None, None), (3, "USDM002", None, None), (4, "USDM011", 0, None), (4, "USDM020", 0, None), (4, "USDM032", 1, 0)}


def test_pages(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "Schedule of activities, visit, visit")], "p long, t string")
    assert [r["s"] for r in df.select(pages.page_score(F.col("t"), ["schedule of activities"], ["visit"]).alias("s")).collect()] == [0.0, 0.0, 3.0]
    gaps = spark.createDataFrame([(1, 2), (1, 2), (1, 5)], "g long, p int")
    assert sorted(r["p"] for r in pages.fill_gaps(gaps, "g", "p", 1, F.lit(9)).collect()) == [1, 2, 3, 4, 5, 6]


def test_reconcile(spark):
    df = spark.createDataFrame([(1, "a", 10, 1, {"x": 1, "y": 1}), (1, "b", 20, 1, {"x": 2}), (1, "c", 5, 1, None), (2, "a", 10, 1, None)], "k long, source string, priority int, pos long, m map<string,int>")
    got = {r["k"]: r["m"] for r in reconcile.reconcile(df, ["k"], {"m": "map"}).collect()}
    assert got == {1: {"x": 1, "y": 1}, 2: None}
    epochs = spark.createDataFrame([(1, "e7", 1, ["epoch_2", "e7", "none"]), (1, "e8", 2, ["epoch_2", "e7", "none"]), (2, "e9", 1, None)], "g long, id string, o long, s array<string>")
    assert {(r["id"], r["sequence_order"], r["category"]) for r in reconcile.contribute_traversal(epochs, "g", "id", "o", "s").collect()} == {("e8", 1, "main"), ("e7", 2, "main")}


def test_answers(spark):
    cases = [('{"a": [1, 2', "]}", '{"a": [1, 2]}'), ('{"a": {"b": 1}', '{"c": 2}}', '{"a": {"b": 1},\n{"c": 2}}'), ("01234567890123456789a", "0123456789abcdefghijk", "01234567890123456789abcdefghijk"), ("[1,", "```json\n2]\n```", "[1,2]"), (None, "x", "x"), ("x", None, "x"), ("", "", "")]
    df = spark.createDataFrame([c[:2] for c in cases], "a string, b string")
    assert [r["m"] for r in df.select(T.continued_json(F.col("a"), F.col("b")).alias("m")).collect()] == [c[2] for c in cases]
    shapes = [(None, "Missing 'activities' key in response"), ("[]", "Missing 'activities' key in response"), ('{"activities": null}', "'activities' must be an array"), ('{"activities": [{"id": 1, "name": "x"}]}', None), ('{"activities": [null]}', "Activity 0 is not an object")]
    df = spark.createDataFrame([(s,) for s, _ in shapes], "s string")
    assert [r["f"] for r in df.select(T.response_fault(F.col("s")).alias("f")).collect()] == [f for _, f in shapes]
    df = spark.createDataFrame([('{"b": 1, "a": [2, {"d": 1, "c": null}]}',), ('{"a":[2,{"c":null,"d":1}],"b":1}',), ("{",), (None,)], "s string")
    assert [r["c"] for r in df.select(T.canonical_json(F.col("s")).alias("c")).collect()] == ['{"a":[2,{"c":null,"d":1}],"b":1}'] * 2 + [None, None]


def test_best_candidates(spark):
    same = lambda a, b: 0.0 if a is None or b is None else len(set(a) & set(b)) / max(1, len(set(a) | set(b)))
    golden = spark.createDataFrame([(1, 1, "abc"), (1, 2, "abd"), (1, 3, None), (1, 4, "xyz"), (2, 1, "q"), (None, 1, "k")], "g long, o long, t string")
    found = spark.createDataFrame([(1, 7, "abd"), (1, 5, "ab"), (1, 6, "ab"), (1, 8, None), (3, 1, "q"), (None, 9, "kl")], "g long, o long, t string")
    got = {(r["g"], r["o"]): (r["match"], round(r["score"], 3)) for r in match.best_candidates(golden, found, "g", "o", "t", same).collect()}
    assert got == {(1, 1): (5, 0.667), (1, 2): (7, 1.0), (1, 3): (None, 0.0), (1, 4): (None, 0.0), (2, 1): (None, 0.0), (None, 1): (9, 0.5)}
    assert match.best_candidates(golden.limit(0), found, "g", "o", "t", same).count() == 0
    one = match.best_candidates(found.filter("o < 7"), found.filter("o >= 7"), "g", "o", "t", same)  # both of one table
    assert {(r["g"], r["o"], r["match"]) for r in one.collect()} == {(1, 5, 7), (1, 6, None), (3, 1, None)}


def test_stored_stream_goes_on(spark, tmp_path):
    source, schema = f"{tmp_path}/in", "k long, source string"
    spark.createDataFrame([(1, "text"), (2, "text"), (None, "text")], schema).write.parquet(source)
    stream = spark.readStream.schema(schema).parquet(source)
    once = stored_stream(stream, ["k"], f"{tmp_path}/out", f"{tmp_path}/cp")
    assert {tuple(r) for r in once.collect()} == {(1, "text"), (2, "text"), (None, "text")}
    spark.createDataFrame([(1, "vision"), (3, "vision")], schema).write.mode("append").parquet(source)
    again = stored_stream(stream, ["k"], f"{tmp_path}/out", f"{tmp_path}/cp")
    assert {tuple(r) for r in again.collect()} == {(1, "both"), (2, "text"), (3, "vision"), (None, "text")}


def test_nearest_vectors(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 5))
    x[7], x[9], x[11] = x[5], 2 * x[5], 0
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(60, None)]
    df = spark.createDataFrame(rows, "k long, v array<double>")
    u = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    c = np.round(u @ u.T, 12)
    np.fill_diagonal(c, -2)
    c[:, 11] = -2
    for block in (4096, 7):
        got = {r["id"]: (r["best"], round(r["cosine"], 9)) for r in match.nearest_vectors(df.filter("k % 5 = 0 OR k = 11"), df, "k", "v", block).collect()}
        assert got == {i: (int(c[i].argmax()), round(float(c[i].max()), 9)) for i in range(0, 60, 5)}
    assert match.nearest_vectors(df.limit(0), df, "k", "v").count() == 0

"""Nulls, empty tables and ties of the comparing operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from studygraph.operators import compare


def test_domain_pages(spark):
    rows = spark.createDataFrame([(1, "A Visit window and a DOSE"), (2, None), (3, ""), (4, "visit")], "id int, text string")
    got = compare.domain_pages(rows, ["id"], "text", {"visits": (("visit", "window"), 2), "doses": (("dose",), 1)})
    assert sorted(map(tuple, got.collect())) == [(1, "doses", 1), (1, "visits", 2)]
    assert compare.domain_pages(rows.limit(0), ["id"], "text", {"visits": (("visit",), 1)}).count() == 0


def test_valid_note(spark):
    notes = [None, "", "Fasting before the sample", "FASTING BEFORE THE SAMPLE", "page 3 fasting before it", "x" * 801, "a remark with no word of any list", "a remark with no word of any list, but of more than fifty characters"]
    rows = spark.createDataFrame(list(enumerate(notes)), "pos int, note string")
    got = rows.select("pos", compare.valid_note(F.col("note"), ["fasting"], ["page "]).alias("valid")).orderBy("pos").collect()
    assert [r["valid"] for r in got] == [False, False, True, False, False, False, False, True]


def test_merge_notes(spark):
    schema = "doc int, marker string, note string, origin string"
    first = spark.createDataFrame([(1, "A", "one", "x")], schema)
    second = spark.createDataFrame([(1, "a", "two", "x"), (1, "b", "three", "x"), (2, "a", "four", "x"), (2, None, "five", "x")], schema)
    got = compare.merge_notes(first, second, "doc", "marker", "note")
    assert {(r["doc"], r["note"], r["origin"]) for r in got.collect()} == {(1, "one", "first"), (1, "three", "second"), (2, "four", "second"), (2, "five", "second")}


def test_compare_three(spark):
    def side(rows):
        return spark.createDataFrame(rows, "k int, v string")

    got = compare.compare_three(side([(1, "a"), (2, "a"), (3, "a"), (4, None)]), side([(1, "a"), (2, "a"), (5, "z")]), side([(1, "a"), (3, "b"), (4, None)]), ["k"], "v")
    assert {r["k"]: r["verdict"] for r in got.collect()} == {1: "same", 2: "dropped", 3: "changed", 4: "same", 5: "extra"}
    assert compare.compare_three(side([(1, "a")]), side([]), side([]), ["k"], "v").collect()[0]["verdict"] == "lost"


def test_standard_ids(spark):
    got = compare.standard_ids(spark.createDataFrame([("act-1", "x-y"), (None, "x-y")], "id string, name string"), ["id"])
    assert [(r["id"], r["name"]) for r in got.collect()] == [("act_1", "x-y"), (None, "x-y")]

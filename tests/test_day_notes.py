"""Footnotes and days: rows worked out by hand."""

from __future__ import annotations

import itertools
import random
import re
import time

from pyspark.sql import functions as F

from studygraph.operators import days, notes
from studygraph.plans import day_notes


def rows_of(spark, texts):
    return spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], "k long, label string, marker string, days string")


def test_layouts(spark):
    got = {}
    for r in notes.footnote_conditions(rows_of(spark, [*day_notes.LAYOUT_PASSAGES, None]), "label", ["k"]).collect():
        got.setdefault(r["k"], {})[r["nth"]] = tuple(r)[2:]
    wocbp = "subject.sex == 'Female' AND subject.isOfChildbearingPotential == true"
    assert list(got[0].values()) == [("a", "Collected 30 minutes before the first dose", "timing_before", 0.9, "PT30M", "timing.before(the first dose, PT30M)"), ("b", "Only for women of childbearing potential", "eligibility_wocbp", 0.95, None, wocbp)]
    assert list(got[1].values()) == [("[a]", "Performed in triplicate at each visit", "timing_recurring", 0.85, None, None), ("[b]", "Fasting for at least 10 hours is required", "procedure_fasting", 0.9, None, "subject.isFasting == true")]
    assert list(got[2].values()) == [("^a", "After 12-hour fast as the plan says", "timing_after", 0.8, None, None), ("^b", "Vital signs 2 hours after dosing", "timing_after", 0.9, "PT2H", "timing.after(dosing, PT2M)")]
    assert list(got[3].values()) == [("1", "Samples are collected at weeks 4, 8 and 12", "procedure_timepoints", 0.85, None, None), ("2", "Only in subjects aged 65 years and older", "eligibility_age", 0.85, None, "subject.age >= 65")]
    assert [(m, n[:12], k) for m, n, k, *_ in got[4].values()] == [("a", "Daily weight", "frequency_daily"), ("b", "If clinicall", "procedure_conditional")]
    assert [m for m, *_ in got[5].values()] == ["a"] and got[5][1][2:4] == ("frequency_daily", 0.9)
    assert set(got) == {0, 1, 2, 3, 4, 5}


def test_sections_and_noise(spark):
    texts = ["Notes to table\nfirst part that has no mark\na. the part that has a mark", "a. " + "long " * 200 + "\nb. Page 7 of the whole protocol visit", "a. SAMPLES ARE COLLECTED AT VISIT\nb. 123456789012345678 day\nc. nothing that counts", "ᵃb Samples after each visit ˢd: x"]
    found = {r["k"]: [(x["marker"], x["note"]) for x in r["f"]] for r in rows_of(spark, [*texts, None, ""]).select("k", notes.footnotes(F.col("label")).alias("f")).collect()}
    assert found[0] == [("a", "the part that has a mark"), ("fn_2", "first part that has no mark"), ("a", "the part that has a mark"), ("a", "the part that has a mark")]
    assert [m for m, _ in found[1]] == ["b", "b"] and found[4] == found[5] == []
    assert found[3] == [("^b", "Samples after each visit")]
    kept = notes.footnote_conditions(rows_of(spark, texts), "label", ["k"]).collect()
    assert [(r["k"], r["marker"]) for r in sorted(kept, key=lambda r: (r["k"], r["nth"]))] == [(3, "^b")]
    assert notes.footnote_conditions(rows_of(spark, texts).limit(0), "label", ["k"]).count() == 0


def test_long_notes_take_time_in_proportion(spark):
    """Of a sequence one character on either side is looked for, as .+ takes the square of a note's length."""
    old = (r"(.+)\s+(?:then|followed\s+by)\s+(.+)", r"(.+)\s+(?:before|prior\s+to)\s+(.+)\s+(?:before|prior\s+to)\s+(.+)")
    new = [p for p, kind, _ in notes.TIMING if kind == "sequence"]
    random.seed(7)
    parts = ["then", "followed", "by", "before", "prior", "to", " ", " ", "  ", "\n", "x"]
    for text in ["".join(random.choices(parts, k=9)) for _ in range(5000)]:
        assert [bool(re.search(p, text)) for p in new] == [bool(re.search(p, text)) for p in old], text
    raised = rows_of(spark, [chr(c) for c in range(32, 0x2200)]).select(F.col("label").rlike(notes.RAISED).alias("a"), F.col("label").rlike(notes.RAISED_FAST).alias("b")).filter("a OR b").collect()
    assert len(raised) == len(notes.RAISED) - 3 and all(r["a"] and r["b"] for r in raised)
    rows = rows_of(spark, ["word " * 60000 + end for end in ("", "first then next", "daily")])
    began = time.perf_counter()
    got = [tuple(r["c"])[:2] for r in rows.select("k", notes.condition(F.col("label")).alias("c")).orderBy("k").collect()]
    assert got == [("general", 0.5), ("sequence", 0.85), ("frequency_daily", 0.9)] and time.perf_counter() - began < 60


def test_days(spark):
    rows = rows_of(spark, [*day_notes.DAY_PASSAGES, None, "Stool sample " + "x" * 250 + " days 1 to 2, daily diary day 9999999999999999999 to 3"])
    got = sorted((r["k"], r["activity"], r["days"]["start"], r["days"]["end"], r["expected"], r["start_offset"], r["end_offset"], r["source"]) for r in days.daily_bindings(rows, "label", ["k"]).collect())
    assert got == [
        (0, "urine_collection", -4, -1, 4, "-P4D", "-P1D", "Daily urine collection (Days -4 through -1)"), (0, "urine_collection", 2, 3, 2, "P2D", "P3D", "Daily urine collection (days 2-3)"),
        (3, "balance_collection", -6, -2, 5, "-P6D", "-P2D", "Copper balance (day –6 through –2)"), (3, "balance_collection", 1, 5, 5, "P1D", "P5D", "Copper balance (day 1 to day 5)"),
        (3, "controlled_meal", -6, -2, 5, "-P6D", "-P2D", "Controlled meal (day –6 through –2)"), (3, "controlled_meal", 1, 5, 5, "P1D", "P5D", "Controlled meal (day 1 to day 5)"),
        (4, "daily_weight", 1, 14, 14, "P1D", "P14D", "daily weight (1-14)"), (4, "daily_weight", 3, 1, 3, "P3D", "P1D", "daily weight (days 3 to 1)"),
        (9, "daily_diary", 1, 2, 2, "P1D", "P2D", "daily diary (days 1 to 2)"),
    ]
    windows = sorted((r["k"], r["kind"], r["days"]["start"], r["days"]["end"]) for r in days.analysis_windows(rows, "label", ["k"]).collect())
    assert windows == [(1, "baseline", -4, -1), (1, "steady_state", 15, 28), (1, "treatment", 1, 28), (4, "baseline", -7, -1), (4, "treatment", 1, 14)]
    found = {r["k"]: r["d"] for r in rows.select("k", days.collection_day(F.col("label")).alias("d")).collect()}
    assert (found[2], found[5], found[0], found[8]) == ("collection day begins 8:00 am", "Morning of day 1 to morning of day 2", None, None)
    assert days.daily_bindings(rows.limit(0), "label", ["k"]).count() == days.analysis_windows(rows.limit(0), "label", ["k"]).count() == 0


def test_repetitions(spark):
    rows = rows_of(spark, [*day_notes.REPEAT_PASSAGES, None])
    got = sorted(((r["k"], r["kind"], r["match"], r["interval"], r["observations"], r["cycle_length"], r["start_offset"], r["end_offset"], r["exit_condition"]) for r in days.repetition_details(rows, "label", ["k"]).collect()), key=repr)
    none = (None, None, None)
    for row in (
        (0, "Daily", "Daily urine", "P1D", None, None, "P2D", "P5D", None), (0, "Interval", "every 15 min", "PT15M", None, *none, None), (0, "Interval", "every 2 hours", "PT2H", None, *none, None),
        (0, "Continuous", "days 2 to 5", None, None, None, "P2D", "P5D", None), (1, "Cycle", "21-day cycle", None, None, "P21D", None, None, "Disease progression"), (1, "Cycle", "until disease progression", None, None, *none, "Disease progression"),
        (2, "Interval", "at 5, 10 minutes", "PT5M", 2, *none, None), (3, "Continuous", "from day -4 to day 2", None, None, None, "-P4D", "P2D", None), (3, "Continuous", "weeks 4 through 8", None, None, None, "P4D", "P8D", None),
    ):
        assert row in got, row
    assert {r[0] for r in got} <= {0, 1, 2, 3}
    places = rows.filter("k = 0").select(F.explode(days.finds(F.col("label"), r"(?i)every\s+\d+")).alias("f")).select("f.*").collect()
    assert [(r["place"], r["match"]) for r in places] == [(day_notes.REPEAT_PASSAGES[0].index("every 15"), "every 15"), (day_notes.REPEAT_PASSAGES[0].index("every 2"), "every 2")]


def test_intervals_meet(spark):
    random.seed(3)
    sides = []
    for _ in range(2):
        sides.append([(random.choice([1, 2, None]), i, (a, a + random.randrange(-40, 90)) if random.random() < 0.95 else (a, None)) for i in range(60) for a in [random.randrange(-200, 200)]])
    frames = [spark.createDataFrame(s, "k int, id int, days struct<start: long, end: long>") for s in sides]
    got = sorted((r["id"], r["right_id"], r["relation"]) for r in days.interval_join(*frames, ["k"]).collect())
    want = []
    for (k, i, d), (m, j, e) in itertools.product(*sides):
        if k is not None and k == m and None not in (*d, *e):
            (a, b), (c, f) = sorted(d), sorted(e)
            if a <= f and c <= b:
                want.append((i, j, "equal" if (a, b) == (c, f) else "within" if a >= c and b <= f else "contains" if a <= c and b >= f else "overlaps"))
    assert got == sorted(want) and len(got) > 50
    assert days.interval_join(frames[0].limit(0), frames[1], ["k"]).count() == 0

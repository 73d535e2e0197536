"""Queries that do the whole job, against brute force over the small tables."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import combinations

from studygraph import plans
from studygraph.operators import match
from tests.test_queries import DATA


def rows(spark, name, *columns):
    return spark.read.parquet(f"{DATA}/{name}.parquet").select(*columns).collect()


def test_faults_between_any_events(spark, tmp_path):
    events = [(1, 1, "view", "2024-01-01"), (2, 1, "click", "2024-01-02"), (3, 1, "error", "2024-01-03"), (4, 2, "signup", "2024-01-01"), (6, 2, "view", "2024-01-02")]
    spark.createDataFrame(events, "event_id long, user_id long, event_type string, ts string").selectExpr("event_id", "user_id", "event_type", "CAST(ts AS timestamp) AS ts").write.parquet(f"{tmp_path}/events.parquet")
    got = {tuple(r) for r in plans.queries()["state_reachability"](spark, str(tmp_path)).collect()}
    assert got == {(1, "error", "dead_end"), (2, "signup", "unreachable"), (2, "view", "dead_end")}


def test_every_reference_is_rewritten(spark):
    parts = {r[0] for r in rows(spark, "part", "p_partkey")}
    refs = defaultdict(Counter)
    for order, part in rows(spark, "lineitem", "l_orderkey", "l_partkey"):
        if part % 3 and part in parts:
            refs[order][f"part_{part}"] += 1
    got = {r["o_orderkey"]: Counter(filter(None, r["refs"].split(","))) for r in plans.queries()["reference_rewrite"](spark, DATA).collect()}
    assert got == {r[0]: refs[r[0]] for r in rows(spark, "orders", "o_orderkey")}
    assert any(k % 10 and v for k, v in got.items())


def test_no_user_vanishes(spark):
    assert {r["user_id"] for r in plans.queries()["clinical_epoch_type"](spark, DATA).collect()} == {r[0] for r in rows(spark, "events", "user_id")}


def test_near_sets_as_all_pairs(spark):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(60)]
    sets = []
    for _ in range(60):
        base = rng.sample(vocabulary, rng.randint(1, 20))
        sets += [base, rng.sample(base, len(base)), [*base, "0first"], base[1:] or ["a"], [*base[1:], "!x"]]
    got = sorted(map(tuple, match.near_sets(spark.createDataFrame([*enumerate(sets), (999, None)], "id long, w array<string>"), "id", "w", 80).collect()))
    rep = {}
    for k, w in enumerate(sets):
        rep.setdefault(frozenset(w), k)
    want = [(rep[frozenset(w)], k, 1.0) for k, w in enumerate(sets) if rep[frozenset(w)] != k]
    want += [(min(rep[x], rep[y]), max(rep[x], rep[y]), len(x & y) / len(x | y)) for x, y in combinations(rep, 2) if len(x & y) > 0.8 * len(x | y)]
    assert got == sorted(want)


def test_contained_as_all_pairs(spark):
    rng = random.Random(7)
    hays = [(k, "".join(rng.choice("abAé \n") for _ in range(rng.randint(0, 60)))) for k in range(60)] + [(99, None), (100, "Visit 12 screening  day and follow-up of the whole study")]
    needles = [(k, "".join(rng.choice("abAé  ") for _ in range(rng.randint(0, 9)))) for k in range(200)]
    needles += [(k, t) for k, (_, h) in enumerate(hays[:60], 300) for t in [h[5:30]]] + [(400, "reenin"), (401, "isit 12"), (402, "screening  d"), (403, "llow-up of"), (404, "screening d"), (405, None), (406, "and follow-up of the whole stu")]
    got = sorted(map(tuple, match.contained(spark.createDataFrame(needles, "n long, text string"), spark.createDataFrame(hays, "h long, text string"), "n", "h").collect()))
    assert got == sorted((n, h) for n, t in needles for h, s in hays if t is not None and s is not None and t in s)
    assert {n for n, h in got if h == 100 and n >= 400} == {400, 401, 402, 403, 406}

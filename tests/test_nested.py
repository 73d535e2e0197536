from __future__ import annotations

import json
import time
import uuid
from collections import deque

from pyspark.sql import functions as F

from studygraph.functions.text import stable_id
from studygraph.operators import nested, reach


def converted(value, new):
    """The same by a walk over parsed JSON."""
    simple = lambda v: isinstance(v, str) and ("_" in v or "-" in v) and len(v) < 50 and not is_uuid(v)
    if isinstance(value, list):
        return [converted(x, new) for x in value]
    if not isinstance(value, dict):
        return value
    out = {}
    for k, v in value.items():
        if (k == "id" or k.endswith("Id")) and simple(v):
            out[k] = new(v)
        elif k.endswith("Ids") and isinstance(v, list) and not any(isinstance(x, dict | list) for x in v):
            out[k] = [new(x) if simple(x) else x for x in v]
        elif k == "valueString" and isinstance(v, str) and v[:1] in ("[", "{"):
            try:
                out[k] = json.dumps(converted(json.loads(v), new))
            except ValueError:
                out[k] = v
        else:
            out[k] = converted(v, new) if isinstance(v, dict | list) else v
    return out


def is_uuid(v):
    try:
        uuid.UUID(v)
    except ValueError:
        return False
    return True


def parsed(value):
    """JSON with the JSON inside valueStrings parsed too."""
    if isinstance(value, list):
        return [parsed(x) for x in value]
    if isinstance(value, dict):
        return {k: parsed(json.loads(v)) if k == "valueString" and isinstance(v, str) and v[:1] in ("[", "{") and can(v) else parsed(v) for k, v in value.items()}
    return value


def can(v):
    try:
        json.loads(v)
    except ValueError:
        return False
    return True


DEEP = {
    "id": "study_1", "name": "act_1", "valueString": "act_1", "other": ["act_1"],
    "a": {"b": [{"id": "act_1", "activityId": "act-2", "childIds": ["act_1", 7, "plain", None, "act-2"], "Ids": []}, [{"encounterId": "enc_1"}]]},
    "said": 'text with "id": "act_1" and \\ "xId":"act_1" inside', "uuidId": "6ba7b810-9dad-11d1-80b4-00c04fd430c8", "longId": "x_" * 30, "emptyId": "", "nullId": None, "numberId": 3,
    "ext": [{"valueString": json.dumps([{"activityId": "act_1", "valueString": json.dumps({"id": "act_1", "t": 'a "quoted" \\ \n text'})}])}, {"valueString": "[not json"}, {"valueString": "{\"id\": \"q\\\"_1\"}"}],
    "quoteId": 'q"_1', "listIds": [{"id": "in_list", "fooId": "act_1"}],
}


def test_ids_at_any_depth(spark):
    texts = [json.dumps(DEEP), json.dumps(DEEP, indent=2), json.dumps([DEEP, DEEP]), "{}", "null", "", None, "no json at all \"id\"", json.dumps({"valueString": json.dumps([{"id": f"n_{i}", "text": 'say "\\"'} for i in range(3000)])})]
    frame = spark.createDataFrame([(i, t, "", 0) for i, t in enumerate(texts)], "k long, doc string, uuid string, value int")
    got = {r["k"]: r["doc"] for r in nested.with_uuids(frame, "k", "doc").collect()}
    known = {(r["k"], r["simple_id"]): r["uuid"] for r in nested.id_mapping(frame, "k", "doc").collect()}
    assert len(set(known.values())) == len(known) and all(is_uuid(u) for u in known.values())
    for k in (0, 1, 2, 8):
        assert parsed(json.loads(got[k])) == parsed(converted(json.loads(texts[k]), lambda v: known[k, v]))
    assert {s for k, s in known if k == 0} == {"study_1", "act_1", "act-2", "enc_1", 'q"_1', "in_list"}
    assert [got[k] for k in (3, 4, 5, 6, 7)] == texts[3:8]
    again = nested.with_uuids(nested.with_uuids(frame, "k", "doc"), "k", "doc")
    assert {r["k"]: r["doc"] for r in again.collect()} == got
    assert nested.with_uuids(frame.limit(0), "k", "doc").count() == nested.id_mapping(frame.limit(0), "k", "doc").count() == 0


def test_strings_as_spark_takes_them(spark):
    """What the scan takes for JSON in a string is what Spark takes for it."""
    inner = ["[1] x", '{"a": 1, "a": 2}', '{"a": {"b": 1, "b": 2}}', "[NaN]", "[-Infinity]", "[01]", "[1,]", "{'a': 1}", '["\t"]', "[1e999]", "[" + "9" * 60 + "]", "[]", "{", '["\\ud800"]', '["é\u2028"]', '[{"id": "a_1"}]']
    tokens = [json.dumps(x) for x in inner] + ['"\\x"', '"\\u12"', '"a\tb\\n"', '"\\ud83d\\ude00 \\ud800"', '"\\/ \\b\\f\\u001F\\u000b\\u007f"']
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(tokens)], "i int, t string")
    told = rows.select("i", F.from_json(F.concat(F.lit('{"x":'), "t", F.lit("}")), "x string")["x"].alias("v")).select("i", "v", F.try_parse_json("v").isNotNull().alias("json"), F.to_json(F.struct(F.col("v").alias("x"))).alias("q"))
    for r in told.orderBy("i").collect():
        assert nested._unquoted(tokens[r["i"]]) == r["v"], r
        if r["v"] is not None:
            assert nested._quoted(r["v"]) == r["q"][5:-1], r
            assert (nested._inner(tokens[r["i"]]) is not None) == (r["json"] and r["v"][:1] in ("[", "{")), r


def test_many_ids_in_one_document(spark):
    """Distinct ids of a document are found by hashing: time grows with their number, not with its square."""
    doc = json.dumps([{"id": f"n_{i}", "upId": f"n_{i + 1}"} for i in range(60000)])
    frame = spark.createDataFrame([(1, doc)], "k long, doc string")
    began = time.perf_counter()
    got = nested.reference_report(frame, "k", "doc").collect()
    assert [(r["n_ids"], r["n_references"], r["unresolved"]) for r in got] == [(60000, 60000, ["n_60000"])]
    assert time.perf_counter() - began < 30


def test_variants_and_scopes(spark):
    frame = spark.sql("""SELECT k, parse_json(t) AS doc FROM VALUES (1, '{"id": "a_1", "bId": "b_1"}'), (1, '{"id": "b_1"}'), (2, '{"cId": "a_1"}'), (NULL, '{"id": "a_1"}'), (3, NULL) AS v(k, t)""")
    got = nested.with_uuids(frame, "k", "doc")
    assert got.schema == frame.schema
    rows = sorted((r["k"] or 0, r["n_ids"], r["n_references"], len(r["unresolved"])) for r in nested.reference_report(got, "k", "doc").collect())
    assert rows == [(0, 1, 0, 0), (1, 2, 1, 0), (2, 0, 1, 1)]
    ids = {(r["k"], r["simple_id"]): r["uuid"] for r in nested.id_mapping(frame, "k", "doc").collect()}
    assert len(ids) == 4 == len(set(ids.values()))
    assert ids[1, "a_1"] == spark.range(1).select(stable_id(F.lit(1), F.lit("a_1"))).first()[0]


def distances(edges, starts):
    out = {s: 0 for s in starts}
    todo = deque(out)
    while todo:
        s = todo.popleft()
        for m, a, b in edges:
            if (m, a) == s and (m, b) not in out:
                out[m, b] = out[s] + 1
                todo.append((m, b))
    return out


def test_states_at_any_distance(spark):
    ring = [(1, i, (i + 1) % 25) for i in range(25)]
    edges = ring + [(1, 3, 100), (1, 100, 101), (1, 101, 100), (1, 200, 3), (1, 200, 200), (2, 1, 2), (2, 2, 3), (2, 1, 2), (3, 5, 5), (None, 1, 2), (1, None, 4)]
    schema = "machine int, from_state int, to_state int"
    frame = spark.createDataFrame(edges, schema).selectExpr("*", "0 AS hops", "1 AS state")
    starts, ends = [(1, 0), (2, 1), (1, 0), (9, 9), (None, 1)], [(1, 20), (2, 3), (8, 8)]
    initial, terminal = (spark.createDataFrame(x, "machine int, state int") for x in (starts, ends))
    got = {(r["machine"], r["state"]): (r["hops"], r["hops_to_end"], r["issue"]) for r in reach.state_paths(frame, initial, terminal).collect()}
    real = [e for e in edges if None not in e]
    there, back = distances(real, [s for s in starts if None not in s]), distances([(m, b, a) for m, a, b in real], ends)
    assert {k: v[:2] for k, v in got.items()} == {k: (there.get(k), back.get(k)) for k in got}
    issues = {k: v[2] for k, v in got.items()}
    assert issues[1, 100] == issues[1, 101] == "dead end" and issues[1, 200] == "unreachable" and issues[3, 5] == issues[9, 9] == "no terminal states" and issues[8, 8] == "unreachable"
    assert [k for k, v in issues.items() if v is None and k[0] == 1] and issues[1, 24] is None and got[1, 24][:2] == (24, 21)
    assert reach.reached(frame.limit(0), initial).count() == 3 and reach.reached(frame, initial.limit(0)).count() == 0


def test_only_keys_of_lines_are_exchanged(spark):
    from studygraph.plans.nested import order_documents

    plan = order_documents(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    gathered = [x for x in plan.splitlines() if "partial_collect_list" in x]
    assert gathered and not any("part-" in x for x in gathered)


def test_documents_are_made_without_json(spark):
    """Documents become VARIANT from their fields: only the notes, which are text, are JSON on the way."""
    from studygraph.plans.nested import order_documents

    plan = order_documents(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "to_variant_object" in plan and "parseJson" not in plan


def test_documents_are_read_without_json(spark):
    """Documents are read back from VARIANT: only with_uuids() makes JSON of them."""
    from studygraph import plans

    plan = plans.queries()["nested_ids"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1 and "to_variant_object" in plan and "variant_get" in plan

from __future__ import annotations

import glob
import json

import pytest
from pyspark.sql import functions as F

from studygraph.operators import assemble
from studygraph.sources import model, tables
from studygraph.streaming import provenance


def test_sites(spark, tmp_path):
    (tmp_path / "x_sites.csv").write_text("Site Number,Site Name,Country,City,State,PI Name,PI Email,Status,Target Enrollment\n001,Alpha,US,Ames,IA,Dr. Ann Lee,a@x.org,Active,12\n002,Research Site,,Rome,nan,,,Closed,x\n")
    sites = tables.read_sites(spark, str(tmp_path))
    made = tables.site_entities(sites)
    assert [tuple(r) for r in made["site"].orderBy("id").collect()] == [("site_001", "Alpha", "Active", 12, "org_001"), ("site_002", "Research Site", "Closed", None, "org_002")]
    assert [tuple(r)[:4] for r in made["person"].collect()] == [("person_001", "Ann", "Lee", "a@x.org")]
    assert made["organization"].filter("country IS NULL AND state IS NULL").count() == 1


def test_json_results(spark, tmp_path):
    for i, s in enumerate((True, False, None)):
        (tmp_path / f"{i}.json").write_text(json.dumps({"success": s, "v": i} if s is not None else {"v": i}))
    assert sorted(r["v"] for r in tables.read_phase_results(spark, str(tmp_path)).collect()) == [0, 2]
    (tmp_path / "u").mkdir()
    (tmp_path / "u/token_usage.json").write_text(json.dumps({"by_phase": {"a": {"input": 1, "output": 2, "calls": 3}, "b": {"input": 4, "output": 5, "calls": 6}}}))
    assert sorted(tuple(r)[1:] for r in tables.token_usage(spark, str(tmp_path / "u")).collect()) == [("a", 1, 2, 3), ("b", 4, 5, 6)]


def test_pages_and_files(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"one\x0ctwo")
    got = tables.read_pages(spark, str(tmp_path), lambda c: c.decode().split("\x0c")).orderBy("page_no").collect()
    assert [(r["page_no"], r["text"]) for r in got] == [(1, "one"), (2, "two")]
    paths = spark.createDataFrame([("/t/a/P.pdf",), ("/t/a/p_SAP.pdf",), ("/t/a/a_sites.csv",), ("/t/a/x.txt",)], "path string")
    assert {r["kind"]: r["path"] for r in tables.trial_files(paths).collect()} == {"protocol": "/t/a/P.pdf", "sap": "/t/a/p_SAP.pdf", "sites": "/t/a/a_sites.csv"}


def test_sinks_and_cache(spark, tmp_path):
    df = spark.createDataFrame([(1, "x" * 150, ["a", "b"]), (2, None, [])], "id int, text string, tags array<string>")
    tables.write_csv(df, str(tmp_path / "c"))
    back = spark.read.csv(str(tmp_path / "c"), header=True).orderBy("id").collect()
    assert len(back[0]["text"]) == 100 and back[0]["tags"] == "a; b"
    tables.write_documents(df, str(tmp_path / "d"))
    rows = [json.loads(line) for f in glob.glob(str(tmp_path / "d/part*")) for line in open(f)]
    assert {"id": 2, "tags": []} in rows
    assert "| a | 2 |" in tables.markdown(spark.createDataFrame([("a", 2), ("b", 1)], "kind string, n long"), "T")
    asked = spark.createDataFrame([("p",), ("q",), ("r",)], "prompt string")
    none = spark.createDataFrame([], "hash string, cached_at timestamp")
    hashes = {r["prompt"]: r["hash"] for r in tables.misses(asked, none, ["prompt"], F.current_timestamp()).collect()}
    cache = spark.createDataFrame([(hashes["p"], 1), (hashes["q"], 40)], "hash string, age int").select("hash", (F.current_timestamp() - F.make_dt_interval("age")).alias("cached_at"))
    assert {r["prompt"] for r in tables.misses(asked, cache, ["prompt"], F.current_timestamp()).collect()} == {"q", "r"}
    runs = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, run int, v string")
    assert {r["v"] for r in tables.latest_run(runs, ["k"], "run").collect()} == {"y", "z"}


def test_model(spark):
    prompts = spark.createDataFrame([(1, "page of SoA"), (2, "other"), (3, "fail"), (4, "page of SoA")], "id int, prompt string")

    def call(prompt):
        if prompt == "fail":
            raise ValueError("no")
        return model.canned({"SoA": '{"yes": 1}'})(prompt)

    got = {r["id"]: (r["response"], r["error"]) for r in model.ask(prompts, call).collect()}
    assert got == {1: ('{"yes": 1}', None), 2: ("{}", None), 3: (None, "ValueError: no"), 4: ('{"yes": 1}', None)}
    waits, tries = [], []

    def flaky(prompt):
        tries.append(prompt)
        if len(tries) < 3:
            raise OSError
        return "ok"

    assert model.with_retry(flaky, sleep=waits.append)("x") == "ok" and waits == [5.0, 10.0]
    with pytest.raises(OSError):
        model.with_retry(lambda p: (_ for _ in ()).throw(OSError()), sleep=waits.append)("x")


TIMELINE = {
    "activities": [{"id": "a1", "name": "ECG"}, {"activityId": "a2", "name": "Blood"}],
    "plannedTimepoints": [{"id": "pt_1", "encounterId": "enc_1"}],
    "encounters": [{"id": "enc_1", "name": "Day 1", "epochId": "ep_9"}, {"id": "enc_2", "name": "Day 8", "epochId": "ep_2"}],
    "epochs": [{"id": "ep_1", "name": "Screening"}, {"id": "ep_2", "name": "Treatment"}],
    "activityTimepoints": [{"activityId": "a1", "plannedTimepointId": "pt_1"}, {"activityId": "zz", "plannedTimepointId": "pt_1"}, {"activityId": "a2", "plannedTimepointId": "pt_7"}, {}],
}


def test_documents(spark):
    docs = spark.createDataFrame([("p", json.dumps({"study": {"versions": [{"timeline": TIMELINE}]}})), ("q", json.dumps({"timeline": TIMELINE})), ("r", "not json")], "protocol_id string, raw string")
    found = assemble.timelines(docs)
    assert sorted(tuple(r) for r in assemble.valid_ticks(found).collect()) == [("p", "a1", "pt_1"), ("q", "a1", "pt_1")]
    acts = assemble.entity(found, "activities", ["id", "activityId"])
    assert {(r["protocol_id"], r["id"]) for r in acts.collect()} == {("p", "a1"), ("p", "a2"), ("q", "a1"), ("q", "a2")}
    enc, ep = assemble.entity(found, "encounters", ["id"]), assemble.entity(found, "epochs", ["id"])
    assert {(r["id"], r["epochId"]) for r in assemble.first_epoch_fallback(enc, ep).collect()} == {("enc_1", "ep_1"), ("enc_2", "ep_2")}
    new = assemble.renamed_ids(enc, ["id"])
    assert new.filter("id LIKE 'enc%'").count() == 0 and new.select("protocol_id", "id").distinct().count() == 4
    names = enc.select("protocol_id", F.col("id").alias("old_id")).join(new.select("protocol_id", "pos", "id"), "protocol_id").limit(0)
    cells = spark.createDataFrame([("p", "a1|pt_1", "text")], "protocol_id string, key string, source string")
    assert assemble.rewritten_cells(cells, names.select("protocol_id", "old_id", "id")).collect()[0]["key"] == "a1|enc_1"
    assert assemble.default_cells(ep, ep).count() == 8
    studies = assemble.nested(spark.createDataFrame([("p",), ("s",)], "protocol_id string"), ep.select("protocol_id", "pos", "id", "name"), ["protocol_id"], "pos", "epochs")
    raw = {r["protocol_id"]: json.loads(r["raw"]) for r in assemble.documents_of(studies).collect()}
    assert raw["p"]["study"]["epochs"] == [{"id": "ep_1", "name": "Screening"}, {"id": "ep_2", "name": "Treatment"}] and raw["s"]["study"]["epochs"] == []
    listing = spark.createDataFrame([("a", json.dumps({"generated": "2026-01-01", "study": {"activities": [{"id": "1"}], "encounters": []}})), ("b", "{"), ("c", json.dumps({"generated": "2026-02-01", "study": {}}))], "protocol_id string, raw string")
    assert [(r["protocol_id"], r["activities"], r["encounters"]) for r in tables.protocol_listing(listing).collect()] == [("c", 0, 0), ("a", 1, 0)]


def test_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    spark.createDataFrame([("c1", "text"), ("c1", "vision"), ("c2", "text")], "cell string, source string").write.json(str(src / "a"))
    stream = spark.readStream.schema("cell string, source string").option("recursiveFileLookup", True).json(str(src))
    q = provenance.merged_stream(stream, ["cell"], "merged_tags", str(tmp_path / "cp"))
    q.awaitTermination()
    assert {(r["cell"], r["source"]) for r in spark.table("merged_tags").collect()} == {("c1", "both"), ("c2", "text")}

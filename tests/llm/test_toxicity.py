from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from studygraph.llm import arrays, queries, toxicity
from studygraph.llm.shared import table


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for s in np.unique(score):
        rank[score == s] = rank[score == s].mean()
    n1 = label.sum()
    return (rank[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(label) - n1))


def test_held_out(spark):
    data = "/root/testdata/sf0.1"
    got = queries.QUERIES["op7_toxicity_machine"](spark, data)
    assert got.count() == table(spark, data, "documents").count()
    rows = got.join(table(spark, data, "labels"), "doc_id").join(table(spark, data, "documents").select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert ((rows.score >= 0) & (rows.score <= 1)).all() and ((rows.score >= 0.5) == (rows.predicted == 1)).all()
    said, toxic = rows.predicted == 1, rows.toxic == 1
    print(auc(rows.score.to_numpy(), rows.toxic.to_numpy()), {k: (int((said & toxic)[v].sum()), int(toxic[v].sum()), int((said & ~toxic)[v].sum()), len(v)) for k, v in rows.groupby("lang").groups.items()})
    assert auc(rows.score.to_numpy(), rows.toxic.to_numpy()) > 0.9
    assert (said & toxic).sum() >= 0.75 * toxic.sum()
    assert (said & ~toxic).sum() <= 0.01 * (~toxic).sum()


def test_logits_are_those_of_all_pairs():
    rng = np.random.default_rng(1)
    w, v = rng.normal(size=6), rng.normal(size=(6, 3))
    at = np.array([0, 2, 3, 5])
    z, _ = toxicity.logits(np.zeros(4, int), at, 1, 0.3, w, v)
    want = 0.3 + w[at].sum() + sum(v[i] @ v[j] for a, i in enumerate(at) for j in at[a + 1 :])
    assert abs(z[0] - want) < 1e-9


def test_a_pair_counts_beyond_its_terms():
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append((" ".join(["x"] + ["insult"] * a + ["group"] * b + [f"w{rng.integers(50)}"]), int(a and b)))
    m = toxicity.fit([(b, y) for b, (_, y) in zip(toxicity.distinct_buckets(pa.array([t for t, _ in rows]), 16), rows, strict=True)], bits=16, steps=600)
    row, bucket = toxicity.buckets(pa.array(["x insult", "x group", "x insult group", "x"]), 16)
    at = m.slot[bucket]
    z, _ = toxicity.logits(row[at >= 0], at[at >= 0].astype(int), 4, m.bias, m.linear, m.factors)
    assert z[2] > 0 > max(z[0], z[1], z[3])


def test_terms_and_hashes():
    raw, offsets = arrays.text_bytes(pa.array(["Ab, cd", None, "", "é ab", "x"]))
    low, s, e, first = arrays.terms(raw, offsets)
    assert [bytes(low[a:b]).decode() for a, b in zip(s, e, strict=True)] == ["ab", "cd", "é", "ab", "x"]
    assert list(np.diff(first)) == [2, 0, 0, 2, 1]
    h = arrays.span_hashes(low, s, e)
    assert h[0] == h[3] and len(set(h)) == 4


def test_cases(spark):
    docs = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (2, "", "x"), (None, "idiot " * 100_000, "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, None), (2, 1), (None, 0), (9, 1)], "doc_id long, toxic int")
    machine = toxicity.learn(docs, labels)
    got = toxicity.score(docs, machine).collect()
    assert len(got) == 4 and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(docs.limit(0), toxicity.learn(docs, labels.limit(0))).count() == 0
    kept = toxicity.score(docs, machine, keep=True)
    assert kept.columns == ["doc_id", "text", "score", "_score"] and kept.filter(F.col("score") == "x").count() == 4


def test_keep_replaces_a_column_of_its_name(spark):
    docs = spark.createDataFrame([(1, "a", 9.0), (2, None, None)], "doc_id long, text string, _score double")
    machine = toxicity.fit([])
    got = toxicity.score(docs, machine, keep=True)
    assert sorted(got.columns) == ["_score", "doc_id", "text"] and got.filter("_score <= 1").count() == 2


def test_all_rows_scored_again(spark):
    """Learned from the same rows read here, and scored pair by pair."""
    data = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] or "" for r in table(spark, data, "documents").collect()}
    labels = [r for r in table(spark, data, "labels").collect() if r["doc_id"] in docs and r["toxic"] in (0, 1)]
    machine = toxicity.learn(table(spark, data, "documents"), table(spark, data, "labels").filter(queries.id_remainder(5) != 0))

    def held(text):
        words = [w.lower() for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", text.encode())]
        raw, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(w) for w in words], dtype=np.int64)
        return np.unique(arrays.span_hashes(raw, np.concatenate(([0], ends[:-1])).astype(np.int64), ends) >> np.uint64(44)).astype(np.int32) if words else np.zeros(0, np.int32)

    again = toxicity.fit([(held(docs[r["doc_id"]]), r["toxic"]) for r in labels if zlib.crc32(str(r["doc_id"]).encode()) % 5])
    assert set(np.flatnonzero(again.slot >= 0)) == set(np.flatnonzero(machine.slot >= 0)) and len(machine.linear) > 5
    for row in queries.QUERIES["op7_toxicity_machine"](spark, data).collect():
        at = [int(machine.slot[b]) for b in held(docs[row["doc_id"]]) if machine.slot[b] >= 0]
        z = machine.bias + sum(machine.linear[i] for i in at) + sum(float(machine.factors[i] @ machine.factors[j]) for k, i in enumerate(at) for j in at[k + 1 :])
        assert abs(row["score"] - 1 / (1 + math.exp(-z))) < 1e-9 and row["predicted"] == (row["score"] >= 0.5)
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)

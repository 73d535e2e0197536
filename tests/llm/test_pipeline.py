"""Each stage against brute force over its own input."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from studygraph.llm import mixing, queries, toxicity
from studygraph.llm.shared import table
from tests.llm.test_mixing import brute as brute_mix
from tests.llm.test_near_copies import brute as brute_near
from tests.llm.test_packing import gapless, reference
from tests.llm.test_substrings import brute as brute_repeats


def rows_of(df):
    return sorted((r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in df.collect())


def test_stages(spark, tmp_path):
    data = "/root/testdata/sf0.01"
    docs = table(spark, data, "documents")
    before = rows_of(docs)
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, data).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        if i == 4:
            break
        after = rows_of(docs)
        assert docs.columns == corpus_pipeline.COLUMNS
        if i == 0:
            start = table(spark, data, "documents")
            scores = toxicity.score(start, toxicity.learn(start, table(spark, data, "labels"))).collect()
            clean = {r["doc_id"] for r in scores if r["score"] < 0.5}
            assert after == [r for r in before if r[0] in clean] and 0.9 * len(before) < len(after) < len(before)
        elif i == 1:
            classes = brute_near([(r[0], r[1]) for r in before])
            assert after == [r for r in before if classes[r[0]] == r[0]] and len(after) < len(before)
        elif i == 2:
            want = {d: t.decode() for d, _, _, t in brute_repeats([(r[0], r[1]) for r in before])}
            assert after == [(d, want[d], lang, source, len(want[d])) for d, _, lang, source, _ in before]
        else:
            leaf = {r["doc_id"]: (r["d"], r["lang"], r["source"]) for r in spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long").select("doc_id", queries.domain().alias("d"), "lang", "source").collect()}
            counted = [(r[0], leaf[r[0]], len(r[1].split(" ")) if r[1] else 0) for r in before]
            total = Counter()
            for _, k, n in counted:
                total[k] += n
            wanted = mixing.leaf_budgets(total, int(0.8 * sum(total.values())), queries.WEIGHTS, 1)
            chosen = {d for d, _, _ in brute_mix(counted, wanted, 1, 17)}
            assert after == [r for r in before if r[0] in chosen] and len(after) < len(before)
        before = after
    got = docs.collect()
    ids = dict(zip([r[0] for r in before], reference([r[1] for r in before], public_tokenizers.path("word_bpe_49k.json")), strict=True))
    assert Counter(r["doc_id"] for r in got) == {d: len(x) // 4096 + 1 for d, x in ids.items()}
    n = gapless([(r["sequence_id"], r["offset"], r["length"]) for r in got], 4096)
    assert n <= 1.01 * sum(len(x) + 1 for x in ids.values()) / 4096 + 1


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 100 and out.filter(F.col("length") > 4096).count() == 0


def test_empty(spark):
    data = "/root/testdata/sf0.001"
    docs = table(spark, data, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, data)
        assert docs.count() == 0
        docs = spark.createDataFrame([], docs.schema)


def test_odd_rows(spark):
    """Nulls in every column, empty and very long texts, repeated rows and columns with clashing names."""
    data = "/root/testdata/sf0.001"
    rows = [(1, None, None, None, None), (1, None, None, None, None), (2, "", "en", "src1", 0), (3, "word " * 100_000, "en", "src2", 500_000), (None, "no id here", "de", None, 10), (4, "same text twice", None, "src3", 15), (5, "same text twice", "fr", "src3", 15), (5, "same text twice", "fr", "src3", 15)]
    docs = spark.createDataFrame([(*r, 0.5, "x", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, _score double, id string, _tokens int")
    kept = []
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, data).collect()
        kept.append(sorted({str(r["doc_id"]) for r in out}))
        docs = spark.createDataFrame([(*[r[c] for c in corpus_pipeline.COLUMNS], 0.5, "x", 1) for r in out] if "text" in out[0] else [], docs.schema)
    assert kept[0] == ["1", "2", "3", "4", "5", "None"] and kept[1] == kept[2] == ["1", "2", "3", "4", "None"]
    assert set(kept[3]) <= set(kept[2]) and kept[4] == kept[3]

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa

from studygraph.llm import quality, queries
from studygraph.llm.shared import table
from tests.llm.test_toxicity import auc


def test_held_out(spark):
    data = "/root/testdata/sf0.1"
    got = queries.QUERIES["op10_rule_ensemble"](spark, data)
    assert got.count() == table(spark, data, "documents").count()
    rows = got.join(table(spark, data, "labels"), "doc_id").filter("held_out").toPandas()
    assert ((rows.score >= 0) & (rows.score <= 1)).all() and ((rows.score >= 0.5) == (rows.predicted == 1)).all()
    right = (rows.predicted == rows.quality).mean()
    print(auc(rows.score.to_numpy(), rows.quality.to_numpy()), right, rows.quality.mean())
    assert auc(rows.score.to_numpy(), rows.quality.to_numpy()) > 0.8 and right > 0.9


def test_statistics():
    x = quality.measure(pa.array(["One two.\nONE two!", None, "", "a|a a\n\na|a a"]))
    get = lambda i, s: x[i, quality.STATISTICS.index(s)]
    assert get(0, "words") == 4 and get(0, "lines") == 2 and get(0, "upper") == 4 / 17 and get(0, "distinct_words") == 1 and get(0, "ends") == 0.5
    assert not x[1:3].any()
    assert get(3, "distinct_lines") == 0.5 and get(3, "bars") == 2 / 12 and get(3, "top_word") == 0.5 and get(3, "distinct_words") == 0.5


def test_paths():
    tree = "DecisionTree ...\n  If (feature 1 <= 0.5)\n   If (feature 2 <= 1.0E-2)\n    Predict: 0.0\n   Else (feature 2 > 1.0E-2)\n    Predict: 1.0\n  Else (feature 1 > 0.5)\n   Predict: 0.0\n"
    a, b = quality.STATISTICS[1], quality.STATISTICS[2]
    assert quality.paths(tree) == [[(a, True, 0.5)], [(a, True, 0.5), (b, True, 0.01)], [(a, True, 0.5), (b, False, 0.01)], [(a, False, 0.5)]]
    assert quality.merged([(a, True, 0.5), (a, True, 0.2), (b, False, 1.0)]) == tuple(sorted([(a, True, 0.2), (b, False, 1.0)]))


def test_compiled_rules(spark):
    e = quality.Ensemble(0.5, [(1.0, [("words", True, 2.0)]), (-2.0, [("words", False, 1.0), ("bars", False, 0.0)])])
    docs = spark.createDataFrame([(1, "a"), (2, "a | b"), (3, "a b c"), (4, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, e).collect()}
    want = {1: 1.5, 2: -1.5, 3: 0.5, 4: 1.5}
    assert all(abs(got[i] - 1 / (1 + np.exp(-z))) < 1e-12 for i, z in want.items())


def test_cases(spark):
    docs = spark.createDataFrame([(1, None, 1), (1, None, 1), (2, "", 1), (3, "word " * 200_000, 1), (None, "x", 1)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, None), (2, 1), (None, 0), (9, 1)], "doc_id long, quality int")
    got = quality.score(docs, quality.learn(docs, labels)).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert quality.score(docs.limit(0), quality.learn(docs.limit(0), labels)).count() == 0


def test_clashing_names(spark):
    docs = spark.createDataFrame([(i, "good words here . " * (i % 7 + 1) if i % 2 else "| | | x", 1, 1, 1) for i in range(60)], "doc_id long, text string, _key int, _y int, words int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, quality.learn(docs, labels)).collect()}
    assert all((got[i] >= 0.5) == (i % 2 == 1) for i in range(60))


def plain(text):
    """The statistics of a text, worked out byte by byte."""
    b = text.encode()
    words, lines = b.split(), [x for x in b.split(b"\n") if x]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    share = lambda chars: sum(c in chars for c in b) / max(1, len(b))
    distinct = lambda xs: len(set(xs)) / max(1, len(xs))
    out = {"bytes": len(b), "words": len(words), "lines": len(lines), "word_bytes": sum(map(len, words)) / max(1, len(words)), "words_a_line": len(words) / max(1, len(lines))}
    out |= {"upper": share(range(65, 91)), "digit": share(range(48, 58)), "punctuation": share(b"!\"'(),-.:;?"), "symbol": share(b"#$%&*+/<=>@[\\]^_`{|}~"), "space": share(b" \t\n\v\f\r"), "beyond_ascii": share(range(128, 256)), "bars": share(b"|"), "exclamations": share(b"!")}
    out |= {"distinct_words": distinct(words), "distinct_lines": distinct(lines), "distinct_grams": distinct(grams), "ends": sum(w[-1:] in b"!.?" for w in words) / max(1, len(words)), "top_word": max(Counter(words).values(), default=0) / max(1, len(words))}
    return out


def test_all_rows_scored_again(spark):
    data = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] or "" for r in table(spark, data, "documents").collect()}
    ensemble = quality.learn(table(spark, data, "documents"), table(spark, data, "labels").filter(queries.id_remainder(3) != 1))
    assert ensemble.rules
    for row in queries.QUERIES["op10_rule_ensemble"](spark, data).collect():
        x = plain(docs[row["doc_id"]])
        z = ensemble.bias + sum(w for w, rule in ensemble.rules if all((x[s] <= v) == below for s, below, v in rule))
        assert abs(row["score"] - 1 / (1 + np.exp(-z))) < 1e-9 and row["predicted"] == (row["score"] >= 0.5)

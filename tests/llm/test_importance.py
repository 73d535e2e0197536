from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np

from studygraph.llm import importance, queries
from studygraph.llm.shared import table


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return len(words), words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def reference(docs, target):
    """All results by plain dictionaries."""
    counts = []
    for texts in ([t for _, t in docs], target):
        c = Counter()
        for t in texts:
            c.update(zlib.crc32(f.encode()) % 10_000 for f in features(t)[1])
        counts.append(c)
    s, t = counts
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000)))) for b in range(10_000)]
    rows = []
    for d, text in docs:
        n, found = features(text)
        weight = sum(gain[zlib.crc32(f.encode()) % 10_000] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    fit = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    return rows, fit[: 25 * len(fit) // 100]


def test_all_documents(spark):
    data = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in table(spark, data, "documents").collect()]
    rows, drawn = reference(docs, [r["text"] for r in table(spark, data, "benchmark").collect()])
    rank = {r[0]: i for i, r in enumerate(drawn, 1)}
    got = queries.QUERIES["op11_trie_resample"](spark, data).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, got)) == sorted((*r[:4], rank.get(r[0])) for r in rows)
    assert len(rank) > 100


def test_cases(spark):
    long = " ".join(f"w{i % 977}" for i in range(200_000))
    docs = [(1, None), (2, ""), (3, "... !"), (4, "Ünï 7a7 " * 30), (5, long), (6, "x" * 100 + " " + "y" * 5000 + " b" * 30), (7, "one two " * 15), (7, "one two " * 15), (None, "one two " * 15), (None, "one two " * 15)]
    frame = spark.createDataFrame([(*r, 0, 0, 0) for r in docs], "doc_id long, text string, id int, score int, _at int")
    target = ["one two three", None, ""]
    rows, drawn = reference(docs, target)
    got = importance.resample(frame, spark.createDataFrame([(t,) for t in target], "text string")).collect()
    assert sorted(((r[0] or 0), *r[2:5]) for r in got) == sorted((r[0] or 0, *r[1:4]) for r in rows)
    assert sorted((r["rank"], r["doc_id"]) for r in got if r["rank"]) == [(i, r[0]) for i, r in enumerate(drawn, 1)]
    assert importance.resample(frame.limit(0), frame).count() == 0
    assert importance.resample(frame, frame.limit(0)).count() == len(docs)


def test_ranges_and_ties(spark):
    rows = [(i % 700 if i % 3 else None, 20 if i % 7 else 3, 1, 0, i % 5) for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long")
    got = importance.ranked(frame, percent=40, part_rows=50).collect()
    fit = sorted(((-r[4], r[0] is None, r[0] or 0) for r in rows if r[1] >= 20))
    drawn = sorted((r["rank"], (-r["score"], r["doc_id"] is None, r["doc_id"] or 0)) for r in got if r["rank"])
    assert len(got) == 3000 and drawn == list(enumerate(fit[: 40 * len(fit) // 100], 1))


def test_states_move_on():
    for a, b in ((b"", b"x"), (b"abc", b" defgh"), (b"\xff" * 9, b" " * 60)):
        assert int(importance.advanced(np.array([zlib.crc32(a)], np.uint32), len(b))[0]) ^ zlib.crc32(b) == zlib.crc32(a + b)


def test_emptied_tries_count_alike(monkeypatch):
    texts = importance.arrays.terms(*importance.arrays.text_bytes(importance.pa.array(["a b a b c", None, "b c d", "a b c d e f"])))
    whole = importance.WordTrie(3, 101)
    whole.count(*texts)
    monkeypatch.setattr(importance, "MOST_NODES", 2)
    small = importance.WordTrie(3, 101)
    small.count(*texts)
    small.count(*texts)
    small.flush()
    whole.count(*texts)
    whole.flush()
    assert (small.totals == whole.totals).all() and whole.totals.sum() == 2 * (12 + 6 + 15)

from __future__ import annotations

import hashlib
import random

import pytest

from studygraph.llm import queries, substrings
from studygraph.llm.shared import table


def brute(rows, window=20):
    """(id, n_words, n_removed, kept text) by remembering every window."""
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        words = (t or "").encode().split()
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            w = tuple(words[p : p + window])
            if w in seen:
                gone[p : p + window] = [True] * window
            seen.add(w)
        out.append((i, len(words), sum(gone), b" ".join(w for w, g in zip(words, gone, strict=True) if not g)))
    return out


def test_same_as_all_windows(spark):
    data = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in table(spark, data, "documents").collect()]
    got = {tuple(r) for r in queries.QUERIES["op2_anchored_repeats"](spark, data).collect()}
    want = {(i, n, k, hashlib.sha256(t).hexdigest()) for i, n, k, t in brute(rows)}
    assert got == want and sum(x[2] for x in want) > 0


@pytest.mark.parametrize("window", [2, 5, 20])
def test_small_vocabulary(spark, window, monkeypatch):
    monkeypatch.setattr(substrings, "GROUP_BYTES", 2000)
    rng = random.Random(window)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = []
    for i in range(150):
        words = [f"w{rng.randrange(3 if window > 5 else 40)}" for _ in range(rng.randrange(60))]
        text = rng.choice([" ", "\n", "  "]).join(words)
        rows.append((i, text + rng.choice(["", " " + passage, "\t" + passage + " x " + passage])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"].encode()) for r in substrings.remove_repeats(docs, window=window).collect())
    assert got == sorted(brute(rows, window))


def test_cases(spark):
    line = " ".join(f"a{i}" for i in range(25))
    long = "word " * 300_000
    rows = [(1, None), (2, ""), (3, " \n"), (4, line), (5, line + "\u00a0b"), (5, line), (7, long), (8, "é x " + line), (None, line), (None, None)]
    docs = spark.createDataFrame([(i, t, 0, 0) for i, t in rows], "doc_id long, text string, id int, q int")
    got = substrings.remove_repeats(docs).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"].encode()) for r in got), key=str) == sorted(brute(rows), key=str)
    assert [r["repeats"] for r in got if r["doc_id"] == 8] == [[(1, 25)]]
    assert substrings.remove_repeats(docs.limit(0)).count() == 0


def test_windows_are_told_by_their_words(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["a", "b", "c"]) for _ in range(rng.randrange(40)))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"].encode()) for r in substrings.remove_repeats(docs, window=6, value_bits=8).collect())
    assert got == sorted(brute(rows, 6))


def test_kept_names(spark):
    with pytest.raises(ValueError):
        substrings.remove_repeats(spark.createDataFrame([(1, "a", "x")], "doc_id long, text string, repeats string"), keep=["repeats"])

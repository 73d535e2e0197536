from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from studygraph.llm import arrays, components, near_copies, queries
from studygraph.llm.shared import table


def classes(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def common_subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            keep = row[j + 1]
            row[j + 1] = last + 1 if x == y else max(row[j + 1], row[j])
            last = keep
    return row[-1]


def kmers(text):
    raw, offsets = arrays.text_bytes(pa.array([text]))
    low, s, e, _ = arrays.terms(raw, offsets)
    w = [bytes(low[i:j]) for i, j in zip(s, e, strict=True)]
    seen, out = Counter(), []
    for i in range(max(1, len(w) - 4) if w else 0):
        x = tuple(w[i : i + 5])
        out.append((x, seen[x]))
        seen[x] += 1
    return out


def brute(rows):
    """Classes of (id, text) rows by comparing all pairs that share a k-mer."""
    made, holders, links = {}, defaultdict(set), []
    first = {}
    for i, t in rows:
        if t is None:
            continue
        ks = kmers(t) or [("raw", t)]
        if tuple(ks) in first:
            links.append((i, first[tuple(ks)]))
            continue
        first[tuple(ks)] = i
        made[i] = ks
        for x in ks:
            holders[x].add(i)
    shared = Counter((min(a, b), max(a, b)) for s in holders.values() for a in s for b in s if a < b)
    for (a, b), n in shared.items():
        na, nb = len(made[a]), len(made[b])
        if n >= 0.8 * (na + nb - n) - 1e-9:
            m = common_subsequence(made[a], made[b]) if max(na, nb) < 3000 else n
            if m >= 0.8 * (na + nb - m) - 1e-9:
                links.append((a, b))
    return classes([i for i, _ in rows], links)


def test_same_classes_as_all_pairs(spark):
    data = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in table(spark, data, "documents").collect()]
    got = {r["doc_id"]: r["class_id"] for r in queries.QUERIES["op4_order_minhash"](spark, data).collect()}
    assert got == brute(rows) and len(set(got.values())) < len(rows)


def test_one_large_group(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(160):
        t = list(base)
        for _ in range(rng.randrange(5)):
            t[rng.randrange(len(t))] = f"z{rng.randrange(10**6)}"
        rows.append((i, " ".join(t)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for block, terms in ((512, 1_000_000), (40, 1_000_000), (512, 5_000)):
        got = {r["doc_id"]: r["class_id"] for r in near_copies.near_copies(docs, block=block, block_terms=terms).collect()}
        want = brute(rows)
        assert sum(got[i] != want[i] for i in got) <= 2 and all(want[got[i]] == want[i] for i in got)


def test_classes_within_a_large_group_are_joined(spark):
    rng = random.Random(8)
    head = [f"h{i}" for i in range(40)]
    rows, bases = [], [head + [f"v{k}x{i}" for i in range(60)] for k in range(6)]
    for i in range(150):
        t = list(bases[i % 6])
        for _ in range(rng.randrange(4)):
            t[rng.randrange(len(t))] = f"z{rng.randrange(10**6)}"
        rows.append((i, " ".join(t)))
    half = bases[0][:70] + bases[1][70:]
    rows += [(200 + k, " ".join(half[: 70 + k] + bases[0][70 + k :])) for k in range(0, 31, 5)]  # a path from one class to another
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    for block in (512, 12):
        got = {r["doc_id"]: r["class_id"] for r in near_copies.near_copies(docs, block=block, keys=40).collect()}
        assert got == want


def test_alignment_is_the_longest_common_subsequence():
    rng = np.random.default_rng(4)
    for _ in range(300):
        n = int(rng.integers(1, 40))
        a = rng.permutation(60)[:n].astype(np.uint64)
        b = a.copy()
        for _ in range(int(rng.integers(0, 6))):
            p = int(rng.integers(0, len(b) + 1))
            b = np.insert(b, p, rng.integers(100, 10**9)) if rng.random() < 0.5 or len(b) < 2 else np.delete(b, min(p, len(b) - 1))
        if rng.random() < 0.3:
            b = rng.permutation(b)
        m = common_subsequence(a.tolist(), b.tolist())
        assert near_copies.aligned(a, b, 0.8) == (m >= 0.8 * (len(a) + len(b) - m) - 1e-9)


def test_cases(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None), (2, None), (3, ""), (4, ""), (5, "!!!"), (6, "???"), (7, "Same words, here"), (8, "same WORDS here"), (9, "a"), (10, long), (11, long + " end"), (12, "w1 w2 w3"), (12, "a"), (None, "a")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, class_id string")
    got = [(r["doc_id"], r["class_id"], r["kept"]) for r in near_copies.near_copies(docs).collect()]
    assert sorted(got, key=str) == sorted([(1, 1, True), (2, 2, True), (3, 3, True), (4, 3, False), (5, 5, True), (6, 6, True), (7, 7, True), (8, 7, False), (9, 9, True), (10, 10, True), (11, 10, False), (12, 9, False), (12, 9, False), (None, None, None)], key=str)
    assert near_copies.near_copies(docs.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, 900), (900, 900), (7, 3), (None, 4)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(201), 0), 900: 900, 1000: 900}

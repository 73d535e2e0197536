from __future__ import annotations

import numpy as np
import pytest

from studygraph.llm import embeddings, queries
from studygraph.llm.shared import table
from tests.llm.test_near_copies import classes


def brute(rows, similarity=0.95):
    """{id: (links, component)} of (id, vector) rows by all pairs."""
    good = [(i, np.array(v, float)) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    out = {i: (0, i) for i, _ in rows}
    if good:
        x = np.stack([v / np.linalg.norm(v) for _, v in good])
        s = x @ x.T >= similarity
        np.fill_diagonal(s, False)
        ids = [i for i, _ in good]
        root = classes(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(s), strict=True) if a < b])
        out |= {i: (int(n), root[i]) for i, n in zip(ids, s.sum(1), strict=True)}
    return out


@pytest.mark.parametrize("seed,dim", [(0, 64), (1, 8)])
def test_recall(spark, seed, dim):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(1500, dim))
    near = base[:300] + rng.normal(size=(300, dim)) * 0.3 * rng.random((300, 1))
    one = base[0] + rng.normal(size=(700, dim)) * 0.12  # one large group of near copies
    same = np.repeat(base[1:3], 200, axis=0)
    x = np.concatenate([base, near, one, same]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    want = brute(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for how in ({"leaf_rows": 64, "block": 128}, {"leaf_rows": 16, "fit_rows": 200}):  # the second splits leaves on, level by level
        got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_vectors(df, **how).collect()}
        assert all(got[i][0] <= want[i][0] for i in want)
        assert sum(n for n, _ in got.values()) >= 0.98 * sum(n for n, _ in want.values())
        assert sum(got[i][1] != want[i][1] for i in want) <= 0.01 * len(want)


def test_planted_pairs_among_all_embeddings(spark):
    """The table has no pair at 0.95, so pairs just above it are planted."""
    rng = np.random.default_rng(5)
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, "/root/testdata/sf0.1", "embeddings").collect()]
    pairs = []
    for k in range(400):
        v = np.array(rows[k * 4][1], float)
        u = rng.normal(size=len(v))
        u -= (u @ v) / (v @ v) * v
        t = np.sqrt(1 / rng.uniform(0.951, 0.96) ** 2 - 1)
        pairs.append((100_000 + k, (v / np.linalg.norm(v) + t * u / np.linalg.norm(u)).astype(np.float32).tolist()))
    want = brute(rows + pairs)
    got = {r["vec_id"]: r["n_links"] for r in embeddings.near_vectors(spark.createDataFrame(rows + pairs, "vec_id long, embedding array<float>"), leaf_rows=32, fit_rows=500).collect()}
    assert sum(n for n, _ in want.values()) >= 800 and all(got[i] <= n for i, (n, _) in want.items())
    assert sum(got.values()) >= 0.95 * sum(n for n, _ in want.values())


def test_all_embeddings(spark):
    data = "/root/testdata/sf0.1"
    want = brute([(r["vec_id"], r["embedding"]) for r in table(spark, data, "embeddings").collect()])
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in queries.QUERIES["op9_projection_forest"](spark, data).collect()}
    assert got == want


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [1.0, None]), (7, [inf, 1.0]), (8, []), (9, [1.0, 0.0]), (10, [1e-30, 0.0]), (11, [-1.0, 0.0]), (12, [3.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, n_links int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_vectors(df).collect()}
    linked = (1, 2, 9, 10, 12)
    assert got == {i: (4, 1, i == 1) if i in linked else (0, i, True) for i, _ in rows}
    assert embeddings.near_vectors(df.limit(0)).count() == 0
    again = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.01]), (None, None)], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, embeddings.near_vectors(again).collect()), key=str) == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, None, None), (None, 0, None, None)], key=str)

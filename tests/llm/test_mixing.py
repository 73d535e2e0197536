from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from studygraph.llm import mixing, queries
from studygraph.llm.shared import table


def brute(rows, wanted, epochs, seed):
    """(id, epoch, end) of chosen rows; rows: (id, leaf, tokens)."""
    leaves, out = defaultdict(list), []
    for i, leaf, n in rows:
        leaves[leaf].append((i, n))
    for leaf, mine in leaves.items():
        for e in range(epochs):
            room, end = wanted[leaf] - e * sum(n for _, n in mine), 0
            if e and room <= 0:
                continue
            for i, n in sorted(mine, key=lambda r: (hashlib.md5(f"{seed}|{e}|{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])):
                end += n
                if end <= room:
                    out.append((i, e, end))
    return Counter(out)


def test_same_as_brute_force(spark):
    data = "/root/testdata/sf0.01"
    rows = []
    for r in table(spark, data, "documents").select("doc_id", "lang", "source", "text", queries.domain().alias("domain")).collect():
        rows.append((r["doc_id"], (r["domain"], r["lang"], r["source"]), len((r["text"] or "").encode().split())))
    total = Counter()
    for _, leaf, n in rows:
        total[leaf] += n
    wanted = mixing.leaf_budgets(total, sum(total.values()), queries.WEIGHTS, 2)
    assert sum(wanted.values()) == sum(total.values()) and all(wanted[k] <= 2 * total[k] for k in total)
    got = Counter((r["doc_id"], r["epoch"], r["tokens_end"]) for r in queries.QUERIES["op1_budget_tree"](spark, data).collect())
    assert got == brute(rows, wanted, 2, 17) and max(e for _, e, _ in got) == 1


def test_shortage_stays_among_siblings():
    available = {("a", "x"): 10, ("a", "y"): 1000, ("b", "z"): 1000}
    assert mixing.leaf_budgets(available, 400, {}, 1) == {("a", "x"): 10, ("a", "y"): 190, ("b", "z"): 200}
    # only what the subtree can't hold goes up
    available = {("a", "x"): 10, ("a", "y"): 20, ("b", "z"): 1000}
    assert mixing.leaf_budgets(available, 400, {}, 1) == {("a", "x"): 10, ("a", "y"): 20, ("b", "z"): 370}
    assert mixing.leaf_budgets(available, 400, {}, 2) == {("a", "x"): 20, ("a", "y"): 40, ("b", "z"): 340}
    assert mixing.leaf_budgets(available, 10**6, {("b",): 0.0}, 1) == {("a", "x"): 10, ("a", "y"): 20, ("b", "z"): 0}
    assert mixing.leaf_budgets({("a",): 100, ("b",): 100}, 60, {("a",): 3, ("b",): 1}, 1) == {("a",): 45, ("b",): 15}
    assert mixing.leaf_budgets({}, 5, {}, 1) == {}
    assert sum(mixing.leaf_budgets({(str(i),): 10 for i in range(7)}, 24, {}, 1).values()) == 24


def test_cases(spark):
    rows = [(1, "a b c", None, "s"), (1, "a b c", None, "s"), (2, None, "en", "s"), (3, "", "en", None), (None, "x", "en", "t"), (4, "w " * 100_000, "en", "t")]
    docs = spark.createDataFrame([(*r, 5, 6) for r in rows], "doc_id long, text string, lang string, source string, _tokens int, _in int")
    got = mixing.mix(docs, [F.col("lang"), F.col("source")], {}, epochs=1)
    assert got.columns == ["doc_id", "text", "lang", "source", "_epoch", "_tokens", "_end"]
    assert got.count() == 6  # all tokens: every row
    assert mixing.mix(docs.limit(0), [F.col("lang")], {}).count() == 0
    assert mixing.mix(docs, [F.col("lang"), F.col("source")], {}, budget=0).agg(F.sum("_tokens")).first()[0] in (0, None)

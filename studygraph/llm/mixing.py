"""Mixing sources to target weights: a token budget goes down a tree of domain, language and source, and each source gives
a prefix of its documents in a seeded order, epoch after epoch."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

Leaf = tuple[str, ...]
#: Rows of a leaf that one window of its seeded order is made for.
PART_ROWS = 50_000


def shares(weights: list[float], caps: list[int], budget: int) -> list[int]:
    """A budget over siblings by weight, none above its cap: what a sibling can't take goes to the others by weight, until
    all is given or all are full. Whole tokens; of what rounding leaves, one each to the largest remainders, ties in the
    order of siblings. Siblings of weight 0 get nothing."""
    budget = min(budget, sum(c for w, c in zip(weights, caps, strict=True) if w > 0))
    given: dict[int, float] = {}
    open_ = [i for i, w in enumerate(weights) if w > 0]
    rest = float(budget)
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if rest * weights[i] / total >= caps[i]]
        if not full:
            given.update({i: rest * weights[i] / total for i in open_})
            break
        for i in full:
            given[i] = float(caps[i])
            open_.remove(i)
        rest = budget - sum(given.values())
    out = [min(caps[i], math.floor(given.get(i, 0.0) + 1e-9)) for i in range(len(weights))]
    for i in sorted(given, key=lambda i: (out[i] - given[i], i)):
        if sum(out) >= budget:
            break
        if out[i] < caps[i]:
            out[i] += 1
    return out


def leaf_budgets(available: Mapping[Leaf, int], budget: int, weight: Mapping[Leaf, float], epochs: int) -> dict[Leaf, int]:
    """Tokens for each leaf of the tree whose leaves are the keys of available, from the root down. A node's weight among
    its siblings is that of its path, 1 where none is given. A node can hold epochs times its tokens, so a shortage within
    a subtree is made up by the leaf's siblings; only what the whole subtree can't hold goes to the siblings above."""

    def down(path: Leaf, leaves: list[Leaf], tokens: int) -> dict[Leaf, int]:
        if leaves == [path]:
            return {path: tokens}
        children = sorted({x[: len(path) + 1] for x in leaves})
        under = [[x for x in leaves if x[: len(c)] == c] for c in children]
        caps = [sum(able(x) for x in xs) for xs in under]
        parts = shares([float(weight.get(c, 1.0)) for c in children], caps, tokens)
        return {k: v for c, xs, n in zip(children, under, parts, strict=True) for k, v in down(c, xs, n).items()}

    def able(leaf: Leaf) -> int:
        return 0 if any(weight.get(leaf[:d], 1.0) <= 0 for d in range(1, len(leaf) + 1)) else epochs * available[leaf]

    leaves = sorted(available)
    return down((), leaves, min(budget, sum(map(able, leaves)))) if leaves else {}


def tokens_of(text: Column) -> Column:
    """Tokens of a text for budgets: its words ([^\\x20\\x09-\\x0D]+). Null has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def seeded(seed: int, epoch: Column, id_: Column) -> Column:
    """A row's place in an epoch's order: hexadecimal, evenly spread, another in every epoch."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(id_.cast("string"), F.lit(""))))


def mix(docs: DataFrame, levels: Sequence[Column], weight: Mapping[Leaf, float], budget: int | float = 1.0, epochs: int = 1, seed: int = 0, id_col: str = "doc_id", tokens: Column | None = None) -> DataFrame:
    """The rows of docs chosen, with _epoch (from 0), _tokens and _end (tokens of the leaf in this epoch up to this row).

    levels: columns from the top of the tree to the source; null counts as the empty name. budget: tokens in all; a
    float is a share of the tokens of all rows. tokens: a row's tokens, by default the words of column text. Each leaf gives whole rows,
    epoch by epoch in that epoch's seeded order, while their tokens stay within the leaf's budget. Rows of one id and as
    many tokens are interchangeable; each counts for itself. An empty table gives no rows. Columns of docs with a name
    made here (_leaf, _tokens, _epoch, _place, _part, _room, _base, _in, _end) are replaced; all others are kept.

    Budgets come from one sum per leaf, sent to the driver: as many rows as there are sources. Prefixes come from sums per
    leaf, epoch and part of the seeded order: 4096 parts of a leaf, or as many more as make parts of PART_ROWS rows, so a
    source with a third of all rows is many windows, not one."""
    names = [F.coalesce(c.cast("string"), F.lit("")) for c in levels]
    count = tokens_of(F.col("text")) if tokens is None else F.coalesce(tokens.cast("long"), F.lit(0))
    rows = docs.withColumns({"_leaf": F.array(*names), "_tokens": count})
    held = rows.groupBy("_leaf").agg(F.sum("_tokens").alias("n"), F.count("*").alias("rows")).collect()
    available = {tuple(r["_leaf"]): r["n"] for r in held}
    digits = max(3, math.ceil(math.log(max([1, *(r["rows"] / PART_ROWS for r in held)]), 16)))
    wanted = leaf_budgets(available, int(budget * sum(available.values())) if isinstance(budget, float) else budget, weight, epochs)
    turns = [(list(k), e, v - e * available[k]) for k, v in wanted.items() for e in range(epochs) if e == 0 or v - e * available[k] > 0]
    turn = docs.sparkSession.createDataFrame(turns, "_leaf array<string>, _epoch int, _room long")  # a row per leaf and epoch
    kept = [c for c in docs.columns if c not in ("_leaf", "_tokens", "_epoch", "_place", "_part", "_room", "_base", "_in", "_end")]
    put = rows.select(*kept, "_leaf", "_tokens").join(F.broadcast(turn), "_leaf").withColumn("_place", seeded(seed, F.col("_epoch"), F.col(id_col))).withColumn("_part", F.substring("_place", 1, digits))
    before = Window.partitionBy("_leaf", "_epoch").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = put.groupBy("_leaf", "_epoch", "_part").agg(F.sum("_tokens").alias("_n")).select("_leaf", "_epoch", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_leaf", "_epoch", "_part").orderBy("_place", "_tokens").rowsBetween(Window.unboundedPreceding, 0)
    ended = put.withColumn("_in", F.sum("_tokens").over(within)).join(bases, ["_leaf", "_epoch", "_part"])
    return ended.withColumn("_end", F.col("_base") + F.col("_in")).filter("_end <= _room").select(*kept, "_epoch", "_tokens", "_end")


def shares_sql(name: str, parents: str, nodes: str) -> str:
    """shares() in DuckDB SQL as a common table expression: nodes (parent, node, w, c) get b of their parents' (node, b).
    A share is the smaller of the cap and of lambda times the weight; lambda is where caps, in the order of cap by weight,
    stop being reached."""
    return f"""
{name}_o AS (SELECT n.parent, n.node, n.w, n.c, p.b,
    sum(c) OVER (PARTITION BY n.parent ORDER BY c / w, n.node ROWS UNBOUNDED PRECEDING)::DOUBLE - c AS ahead, sum(w) OVER (PARTITION BY n.parent ORDER BY c / w DESC, n.node DESC ROWS UNBOUNDED PRECEDING) AS behind
  FROM {nodes} n JOIN {parents} p ON p.node = n.parent),
{name}_l AS (SELECT parent, arg_min((b - ahead) / behind, (c / w, node)) FILTER (b - ahead < c / w * behind) AS l FROM {name}_o GROUP BY parent),
{name}_g AS (SELECT parent, node, b, c, coalesce(least(c, l * w), c)::DOUBLE AS g FROM {name}_o JOIN {name}_l USING (parent)),
{name}_f AS (SELECT *, least(c, floor(g + 1e-9))::BIGINT AS f FROM {name}_g),
{name}_r AS (SELECT *, row_number() OVER (PARTITION BY parent, f < c ORDER BY f - g, node) AS place, least(b, sum(c) OVER (PARTITION BY parent)) - sum(f) OVER (PARTITION BY parent) AS spare FROM {name}_f),
{name} AS (SELECT node, (f + CASE WHEN f < c AND place <= spare THEN 1 ELSE 0 END)::BIGINT AS b FROM {name}_r)"""


def mix_sql(domain: str, weight: Mapping[Leaf, float], epochs: int, seed: int) -> str:
    """mix() of all tokens of documents down domain, lang and source in DuckDB SQL."""
    given = " ".join(f"WHEN '/{'/'.join(k)}' THEN {float(v)}" for k, v in weight.items())
    def level(path: str, parent: str) -> str:
        return f"(SELECT {parent} AS parent, {path} AS node, CASE {path} {given} ELSE 1.0 END AS w, ({epochs} * sum(n))::DOUBLE AS c FROM leaf GROUP BY ALL)"

    return f"""
WITH d AS (SELECT doc_id, {domain} AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source, lang AS lang_, source AS source_,
    len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS n FROM documents),
leaf AS (SELECT '/' || domain AS a, '/' || domain || '/' || lang AS b, '/' || domain || '/' || lang || '/' || source AS p, sum(n)::BIGINT AS n FROM d GROUP BY ALL),
root AS (SELECT '' AS node, sum(n)::DOUBLE AS b FROM leaf),{shares_sql("one", "root", level("a", "''"))},{shares_sql("two", "one", level("b", "a"))},{shares_sql("three", "two", level("p", "b"))},
turn AS (SELECT three.node AS p, e, three.b - e * leaf.n AS room FROM three JOIN leaf ON leaf.p = three.node CROSS JOIN range({epochs}) AS r(e) WHERE e = 0 OR three.b - e * leaf.n > 0),
t AS (SELECT doc_id, domain, lang_, source_, e, n, room, sum(n) OVER (PARTITION BY p, e ORDER BY md5('{seed}|' || e || '|' || coalesce(CAST(doc_id AS VARCHAR), '')), n ROWS UNBOUNDED PRECEDING)::BIGINT AS tokens_end
  FROM d JOIN turn ON p = '/' || domain || '/' || lang || '/' || source)
SELECT doc_id, domain, lang_ AS lang, source_ AS source, e::INTEGER AS epoch, n AS tokens, tokens_end FROM t WHERE tokens_end <= room
"""

"""Near duplicates of embeddings by a random-projection tree forest.

Trees are grown on a bounded sample: a node splits along a random direction, at the place in its middle range where the
fewest vectors are near; what is near goes both ways (spill). A node that no place splits well, such as a dense cluster,
is a leaf. All vectors go down all trees. A leaf that holds too many of them is split on, by a tree grown on a bounded sample of
its own vectors in a task, level by level, so that leaves stay small whatever the table's size. Vectors meet in the
leaves, where every pair is compared exactly, in blocks of bounded size. A pair counts in the first leaf that its vectors
share, so counts add up without writing pairs down."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from studygraph.llm import arrays
from studygraph.llm.components import connected_components
from studygraph.llm.shared import Written


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees: direction, threshold, and children (a negative child -1 - k is leaf k)."""

    roots: list[int]
    direction: np.ndarray
    threshold: np.ndarray
    child: np.ndarray
    margin: float

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) pairs of unit vectors, over all trees."""
        rows, found = [], []
        todo = [(r, np.arange(len(x))) for r in self.roots]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            if node < 0:
                rows.append(at)
                found.append(np.full(len(at), -1 - node))
                continue
            p = x[at] @ self.direction[node] - self.threshold[node]
            todo.append((int(self.child[node, 0]), at[p <= self.margin]))
            todo.append((int(self.child[node, 1]), at[p >= -self.margin]))
        return (np.concatenate(rows), np.concatenate(found)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def grow(sample: np.ndarray, rows: int, similarity: float, trees: int, leaf_rows: int, seed: int) -> Forest:
    """A forest whose leaves hold about leaf_rows of `rows` unit vectors, grown on a sample of them. The margin of the
    spill is half the typical difference that vectors at the threshold have along a direction."""
    dim = sample.shape[1]
    margin = 0.5 * np.sqrt(2 * (1 - similarity)) / np.sqrt(max(1, dim))
    rng = np.random.default_rng(seed)
    least = max(32, int(leaf_rows * len(sample) / max(rows, 1)))
    direction, threshold, child, roots, leaf = [], [], [], [], 0

    def split(at: np.ndarray) -> int:
        nonlocal leaf
        if len(at) > least:
            for _ in range(3):  # a few directions are tried
                d = rng.normal(size=dim)
                d /= np.linalg.norm(d)
                p = np.sort(sample[at] @ d)
                places = p[np.linspace(0.3 * len(p), 0.7 * len(p) - 1, 21).astype(int)]
                near = np.searchsorted(p, places + margin, "right") - np.searchsorted(p, places - margin)
                best = int(np.argmin(near))
                if near[best] <= 0.35 * len(p):
                    me = len(direction)
                    direction.append(d)
                    threshold.append(places[best])
                    child.append([0, 0])
                    q = sample[at] @ d - places[best]
                    child[me] = [split(at[q <= margin]), split(at[q >= -margin])]
                    return me
        leaf += 1
        return -leaf

    for _ in range(trees):
        roots.append(split(np.arange(len(sample))))
    return Forest(roots, np.array(direction).reshape(-1, dim), np.array(threshold), np.array(child, np.int64).reshape(-1, 2), margin)


def usable(vector: Column) -> Column:
    """Whether a vector can be compared: not null, without null or non-finite components, not zero."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def unit(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors in double precision, padded with zeros to dim, of length 1."""
    sizes = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.zeros((len(column), dim))
    row = np.repeat(np.arange(len(column)), sizes)
    x[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    x /= np.abs(x).max(1, initial=0, keepdims=True) + (np.abs(x).max(1, initial=0, keepdims=True) == 0)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def compared(x: np.ndarray, weight: np.ndarray, owner: np.ndarray, member: np.ndarray, side: np.ndarray, leaf: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Of the vectors that meet in one block of a leaf (or, with sides, in two): each one's links that count here (the
    partners' weights), and the least position it is joined with. (owner, member): all leaves of each position; a pair
    that shares a smaller leaf counts there."""
    n = len(x)
    first, second = np.flatnonzero(side == 0), np.flatnonzero(side == side.max())
    links = x[first] @ x[second].T >= similarity
    links &= first[:, None] != second[None, :]
    linked = np.zeros(n, bool)
    linked[first], linked[second] = links.any(1), linked[second] | links.any(0)
    use = (member < leaf) & linked[owner]
    values, code, often = np.unique(member[use], return_inverse=True, return_counts=True)
    shared = often[code] > 1
    if shared.any():
        names = np.cumsum(often > 1) - 1
        has = np.zeros((n, int(names[-1]) + 1), np.float32)
        has[owner[use][shared], names[code[shared]]] = 1
        links &= (has[first] @ has[second].T) == 0
    counts = np.zeros(n, np.int64)
    counts[first] += links @ weight[second]
    label = np.arange(n)
    if side.max():
        counts[second] += links.T @ weight[first]
    if links.any():
        while True:
            before = label.copy()
            label[first] = np.minimum(label[first], np.where(links, label[second][None, :], n).min(1, initial=n))
            label[second] = np.minimum(label[second], np.where(links, label[first][:, None], n).min(0, initial=n))
            label = label[label]
            if (label == before).all():
                break
    return counts, label


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", similarity: float = 0.95, trees: int = 4, leaf_rows: int = 256, block: int = 1024, fit_rows: int = 65_536, fit_values: int = 8_000_000, seed: int = 5) -> DataFrame:
    """Per row of df: the id, n_links (other rows whose vector's cosine with this one's is at least similarity, of those
    that some leaf holds together), component_id (the least id that links reach, its own included) and kept
    (id = component_id). Every link found is exact, in double precision; none below the threshold is made.

    Vectors that are null, zero or hold null or non-finite components link with nothing. Equal vectors always link; they
    go through the forest once. Vectors of different length compare as if padded with zeros. Rows of one id are one node.
    Rows without an id have links, but null component_id and kept. An empty table gives no rows; other columns are not
    looked at.

    The first level of the forest is grown on at most fit_rows vectors and fit_values numbers, those with the smallest
    hashes; it is sent to all tasks, and its size is bounded by the sample's. Leaves of more than 4 * leaf_rows
    vectors are split on samples of about as many; only a dense cluster stays larger, for its pairs are links."""
    spark = df.sparkSession
    tables = Written(spark)
    given = df.schema[vector_col].dataType
    kind = "array<float>" if isinstance(given, ArrayType) and given.elementType == FloatType() else "array<double>"
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kind).alias("v"))
    valid = rows.filter(usable(F.col("v")))
    reps = tables.put("vectors", valid.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("weight")).withColumn("key", F.xxhash64("v")))
    n, dim = reps.agg(F.count("*"), F.max(F.size("v"))).first()
    dim = dim or 1
    fit = max(1, min(fit_rows, fit_values // dim))
    sampled = reps.select("v", F.xxhash64("key").alias("h"), "key").orderBy("h", "key").limit(fit)
    picked = sampled.select("v").toArrow().column("v").combine_chunks() if n else pa.array([], pa.list_(pa.float64()))
    picked = picked.combine_chunks() if isinstance(picked, pa.ChunkedArray) else picked
    forest = spark.sparkContext.broadcast(grow(unit(picked, dim), n, similarity, trees, leaf_rows, seed))

    def gone_down(part: pa.RecordBatch, tree: Forest, above: int) -> pa.RecordBatch:
        """(leaf, node, solid) of the vectors of a batch in a tree whose root is the leaf `above`."""
        row, leaf = tree.leaves(unit(part.column("v"), dim))
        solid = len(tree.threshold) == 0  # no split was found
        name = arrays.mix(arrays.mix(leaf.astype(np.uint64) + np.uint64(1)) ^ np.array([above]).view(np.uint64)).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(name), part.column("node").take(pa.array(row)), pa.array(np.full(len(row), solid))], ["leaf", "node", "solid"])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 4096):
                yield gone_down(batch.slice(at, 4096), forest.value, 0)

    def grown(held: pa.Table) -> pa.Table:
        above = held.column("leaf")[0].as_py()
        x = unit(held.column("v").combine_chunks(), dim)
        tree = grow(x, held.column("n")[0].as_py(), similarity, 1, leaf_rows, seed + above % 1_000_003)
        return pa.table({"leaf": pa.array([above], pa.int64()), "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The tree of a leaf comes before its vectors."""
        tree, above = None, 0
        for batch in batches:
            held = np.flatnonzero(batch.column("tree").is_valid().to_numpy(zero_copy_only=False))
            ends = np.append(held[1:], len(batch)) if len(held) else np.zeros(0, np.int64)
            begin = int(held[0]) if len(held) else len(batch)
            if begin and tree is not None:
                yield from (gone_down(batch.slice(at, min(4096, begin - at)), tree, above) for at in range(0, begin, 4096))
            for a, z in zip(held.tolist(), ends.tolist(), strict=True):
                tree, above = pickle.loads(batch.column("tree")[a].as_py()), batch.column("leaf")[a].as_py()
                yield from (gone_down(batch.slice(at, min(4096, z - at)), tree, above) for at in range(a + 1, z, 4096))

    # a node is a distinct vector, by its hash
    nodes = reps.select(F.col("key").alias("node"), "weight", "v")
    members = tables.put("members0", nodes.mapInArrow(placed, "leaf long, node long, solid boolean"))
    for level in range(1, 64):
        sizes = members.groupBy("leaf").agg(F.count("*").alias("n"), F.bool_or("solid").alias("solid"))
        big = tables.put(f"big{level}", sizes.filter(f"n > {4 * leaf_rows} AND NOT solid").select("leaf", "n"))
        if not big.limit(1).count():
            tables.drop(f"big{level}")
            break
        held = members.join(big, "leaf").join(nodes, "node").select("leaf", "n", "node", "v")
        grown_on = held.filter(F.pmod(F.xxhash64("node", "leaf"), F.col("n")) < fit).select("leaf", "n", "v")
        made = tables.put(f"trees{level}", grown_on.groupBy("leaf").applyInArrow(grown, "leaf long, tree binary"))
        parts = F.ceil(F.col("n") / 65_536).cast("int")  # a leaf goes to several tasks, its tree to each of them
        first = made.join(big, "leaf").select("leaf", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "tree", F.lit(None).cast("long").alias("node"), F.lit(None).cast(kind).alias("v"))
        after = held.select("leaf", F.pmod(F.xxhash64("node"), parts).cast("int").alias("part"), F.lit(None).cast("binary").alias("tree"), "node", "v")
        below = first.union(after).repartition("leaf", "part").sortWithinPartitions("leaf", "part", F.col("tree").isNull()).mapInArrow(split, "leaf long, node long, solid boolean")
        now = tables.put(f"members{level}", members.join(big, "leaf", "left_anti").select("leaf", "node", "solid").union(below))
        tables.drop(f"members{level - 1}", f"big{level}", f"trees{level}")
        members = now
    sizes = members.groupBy("leaf").agg(F.count("*").alias("n")).filter("n > 1").select("leaf", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    every = members.groupBy("node").agg(F.sort_array(F.collect_list("leaf")).alias("leaves"))  # a few for each tree
    dealt = members.join(sizes, "leaf").join(every, "node").join(nodes, "node").withColumn("b", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    spread = dealt.select("leaf", "node", "weight", "leaves", "v", "b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
    met = spread.select("leaf", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), (F.col("b") > F.col("o")).cast("int").alias("side"), "node", "weight", "leaves", "v")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of rows with one leaf and block, from batches sorted by them."""
        group, held = None, []
        for batch in batches:
            keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("leaf", "i", "j")]
            heads = np.flatnonzero(np.concatenate(([True], np.any([k[1:] != k[:-1] for k in keys], axis=0)))).tolist() if len(batch) else []
            for a, z in zip(heads, [*heads[1:], len(batch)], strict=True):
                key = tuple(int(k[a]) for k in keys)
                if group != key:
                    yield from found(group, held)
                    group, held = key, []
                held.append(batch.slice(a, z - a))
        yield from found(group, held)

    def found(group: tuple[int, int, int] | None, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if sum(map(len, held)) < 2:
            return
        t = pa.Table.from_batches(held).combine_chunks()
        side, node, weight = (t.column(c).to_numpy() for c in ("side", "node", "weight"))
        leaves = t.column("leaves").combine_chunks()
        leaves = leaves.combine_chunks() if isinstance(leaves, pa.ChunkedArray) else leaves
        v = t.column("v").combine_chunks()
        v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
        owner = np.repeat(np.arange(len(t)), pa.compute.list_value_length(leaves).to_numpy(zero_copy_only=False).astype(np.int64))
        counts, label = compared(unit(v, dim), weight, owner, leaves.flatten().to_numpy(), side, group[0], similarity)
        some = np.flatnonzero((counts > 0) | (label != np.arange(len(label))))
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(node[label[some]]), pa.array(counts[some])], ["a", "b", "n"])

    links = tables.put("links", met.repartition("leaf", "i", "j").sortWithinPartitions("leaf", "i", "j", "node").mapInArrow(linked, "a long, b long, n long"))
    tables.drop(next(k for k in tables.paths if k.startswith("members")))
    counted = links.groupBy("a").agg(F.sum("n").alias("n"))
    own = reps.select("key", "rep", "weight")
    a, b = own.select(F.col("key").alias("a"), F.col("rep").alias("ra")), own.select(F.col("key").alias("b"), F.col("rep").alias("rb"))
    edges = links.filter("a <> b").join(a, "a").join(b, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    member = valid.join(reps.select("v", "rep", "weight", "key"), "v").select("id", "rep", "weight", "key")
    copies = member.filter("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    of_key = tables.put("counts", member.join(counted, F.col("key") == F.col("a"), "left").select("id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    classes = tables.put("classes", connected_components(edges.union(copies)))
    unlike = rows.filter(~usable(F.col("v"))).select("id", F.lit(0).cast("long").alias("n_links"))
    out = of_key.union(unlike).join(classes, F.col("id") == F.col("node"), "left").withColumn("c", F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_col), "n_links", F.col("c").alias("component_id"), (F.col("c") == F.col("id")).alias("kept"))


def near_sql(similarity: float = 0.95) -> str:
    """near_vectors() of embeddings in DuckDB SQL, by all pairs; for tables of a few hundred rows."""
    return f"""
WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= {similarity}),
r(a, b) AS (SELECT vec_id, vec_id FROM e UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS c FROM r GROUP BY a), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, c.c AS component_id, c.c = e.vec_id AS kept FROM e JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""

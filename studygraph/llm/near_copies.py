"""Near duplicates by order MinHash, verified by banded alignment.

A document is the sequence of its terms. Its occurrence-labelled k-mers (each run of k terms, told apart by how often it
occurred before) are hashed `keys` times; of each hashing the `kept` smallest k-mers, in the order of the text, make one
key. Documents that share a key are compared: first by the share of common labelled k-mers, which bounds what an
alignment can reach, then by the alignment itself, in a band as wide as the threshold allows. Links found so join
documents to classes.

Copies of one text are one node throughout. Documents that share a key are compared where they meet, in blocks of bounded
size, without writing a pair down that is not a link, and links inside one block only as far as they join classes.

A group that fills several blocks is first compared with a few leaders of its own. Most of its documents are then of one
class, and pairs within a class need no link; so only documents outside the group's largest class are compared with the
whole group. A group of n near copies thus costs about n comparisons, not n squared, and no link between classes is lost."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studygraph.llm import arrays
from studygraph.llm.components import connected_components
from studygraph.llm.shared import Written

#: Documents of a large group that all others of it are compared with first, about.
LEADERS = 16


def sketch(kmers: np.ndarray, keys: int, kept: int, seed: int = 1) -> np.ndarray:
    """The order MinHash keys of one sequence of labelled k-mers: for each seed, the hash of the `kept` k-mers with the
    smallest values in text order (all of them, if there are fewer)."""
    seeds = arrays.mix(np.arange(1, keys + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    out = np.empty(keys, np.uint64)
    step = max(1, (1 << 20) // max(1, len(kmers)))
    for at in range(0, keys, step):
        values = arrays.mix(kmers[None, :] ^ seeds[at : at + step, None])
        if len(kmers) > kept:
            least = np.sort(np.argpartition(values, kept - 1, axis=1)[:, :kept], axis=1)
            picked = kmers[least]
        else:
            picked = np.broadcast_to(kmers, (len(values), len(kmers)))
        total = seeds[at : at + step].copy()
        for k in range(picked.shape[1]):
            total = arrays.mix(total * np.uint64(31) + picked[:, k])
        out[at : at + step] = total
    return out


def kmers_of(hashes: np.ndarray, k: int) -> np.ndarray:
    """Labelled k-mers of one sequence of term hashes; a sequence shorter than k is one k-mer."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    return arrays.labelled(arrays.window_hashes(hashes, min(k, len(hashes))))


def aligned(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether the longest common subsequence of two sequences of distinct values, of length m, reaches
    m / (len(a) + len(b) - m) >= similarity. The alignment stays in the band of diagonals that the threshold allows: it
    follows the furthest reaching paths of 0, 1, 2 ... insertions and deletions and gives up past the number allowed."""
    n, m = len(a), len(b)
    least = similarity * (n + m) / (1 + similarity)
    most = int(np.floor(n + m - 2 * least + 1e-9))
    order = np.argsort(b)
    at = np.minimum(np.searchsorted(b, a, sorter=order), m - 1) if m else np.zeros(n, np.int64)
    place = np.where(b[order[at]] == a, order[at], -2) if m else np.full(n, -2)
    place = np.append(place, -2)
    goes_on = (place[1:] == place[:-1] + 1) & (place[:-1] >= 0)
    stops = np.where(~goes_on, np.arange(n), n)
    end = np.append(np.minimum.accumulate(stops[::-1])[::-1] + 1, n) if n else np.zeros(1, np.int64)
    x = np.zeros(1, np.int64)  # furthest x on diagonals -d, -d+2 .. d
    for d in range(most + 1):
        if d:
            right, down = np.append(-1, x) + 1, np.append(x, -1)
            x = np.maximum(right, down)
        k = np.arange(-d, d + 1, 2)
        x = np.minimum(np.minimum(x, n), m + k)
        y = x - k
        meets = (x >= 0) & (y >= 0) & (place[np.maximum(x, 0)] == y)
        x = np.where(meets, end[np.maximum(x, 0)], x)
        if ((x >= n) & (x - k >= m)).any():
            return True
    return False


def links_of(ids: np.ndarray, side: np.ndarray, texts: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links that join the documents of one block (side all 0), or of two blocks (side 0 and 1: only across), as far as
    documents are not joined already."""
    n = len(ids)
    parent = np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    sizes = np.array([len(t) for t in texts])
    values, inverse, often = np.unique(np.concatenate(texts), return_inverse=True, return_counts=True)
    first = np.concatenate(([0], np.cumsum(sizes)))
    # a document with too many k-mers that no other one here has is no near duplicate of any of them
    owned = np.array([(often[inverse[first[i] : first[i + 1]]] == 1).sum() for i in range(n)])
    alive = owned <= (1 - similarity) * sizes + 1e-9
    queries = np.flatnonzero(alive & (side == 0))
    others = np.flatnonzero(alive & (side == side.max()))
    if not len(queries) or not len(others):
        return []
    flat = np.concatenate([inverse[first[i] : first[i + 1]] for i in others])
    bounds = np.concatenate(([0], np.cumsum(sizes[others])))[:-1]
    has = np.zeros(len(values), bool)
    out = []
    for i in queries:
        mine = inverse[first[i] : first[i + 1]]
        has[mine] = True
        common = np.add.reduceat(has[flat], bounds, dtype=np.int64)
        has[mine] = False
        near = common >= similarity * (sizes[i] + sizes[others] - common) - 1e-9
        for j in others[near]:
            if (side[i] != side[j] or j > i) and root(i) != root(j) and aligned(texts[i], texts[j], similarity):
                parent[root(j)] = root(i)
                if ids[i] != ids[j]:
                    out.append((max(ids[i], ids[j]), min(ids[i], ids[j])))
    return out


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, similarity: float = 0.8, keys: int = 14, kept: int = 3, block: int = 512, block_terms: int = 1_000_000) -> DataFrame:
    """Per row of docs: the id, class_id (the smallest id of its class) and kept (id = class_id). Ids are integers.

    Texts with the same terms are copies (similarity 1). Texts without a term are copies of equal texts only; a null text
    is a copy of nothing. All rows of one id are one document: their classes are one. Rows without an id get a null class
    and kept null. An empty table gives no rows; other columns are not looked at.

    A pair of similarity s shares one key with a chance of about s**kept, so of 14 keys of 3 at least one with a chance
    of 0.9999 at 0.8 or more; any pair that shares a key is compared by its whole texts. Blocks hold about `block`
    documents and block_terms terms, or one document that is longer."""
    tables = Written(docs.sparkSession)

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.slices(batch, "text"):
                raw, offsets = arrays.text_bytes(part.column("text"))
                low, starts, ends, first = arrays.terms(raw, offsets)
                hashes = arrays.span_hashes(low, starts, ends)
                whole = arrays.span_hashes(raw, offsets[:-1], offsets[1:])
                many = np.diff(first)
                content, made = np.empty((len(part), 2), np.uint64), []
                for i in range(len(part)):
                    mine = hashes[first[i] : first[i + 1]]
                    if len(mine):
                        up, _ = arrays.powers(len(mine))
                        content[i] = (mine * up[: len(mine)]).sum(dtype=np.uint64), arrays.mix(mine ^ up[: len(mine)]).sum(dtype=np.uint64)
                        made.append(sketch(kmers_of(mine, k), keys, kept).view(np.int64))
                    else:
                        content[i] = whole[i], len(raw[offsets[i] : offsets[i + 1]])
                        made.append(np.zeros(0, np.int64))
                two = content.view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(two[:, 0]), pa.array(two[:, 1]), pa.array(made, pa.list_(pa.int64())), pa.array(many.astype(np.int64))], ["id", "h1", "h2", "keys", "terms"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = rows.filter("id IS NOT NULL AND text IS NOT NULL")
    sketches = tables.put("sketches", texts.mapInArrow(sketched, "id long, h1 long, h2 long, keys array<long>, terms long"))
    reps = sketches.groupBy("h1", "h2").agg(F.min_by("keys", "id").alias("keys"), F.min("id").alias("id"), F.min("terms").alias("terms"))
    copies = sketches.join(reps.select("h1", "h2", F.col("id").alias("rep")), ["h1", "h2"]).filter("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))

    member = tables.put("members", reps.select("id", "terms", F.explode(F.array_distinct("keys")).alias("key")))
    # keys with the same members are one group
    groups = (
        member.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("s1"), F.min("id").alias("s2"), F.sum("terms").alias("terms"))
        .filter("n > 1").groupBy("n", "s1", "s2", "terms").agg(F.min("key").alias("key"))
        .select("key", "n", F.ceil(F.greatest(F.col("n") / block, F.col("terms") / block_terms)).cast("int").alias("blocks"))
    )
    grouped = tables.put("grouped", member.join(groups, "key").select("key", "id", member["terms"], "n", "blocks", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("b")))
    tables.drop("members")

    def termed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.slices(batch, "text"):
                raw, offsets = arrays.text_bytes(part.column("text"))
                low, starts, ends, first = arrays.terms(raw, offsets)
                hashes = (arrays.span_hashes(low, starts, ends) >> np.uint64(32)).astype(np.uint32)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([hashes[first[i] : first[i + 1]].tobytes() for i in range(len(part))], pa.binary())], ["id", "terms"])

    wanted = grouped.select("id").distinct().hint("merge")  # one plan at every size: ids are never broadcast
    termed_rows = tables.put("terms", texts.join(wanted, "id").mapInArrow(termed, "id long, terms binary"))

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for batch in batches:
            for key, i, j, side, doc, terms in zip(*(batch.column(c).to_pylist() for c in ("key", "i", "j", "side", "id", "terms")), strict=True):
                if group != (key, i, j):
                    if len(held) > 1:
                        yield found(held)
                    group, held = (key, i, j), []
                held.append((doc, side, terms))
        if len(held) > 1:
            yield found(held)

    def found(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        sequences = [kmers_of(arrays.mix(np.frombuffer(t, np.uint32)), k) for _, _, t in held]
        out = links_of(np.array([d for d, _, _ in held]), np.array([s for _, s, _ in held]), sequences, similarity)
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], ["a", "b"])

    def links_in(placed: DataFrame) -> DataFrame:
        """Links within the blocks (key, i, j), or across their two sides."""
        blocks = placed.join(termed_rows, "id").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "id")
        return blocks.mapInArrow(linked, "a long, b long")

    def each(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    zero = F.lit(0)
    large = grouped.filter("blocks > 1")
    leads = large.filter(F.pmod(F.xxhash64("id", "key"), F.col("n")) < LEADERS).select("key", "id", each("blocks").alias("i"), zero.alias("j"), zero.alias("side"))
    led = large.select("key", "id", F.col("b").alias("i"), zero.alias("j"), F.lit(1).alias("side"))
    links = tables.put("links", links_in(grouped.filter("blocks = 1").select("key", "id", zero.alias("i"), zero.alias("j"), zero.alias("side")).union(leads).union(led)))
    edges, written = links, ["links"]
    if large.limit(1).count():
        so_far = tables.put("so_far", connected_components(links))
        held = large.join(so_far, F.col("id") == F.col("node"), "left").select("key", "id", "terms", "blocks", "b", F.coalesce("component", "id").alias("class"))
        main = held.groupBy("key", "class").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("class", F.struct("n", -F.col("class"))).alias("main"))
        rest = tables.put("rest", held.join(main, "key").filter("class <> main").select("key", "id", "terms", "blocks"))
        asked = rest.groupBy("key").agg(F.ceil(F.greatest(F.count("*") / block, F.sum("terms") / block_terms)).cast("int").alias("asks"))
        asking = rest.join(asked, "key").select("key", "id", F.pmod(F.xxhash64("id"), F.col("asks")).cast("int").alias("i"), each("blocks").alias("j"), zero.alias("side"))
        answering = large.join(asked, "key").select("key", "id", each("asks").alias("i"), F.col("b").alias("j"), F.lit(1).alias("side"))
        more = tables.put("more", links_in(asking.union(answering)))
        edges, written = so_far.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more), [*written, "so_far", "rest", "more"]
    tables.drop("grouped", "terms")
    classes = tables.put("classes", connected_components(edges.union(copies)))
    tables.drop("sketches", *written)
    return rows.select("id").join(classes, F.col("id") == F.col("node"), "left").select(F.col("id").alias(id_col), F.coalesce("component", "id").alias("class_id"), (F.coalesce("component", "id") == F.col("id")).alias("kept"))

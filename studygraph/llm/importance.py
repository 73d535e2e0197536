"""Importance resampling of documents toward a target collection, by hashed counts of word runs.

Each task holds a trie of words: a node is a run of one or more words, with the CRC-32 state of its text and either how
often it was met or the gain of its bucket. A child's state comes from its parent's, so no run's text is ever put
together. Counts leave a task as totals of buckets, whose number is fixed."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studygraph.llm import arrays
from studygraph.llm.shared import Written

#: A trie with more nodes, or more bytes of words, than this is emptied and begun anew; counts are kept as totals.
MOST_NODES, MOST_BYTES = 1 << 20, 32 << 20
#: Words up to this length extend CRC states by tables, longer ones byte by byte.
TABLED = 64


@lru_cache(TABLED + 1)
def advance_tables(n: int) -> np.ndarray:
    """How n zero bytes change a CRC-32 register: for each of its four bytes, the effect of each value."""
    ones = 0xFFFFFFFF
    bit = [zlib.crc32(bytes(n), (1 << b) ^ ones) ^ ones for b in range(32)]
    out = np.zeros((4, 256), np.uint32)
    for b, effect in enumerate(bit):
        out[b // 8, np.arange(256) >> (b % 8) & 1 == 1] ^= np.uint32(effect)
    return out


def advanced(states: np.ndarray, n: int) -> np.ndarray:
    """CRC-32 values moved past n bytes: advanced(crc(a), len(b)) ^ crc(b) is the CRC-32 of a and b."""
    t = advance_tables(n)
    return t[0][states & 255] ^ t[1][states >> 8 & 255] ^ t[2][states >> 16 & 255] ^ t[3][states >> 24]


class Grown:
    """An array that grows at its end."""

    def __init__(self, kind: type) -> None:
        self.data, self.n = np.zeros(1024, kind), 0

    def add(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.data):
            self.data = np.concatenate([self.data, np.zeros(max(len(values), len(self.data)), self.data.dtype)])
        self.data[self.n : self.n + len(values)] = values
        self.n += len(values)

    @property
    def now(self) -> np.ndarray:
        return self.data[: self.n]


class Level:
    """Nodes of one depth. From the second on, a node is found by its parent and its last word."""

    def __init__(self) -> None:
        self.keys, self.node = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.state, self.value = Grown(np.uint32), Grown(np.int64)


class WordTrie:
    """A trie of word runs up to a width. With gains, a node's value is the gain of its bucket; without, its count."""

    def __init__(self, width: int, buckets: int, gains: np.ndarray | None = None) -> None:
        self.width, self.buckets, self.gains = width, buckets, gains
        self.totals = np.zeros(buckets, np.int64)
        self.clear()

    def clear(self) -> None:
        self.word: dict[bytes, int] = {}
        self.spelled: list[bytes] = []
        self.spaced, self.length, self.bytes = Grown(np.uint32), Grown(np.int64), 0
        self.levels = [Level() for _ in range(self.width)]

    def flush(self) -> None:
        """Adds the counts of all nodes to the totals of their buckets and empties the trie."""
        for level in self.levels:
            at = (level.state.now % np.uint32(self.buckets)).astype(np.int64)
            self.totals += np.bincount(at, level.value.now, self.buckets).astype(np.int64)
        self.clear()

    def added(self, level: Level, states: np.ndarray) -> None:
        level.state.add(states)
        level.value.add(np.zeros(len(states), np.int64) if self.gains is None else self.gains[(states % np.uint32(self.buckets)).astype(np.int64)])

    def word_nodes(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The node of each word; new words become nodes."""
        if not len(starts):
            return np.zeros(0, np.int64)
        bounds = np.stack([starts, ends], 1).reshape(-1).astype(np.int64)  # words and what is between them by turns
        spans = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(raw))])
        coded = spans.take(pa.array(np.arange(0, len(bounds) - 1, 2))).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        fresh = [w for w in distinct if w not in self.word]
        self.word.update(zip(fresh, range(len(self.spelled), len(self.spelled) + len(fresh)), strict=True))
        self.spelled += fresh
        self.bytes += sum(map(len, fresh))
        self.spaced.add(np.array([zlib.crc32(w, zlib.crc32(b" ")) for w in fresh], np.uint32))
        self.length.add(np.array([len(w) for w in fresh], np.int64))
        self.added(self.levels[0], np.array([zlib.crc32(w) for w in fresh], np.uint32))
        return np.array([self.word[w] for w in distinct], np.int64)[coded.indices.to_numpy()]

    def child_nodes(self, depth: int, keys: np.ndarray) -> np.ndarray:
        """The nodes of distinct ascending keys (parent and last word) at a depth; new ones get their parent's state moved
        on by a space and the word."""
        level = self.levels[depth]
        at = np.searchsorted(level.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(level.keys)
        known[inside] = level.keys[at[inside]] == keys[inside]
        out = np.empty(len(keys), np.int64)
        out[known] = level.node[at[known]]
        fresh = keys[~known]
        out[~known] = level.state.n + np.arange(len(fresh))
        parent, word = self.levels[depth - 1].state.now[fresh >> 32], fresh & 0xFFFFFFFF
        length = self.length.now[word] + 1
        states = np.empty(len(fresh), np.uint32)
        order = np.argsort(length, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
            if len(some) and (n := int(length[some[0]])) <= TABLED:
                states[some] = advanced(parent[some], n) ^ self.spaced.now[word[some]]
            else:
                states[some] = [zlib.crc32(self.spelled[w], zlib.crc32(b" ", p)) for p, w in zip(parent[some].tolist(), word[some].tolist(), strict=True)]
        level.keys, level.node = np.insert(level.keys, at[~known], fresh), np.insert(level.node, at[~known], out[~known])
        self.added(level, states)
        return out

    def walk(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> Iterator[tuple[Level, np.ndarray, np.ndarray]]:
        """For each run length, (level, nodes, where the runs start) over the words of some texts."""
        if len(self.spelled) + sum(x.state.n for x in self.levels[1:]) > MOST_NODES or self.bytes > MOST_BYTES:
            self.flush()
        words = nodes = self.word_nodes(raw, starts, ends)
        at = np.arange(len(words))
        yield self.levels[0], nodes, at
        for depth in range(1, self.width):
            longer = arrays.window_starts(first, depth + 1)[at]
            at, nodes = at[longer], nodes[longer]
            keys, each = np.unique(nodes << 32 | words[at + depth], return_inverse=True)
            nodes = self.child_nodes(depth, keys)[each]
            yield self.levels[depth], nodes, at

    def count(self, *texts: np.ndarray) -> None:
        """Counts the runs of some texts: raw, starts, ends, first word of each."""
        for level, nodes, _ in self.walk(*texts):
            level.value.now[:] += np.bincount(nodes, minlength=level.value.n)

    def summed(self, *texts: np.ndarray) -> np.ndarray:
        """The sum of the gains of each text's runs."""
        first = texts[3]
        document = np.repeat(np.arange(len(first) - 1), np.diff(first))
        out = np.zeros(len(first) - 1, np.int64)
        for level, nodes, at in self.walk(*texts):
            out += np.bincount(document[at], level.value.now[nodes], len(out)).astype(np.int64)
        return out


def bucket_totals(docs: DataFrame, text_col: str = "text", width: int = 2, buckets: int = 10_000) -> np.ndarray:
    """How many word runs of all texts fall into each bucket. Tasks send totals of their own, one row a bucket."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = WordTrie(width, buckets)
        for batch in batches:
            for part in arrays.slices(batch, "text"):
                trie.count(*arrays.terms(*arrays.text_bytes(part.column("text"))))
        trie.flush()
        has = np.flatnonzero(trie.totals)
        yield pa.RecordBatch.from_arrays([pa.array(has, pa.int64()), pa.array(trie.totals[has], pa.int64())], ["bucket", "n"])

    parts = docs.select(F.col(text_col).alias("text")).mapInArrow(counted, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():  # one row a bucket
        out[bucket] = n
    return out


def gains_of(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket in thousandths: the logarithm of its smoothed share of the target over that of the raw
    collection, floored."""
    buckets, s_all, t_all = len(raw), int(raw.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets)))) for s, t in zip(raw.tolist(), target.tolist(), strict=True)], np.int64)


def noise(id_: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, floored, from the hash of seed and id; a null id counts as empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def score(docs: DataFrame, gains: np.ndarray, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", width: int = 2) -> DataFrame:
    """(id_col, n_words, n_features, weight, score) of every row. weight: the mean gain of a text's runs, floored, 0 where it
    has none; score: weight and noise."""

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = WordTrie(width, len(gains), gains)
        for batch in batches:
            for part in arrays.slices(batch, "text"):
                texts = arrays.terms(*arrays.text_bytes(part.column("text")))
                n = np.diff(texts[3])
                features = sum(np.maximum(n - k, 0) for k in range(width))
                weight = trie.summed(*texts) // np.maximum(features, 1)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(n, pa.int64()), pa.array(features, pa.int64()), pa.array(weight, pa.int64())], ["id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    done = rows.mapInArrow(weighed, f"id {docs.schema[id_col].dataType.simpleString()}, n_words long, n_features long, weight long")
    return done.select(F.col("id").alias(id_col), "n_words", "n_features", "weight", (F.col("weight") + noise(F.col("id"), seed)).alias("score"))


def ranked(scored: DataFrame, percent: int = 25, least_words: int = 20, id_col: str = "doc_id", part_rows: int = 1 << 20) -> DataFrame:
    """scored with a rank: of the N rows of at least least_words words, floor(percent * N / 100) are drawn by highest
    score, then smallest id (null last), and numbered from 1; all others have none.

    The lowest score drawn is found from the counts of scores, which are whole thousandths of logarithms, so of a range
    that does not grow with the data. Rows at or above it are sorted by ranges of score and id, and a row's rank is its
    place in its range and the rows of the ranges before."""
    tables = Written(scored.sparkSession)
    held = tables.put("scored", scored)
    fit = held.filter(F.col("n_words") >= least_words)
    counts = sorted(fit.groupBy("score").count().collect(), reverse=True)  # a row for each whole number in a fixed range
    most = percent * sum(n for _, n in counts) // 100
    lowest, above = None, 0
    for value, n in counts:
        if above >= most:
            break
        lowest, above = value, above + n
    if lowest is None:
        return held.withColumn("rank", F.lit(None).cast("long"))
    takes = (F.col("n_words") >= least_words) & (F.col("score") >= lowest)
    order = [F.desc("score"), F.asc_nulls_last(id_col), F.asc("_tie")]
    sorted_ = held.filter(takes).withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(above // part_rows + 1, *order).sortWithinPartitions(*order)
    placed = tables.put("ranges", sorted_.withColumn("_at", F.monotonically_increasing_id()).drop("_tie"))
    part, at = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    before, total = [], 0
    for number, n in sorted(placed.groupBy(part).count().collect()):  # a row for part_rows rows
        before.append((number, total))
        total += n
    offsets = scored.sparkSession.createDataFrame(before, "_part long, _before long")
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn("rank", F.col("_before") + at + 1)
    drawn = numbered.select(*held.columns, F.when(F.col("rank") <= most, F.col("rank")).alias("rank"))
    return drawn.unionByName(held.filter(~F.coalesce(takes, F.lit(False))).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7, width: int = 2, buckets: int = 10_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_words, n_features, weight, score, rank) of every row of docs, as ranked() gives them, by the shares of
    word runs in the target's texts and in all of docs.

    Words are runs of ASCII letters in lower case, digits and characters beyond ASCII; features all runs of 1 to width of
    them. Null and empty texts have no feature and weight 0; rows without id are scored like the others; of rows with one
    id and score each gets a rank of its own. Empty docs give no row; without a target all gains come from the raw counts.
    Other columns are not read. Texts are read twice, and only totals of buckets and rows of numbers are shuffled."""
    gains = gains_of(bucket_totals(docs, text_col, width, buckets), bucket_totals(target, text_col, width, buckets))
    return ranked(score(docs, gains, seed, id_col, text_col, width), percent, least_words, id_col)

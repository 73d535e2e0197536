"""Packing documents into as few sequences of fixed capacity as possible, by linear grouping and best fit.

Only the counts of piece lengths matter to the plan, and there are no more lengths than the capacity, so planning is a
small job on the driver whatever the corpus. Large lengths are rounded up within groups of equal cardinality; sequences
of the few rounded lengths are found by column generation; then actual pieces take the places of rounded ones, and small
pieces go where they fit best. The plan names runs: the pieces of one length, in their order, from one number to another,
go to consecutive sequences at one offset. Pieces find their run by a join."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from studygraph.llm import arrays
from studygraph.llm.encoding import encoder
from studygraph.llm.shared import Written

#: (length, number of its first piece, pieces, first sequence, offset)
Run = tuple[int, int, int, int, int]


def grouped(counts: dict[int, int], groups: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Lengths with counts, dealt to at most `groups` groups of equal cardinality by size: each group's largest length
    (to which all of it is rounded), and its (length, count) from the largest down."""
    total = sum(counts.values())
    out: list[tuple[int, list[tuple[int, int]]]] = []
    each = -(-total // groups) if total else 1
    room = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                out.append((length, []))
                room = each
            n = min(left, room)
            out[-1][1].append((length, n))
            left -= n
            room -= n
    return out


def best_pattern(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes within capacity of greatest worth (an unbounded knapsack): its worth, and how many of each."""
    value = np.zeros(capacity + 1)  # of each room the most that fits in it
    for size, gain in zip(sizes.tolist(), worth.tolist(), strict=True):
        for _ in range(capacity // size if gain > 0 else 0):
            np.maximum(value[size:], value[:-size] + gain, out=value[size:])
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    while True:
        fits = np.flatnonzero((sizes <= room) & (worth > 0))
        last = fits[value[room - sizes[fits]] + worth[fits] >= value[room] - 1e-9]
        if not len(last):
            return float(value[capacity]), pattern
        pattern[last[0]] += 1
        room -= int(sizes[last[0]])


def patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int, most_steps: int = 2000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns: how many of each size) and how often each is used, fractions allowed, to cover the demand with
    the fewest uses: the linear program of cutting stock, solved by column generation. After most_steps columns, some ten
    times as many as were needed, the best found so far is used: every piece still has its place."""
    n = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    used = np.linalg.solve(basis, demand.astype(float))
    for _ in range(most_steps):
        price = np.linalg.solve(basis.T, np.ones(n))
        worth, pattern = best_pattern(sizes, np.maximum(price, 0), capacity)
        if worth <= 1 + 1e-4:  # no pattern would save a ten-thousandth of the sequences
            break
        step = np.linalg.solve(basis, pattern.astype(float))
        ratio = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        used = np.maximum(used - step * ratio[out], 0)
        used[out] = ratio[out]
        basis[:, out] = pattern
    return basis.astype(np.int64), used


class Bins:
    """Open sequences by what is left of them: runs of consecutive sequences with one room."""

    def __init__(self) -> None:
        self.rooms: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def add(self, room: int, first: int, n: int) -> None:
        if n and room:
            if room not in self.runs:
                bisect.insort(self.rooms, room)
                self.runs[room] = []
            self.runs[room].append((first, n))

    def take(self, length: int, most: int) -> tuple[int, int, int] | None:
        """Up to `most` consecutive sequences with the least room for length: room, first sequence, how many."""
        at = bisect.bisect_left(self.rooms, length)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        first, n = self.runs[room].pop()
        k = min(n, most)
        if n > k:
            self.runs[room].append((first + k, n - k))
        if not self.runs[room]:
            del self.runs[room]
            self.rooms.pop(at)
        return room, first, k


#: How plans are tried: groups of large lengths, and the part of the capacity beyond which a length is large. Without groups
#: all pieces are placed by best fit alone.
TRIED = ((20, 1 / 4), (80, 1 / 3), (160, 1 / 4), (40, 1 / 8), (80, 1 / 8), (0, 1), (160, 1 / 8))


def plan(counts: dict[int, int], capacity: int, tried: tuple[tuple[int, float], ...] = TRIED) -> tuple[list[Run], int]:
    """Runs that place `counts[length]` pieces of each length, and the number of sequences: of the plans tried the one with
    the fewest, the first of those. No further one is tried once the tokens could not be held by fewer."""
    least = -(-sum(x * n for x, n in counts.items()) // capacity)
    best: tuple[list[Run], int] | None = None
    for groups, large in tried:
        found = planned(counts, capacity, groups, large)
        if best is None or found[1] < best[1]:
            best = found
        if best[1] <= least:
            break
    return best or ([], 0)


class Left:
    """The pieces that are still to be placed, by rounded size and length. Sizes stand from the largest down."""

    def __init__(self, dealt: list[tuple[int, list[tuple[int, int]]]], sizes: np.ndarray) -> None:
        place = {int(s): i for i, s in enumerate(sizes)}
        self.of: dict[int, dict[int, int]] = {}  # length: group: pieces
        self.lengths: list[list[int]] = [[] for _ in sizes]  # of each group, from the largest down
        self.demand = np.zeros(len(sizes), np.int64)
        for rounded, members in dealt:
            i = place[rounded]
            for length, n in members:
                self.of.setdefault(length, {})
                if i not in self.of[length]:
                    self.lengths[i].append(length)
                self.of[length][i] = self.of[length].get(i, 0) + n
                self.demand[i] += n
        self.all = sorted(self.of)

    def take(self, length: int, group: int, n: int) -> None:
        self.of[length][group] -= n
        self.demand[group] -= n
        if not self.of[length][group]:
            del self.of[length][group]
            if not self.of[length]:
                del self.of[length]
                self.all.pop(bisect.bisect_left(self.all, length))

    def largest(self, group: int) -> tuple[int, int]:
        """The largest length that a group still has, and how many."""
        while group not in self.of.get(self.lengths[group][0], {}):
            self.lengths[group].pop(0)
        return self.lengths[group][0], self.of[self.lengths[group][0]][group]

    def fitting(self, room: int) -> tuple[int, int, int] | None:
        """The largest length of all that fits a room, one of its groups, and how many it has."""
        at = bisect.bisect_right(self.all, room)
        if not at:
            return None
        group, n = next(iter(self.of[self.all[at - 1]].items()))
        return self.all[at - 1], group, n


def planned(counts: dict[int, int], capacity: int, groups: int, large: float) -> tuple[list[Run], int]:
    """One plan, with the lengths beyond the part `large` of the capacity in `groups` groups; see plan()."""
    runs: list[Run] = []
    given = dict.fromkeys(counts, 0)
    bins, sequences = Bins(), 0

    def put(length: int, n: int, first: int, offset: int) -> None:
        runs.append((length, given[length], n, first, offset))
        given[length] += n

    for length in sorted((x for x in counts if x == capacity), reverse=True):
        put(length, counts[length], sequences, 0)
        sequences += counts[length]
    big = {x: n for x, n in counts.items() if capacity * large < x < capacity and n}
    dealt = grouped(big, groups) if groups else []
    if dealt:
        # groups of one rounded length are one size
        sizes = np.array(sorted({g[0] for g in dealt}, reverse=True))
        left = Left(dealt, sizes)
        basis, used = patterns(sizes, left.demand, capacity)
        for k in np.argsort(-used, kind="stable"):
            column, times = basis[:, k], int(used[k] + 1e-6)
            times = min([times, *(int(left.demand[i] // column[i]) for i in np.flatnonzero(column))])
            if not times or not column.any():
                continue
            # actual pieces take the places of rounded ones, each the largest of its group; the last place of a sequence
            # goes to the largest piece of all that fits the room that the others have left in fact
            places = [int(i) for i in np.flatnonzero(column) for _ in range(column[i])]
            room = [(capacity, sequences, times)]
            sequences += times
            for i in places[:-1]:
                after = []
                for free, first, n in room:
                    while n:
                        length, have = left.largest(i)
                        m = min(n, have)
                        put(length, m, first, capacity - free)
                        left.take(length, i, m)
                        after.append((free - length, first, m))
                        first, n = first + m, n - m
                room = after
            for free, first, n in room:
                while n:
                    found = left.fitting(free)
                    if found is None:
                        bins.add(free, first, n)
                        break
                    length, group, have = found
                    m = min(n, have)
                    put(length, m, first, capacity - free)
                    left.take(length, group, m)
                    bins.add(free - length, first, m)
                    first, n = first + m, n - m
    for length in sorted(counts, reverse=True):
        rest = counts[length] - given[length]
        while rest:
            found = bins.take(length, rest)
            if found is None:
                each = capacity // length if length else rest  # a new sequence takes as many of this length as it can
                full = -(-rest // each)
                sequences += full
                bins.add(capacity, sequences - full, full)
                continue
            room_, first, n = found
            put(length, n, first, capacity - room_)
            bins.add(room_ - length, first, n)
            rest -= n
    return runs, sequences


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Each row's ids, end_id last, in pieces of capacity: id, piece, start, length, ids (binary, little-endian unsigned
    32-bit) where asked for, ids_crc32, and _chunk and _nth, which number the pieces of one length within a task."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        from pyspark import TaskContext

        chunk, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        encode = encoder(tokenizer).encode
        for batch in batches:
            for part in arrays.slices(batch, "text"):
                ids, offsets = encode(part.column("text"))
                ends = offsets[1:] + np.arange(1, len(offsets))  # with an end id each
                flat = np.insert(ids, offsets[1:], np.uint32(end_id)).astype("<u4")
                sizes = np.diff(np.concatenate(([0], ends)))
                many = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), many)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                start = piece * capacity
                length = np.minimum(sizes[row] - start, capacity)
                begin = (ends - sizes)[row] + start
                order = np.argsort(length, kind="stable")
                head = np.searchsorted(length[order], length[order])
                nth = np.empty(len(length), np.int64)
                nth[order] = np.arange(len(order)) - head
                nth += seen[length]
                seen += np.bincount(length, minlength=capacity + 1)
                raw = memoryview(flat.tobytes())
                spans = [raw[4 * b : 4 * (b + n)] for b, n in zip(begin.tolist(), length.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array([zlib.crc32(s) for s in spans], pa.int64()),
                        pa.array(np.full(len(row), chunk), pa.int32()), pa.array(nth), pa.array([bytes(s) for s in spans] if with_ids else [None] * len(spans), pa.binary()),
                    ],
                    ["id", "piece", "start", "length", "ids_crc32", "_chunk", "_nth", "ids"],
                )

    return rows.mapInArrow(cut, "id long, piece int, start long, length long, ids_crc32 long, _chunk int, _nth long, ids binary")


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Per piece of a row: the id, piece (from 0), start (tokens of its row before it), length, ids_crc32, sequence_id and
    offset (its place there; a sequence is filled from 0 without gaps), and with with_ids the ids themselves.

    Only rows of more than capacity tokens are cut. A null or empty text is the end id alone. Repeated rows and rows
    without an id are packed like all others. An empty table gives no rows; other columns are not looked at. Pieces of
    one length are interchangeable, so they take their places in no particular order.

    The lengths' counts (at most `capacity` rows) and the plan made of them (runs, a few per length) are all that the
    driver sees; the plan is broadcast by length: at most `capacity` rows of a few runs each."""
    spark = docs.sparkSession
    tables = Written(spark)
    cut = tables.put("pieces", pieces(docs, tokenizer, end_id, capacity, id_col, text_col, with_ids))
    chunks = cut.groupBy("length", "_chunk").agg(F.count("*").alias("_n"))
    counts = {r["length"]: r["n"] for r in chunks.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    runs, _ = plan(counts, capacity)
    by_length: dict[int, list[Run]] = {}
    for run in runs:
        by_length.setdefault(run[0], []).append(run)
    rows = [(length, [r[1] for r in found], [r[3] for r in found], [r[4] for r in found]) for length, found in by_length.items()]
    planned = spark.createDataFrame(rows, "length long, _from array<long>, _sequence array<long>, _offset array<long>")
    before = Window.partitionBy("length").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = chunks.select("length", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    placed = cut.join(bases, ["length", "_chunk"]).withColumn("_number", F.col("_base") + F.col("_nth")).join(F.broadcast(planned), "length")
    at = run_of(F.col("_from"), F.col("_number"))
    out = placed.withColumn("_at", at).select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32",
        (F.element_at("_sequence", F.col("_at")) + F.col("_number") - F.element_at("_from", F.col("_at"))).alias("sequence_id"), F.element_at("_offset", F.col("_at")).alias("offset"),
        *(["ids"] if with_ids else []),
    )
    return out


def run_of(starts: Column, number: Column) -> Column:
    """The position (from 1) of the last start that is not above number; starts ascend from 0."""
    return F.size(F.filter(starts, lambda s: s <= number))

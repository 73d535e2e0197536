"""Exact copies, found by a lasting index of the digests met so far.

The index lies in parts by digest. A part is a file: a minimal perfect hash over its distinct digests and, slot by slot, the
whole digest, the place and length of the document that stays for it, and how many documents had it. A look-up goes
to one slot and compares all 32 bytes. A batch that comes later asks the index once for each of its digests: members add to
their slot, and may take it over if they are better; others are groups of their own and get new slots."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studygraph.llm import arrays
from studygraph.llm.shared import Written, fresh_path
from studygraph.llm.token_store import PerfectHash, dump, load, opened

DIGEST = 32
#: Digests of a part of the index, and rows that one task looks up in it, about.
PART_KEYS = PART_ROWS = 1 << 16
#: What a slot holds beside its digest: the document that stays (code points, id or none, row), and documents in all.
SLOT = {"chars": np.int64, "has_id": np.bool_, "id": np.int64, "row": np.int64, "size": np.int64}


def digests(docs: DataFrame, id_col: str, text_col: str, keep: dict[str, Column]) -> DataFrame:
    """(id, digest, chars, and the columns of keep) of every row: SHA-256 of the text without white space, its code points."""
    names = list(keep)
    kept = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *(c.alias(n) for n, c in keep.items()))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in arrays.slices(batch, "text"):
                raw, offsets = arrays.text_bytes(some.column("text"))
                stays = ~arrays._SPACE[raw]
                at = np.concatenate(([0], np.cumsum(stays)))[offsets]
                chars = np.diff(np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))[offsets])
                left = memoryview(raw[stays].tobytes())
                found = pa.array([hashlib.sha256(left[a:z]).digest() for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([some.column("id"), found, pa.array(chars, pa.int64()), *(some.column(n) for n in names)], ["id", "digest", "chars", *names])

    fields = "".join(f", {n} {kept.schema[n].dataType.simpleString()}" for n in keep)
    return kept.mapInArrow(told, f"id long, digest binary, chars long{fields}")


def part_of(digest: Column, parts: int) -> Column:
    """The index part of a digest, by its bytes 9 to 15; the hash inside a part uses the first eight."""
    return F.pmod(F.conv(F.hex(F.substring(digest, 9, 7)), 16, 10).cast("long"), F.lit(parts))


def grouped(rows: DataFrame, parts: int) -> DataFrame:
    """A row for each distinct digest of rows: the best document's chars, id and row, and the number of documents. Tasks
    group their own rows first, so a text that all have is a row from each task."""
    best = F.min(F.struct((-F.col("chars")).alias("less"), F.col("id").isNull().alias("no_id"), "id", "row")).alias("best")
    found = rows.groupBy("digest").agg(best, F.count("*").alias("size"))
    return found.select(part_of(F.col("digest"), parts).alias("part"), "digest", (-F.col("best.less")).alias("chars"), F.col("best.id").alias("id"), F.col("best.row").alias("row"), "size")


def digest_bytes(column: pa.Array) -> np.ndarray:
    """The digests of a binary column as rows of 32 bytes."""
    return arrays.text_bytes(column)[0].reshape(-1, DIGEST)


@dataclass
class Part:
    """One part of the index. Digests that share their first eight bytes with another are not hashed but listed last."""

    hash: PerfectHash
    digest: np.ndarray
    slots: dict[str, np.ndarray]

    def __post_init__(self) -> None:
        hashed = int(self.hash.before[-1]) + len(self.hash.rest)
        self.listed = {bytes(d): hashed + i for i, d in enumerate(self.digest[hashed:])}

    @staticmethod
    def values(digest: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(digest[:, :8]).view("<u8").reshape(-1)

    @classmethod
    def build(cls, digest: np.ndarray, slots: dict[str, np.ndarray]) -> Part:
        values = cls.values(digest)
        _, each, times = np.unique(values, return_inverse=True, return_counts=True)
        alone = times[each] == 1
        made = PerfectHash.build(values[alone])
        order = np.concatenate([np.flatnonzero(alone)[np.argsort(made.slots(values[alone]))], np.flatnonzero(~alone)])
        return cls(made, digest[order], {k: v[order] for k, v in slots.items()})

    def find(self, digest: np.ndarray) -> np.ndarray:
        """The slot of each digest, or -1: the slot's 32 bytes are compared."""
        if not len(self.digest) or not len(digest):
            return np.full(len(digest), -1)
        slot = self.hash.slots(self.values(digest))
        slot[(slot < 0) | (self.digest[slot] != digest).any(1)] = -1
        if self.listed:
            for i in np.flatnonzero(slot < 0).tolist():
                slot[i] = self.listed.get(bytes(digest[i]), -1)
        return slot

    def extended(self, digest: np.ndarray, new: dict[str, np.ndarray]) -> tuple[Part, int]:
        """With a batch's groups, one for each digest, and how many of them were members."""
        slot = self.find(digest)
        member = slot >= 0
        at = slot[member]
        mine, held = {k: v[member] for k, v in new.items()}, {k: v.copy() for k, v in self.slots.items()}
        old = {k: v[at] for k, v in held.items()}
        better, tied = np.zeros(len(at), bool), np.ones(len(at), bool)
        for a, b in ((-mine["chars"], -old["chars"]), (~mine["has_id"], ~old["has_id"]), (mine["id"], old["id"]), (mine["row"], old["row"])):
            better |= tied & (a < b)
            tied &= a == b
        for k in ("chars", "has_id", "id", "row"):
            held[k][at[better]] = mine[k][better]
        held["size"][at] += mine["size"]
        if member.all():
            return replace(self, slots=held), int(member.sum())
        return Part.build(np.concatenate([self.digest, digest[~member]]), {k: np.concatenate([held[k], new[k][~member]]) for k in held}), int(member.sum())

    def write(self, name: str) -> None:
        levels = {f"level{i}": x for i, x in enumerate(self.hash.levels)}
        fs, place = opened(name)
        fs.create_dir(place.rpartition("/")[0], recursive=True)
        with fs.open_output_stream(place) as out:
            out.write(dump({**levels, "rest": self.hash.rest, "digest": self.digest.reshape(-1), **self.slots}))

    @classmethod
    def read(cls, name: str | None) -> Part:
        if name is None:
            return cls(PerfectHash([], np.zeros(0, np.uint64)), np.zeros((0, DIGEST), np.uint8), {k: np.zeros(0, t) for k, t in SLOT.items()})
        fs, place = opened(name)
        with fs.open_input_file(place) as f:
            held = load(f.read())
        levels = [held.pop(f"level{i}") for i in range(sum(k.startswith("level") for k in held))]
        return cls(PerfectHash(levels, held.pop("rest")), held.pop("digest").reshape(-1, DIGEST), held)


@dataclass(frozen=True)
class DigestIndex:
    """An index of digests: files, a table (part, path, digests, members) with a row for each part that has digests, is
    which files count; a file that a lost task wrote is in no such table. members: how many groups of the last batch the
    part had already."""

    spark: SparkSession
    path: str
    parts: int
    files: DataFrame | None = None

    @classmethod
    def new(cls, spark: SparkSession, keys: int, part_keys: int = PART_KEYS) -> DigestIndex:
        """An empty index with parts for about as many digests as will come; with more, its parts grow."""
        return cls(spark, fresh_path(spark, "digests"), keys // part_keys + 1)

    def extended(self, rows: DataFrame) -> DigestIndex:
        """The index with the rows (id, row, digest, chars) of one more batch, in files beside those of before."""
        folder = f"{self.path}/{uuid.uuid4().hex}"

        def merged(got: pa.Table, known: pa.Table) -> pa.Table:
            names = ["part", "path", "digests", "members"]
            if not len(got):
                return known.set_column(3, "members", pa.array([0], pa.int64()))
            ids = got.column("id").combine_chunks()
            new = {k: got.column(k).to_numpy() for k in ("chars", "row", "size")} | {"has_id": ids.is_valid().to_numpy(zero_copy_only=False), "id": pa.compute.fill_null(ids, 0).to_numpy()}
            done, members = Part.read(known.column("path")[0].as_py() if len(known) else None).extended(digest_bytes(got.column("digest").combine_chunks()), new)
            name = f"{folder}/{uuid.uuid4().hex}.digests"
            done.write(name)
            return pa.table([pa.array([got.column("part")[0].as_py()], pa.int64()), pa.array([name]), pa.array([len(done.digest)], pa.int64()), pa.array([members], pa.int64())], names)

        fields = "part long, path string, digests long, members long"
        files = self.files if self.files is not None else self.spark.createDataFrame([], fields)
        # a part meets its groups whole: cogrouping asks Spark for that, a repartition() behind a join would not
        told = grouped(rows, self.parts).groupBy("part").cogroup(files.groupBy("part")).applyInArrow(merged, fields)
        return replace(self, files=Written(self.spark).put("files", told))

    def found(self, rows: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
        """rows (id, row, digest, chars) with keep_id, keep_row and group_size of their digests; rows of digests that the
        index lacks are left out. Rows go to tasks by part; a part that very many rows ask, as where one text is a third
        of all, is read by as many tasks as its rows need."""

        def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            name, part = None, Part.read(None)
            for batch in batches:
                paths = batch.column("path").dictionary_encode()
                for code, file in enumerate(paths.dictionary.to_pylist()):
                    if file != name:
                        name, part = file, Part.read(file)
                    mine = batch.filter(pa.compute.equal(paths.indices, code))
                    slot = part.find(digest_bytes(mine.column("digest")))
                    mine, slot = mine.filter(pa.array(slot >= 0)), slot[slot >= 0]
                    s = part.slots
                    keep_id = pa.array(s["id"][slot], pa.int64(), mask=~s["has_id"][slot])
                    yield pa.RecordBatch.from_arrays([mine.column("id"), mine.column("row"), mine.column("digest"), keep_id, pa.array(s["row"][slot]), pa.array(s["size"][slot])], ["id", "row", "digest", "keep_id", "keep_row", "group_size"])

        if self.files is None:
            return rows.select("id", "row", "digest", *(F.lit(None).cast("long").alias(c) for c in ("keep_id", "keep_row", "group_size"))).filter("false")
        asking = rows.select("id", "row", "digest", part_of(F.col("digest"), self.parts).alias("part"))
        tasks = asking.groupBy("part").agg((F.floor(F.count("*") / part_rows) + 1).alias("tasks"))
        dealt = asking.join(self.files.select("part", "path").join(tasks, "part"), "part").withColumn("turn", F.pmod(F.xxhash64("row"), F.col("tasks")))
        ready = dealt.repartition("part", "turn").sortWithinPartitions("part").select("id", "row", "digest", "path")
        return ready.mapInArrow(looked_up, "id long, row long, digest binary, keep_id long, keep_row long, group_size long")


def exact_copies(docs: DataFrame, history: Column, id_col: str = "doc_id", text_col: str = "text", part_keys: int = PART_KEYS, part_rows: int = PART_ROWS) -> DataFrame:
    """(id_col, keep_id, group_size, kept, text_sha256) of every row of docs: which of the rows with the same text stays.

    Texts are the same if they are identical without white space (`[\\x20\\x09-\\x0D]`); null is the empty text. Of the same
    texts the one with most code points stays, then the smallest id (null last), then the first row: of rows that repeat
    both id and text, one is kept. Ids are whole numbers. Rows for which the condition history holds are indexed first,
    the others (or where it is null) come as a later batch; the result does not depend on it. Empty docs give no row; other
    columns are not read. A text is read once and hashed; only digests and numbers are shuffled."""
    tables = Written(docs.sparkSession)
    rows = tables.put("digests", digests(docs, id_col, text_col, {"old": F.coalesce(history, F.lit(False))}).withColumn("row", F.monotonically_increasing_id()))
    index = DigestIndex.new(docs.sparkSession, rows.count(), part_keys).extended(rows.filter("old")).extended(rows.filter("NOT old"))
    done = index.found(rows, part_rows)
    return done.select(F.col("id").alias(id_col), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def copies_sql() -> str:
    """DuckDB SQL for exact_copies() over documents with distinct ids."""
    return """
    WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[ \\t\\n\\v\\f\\r]', '', 'g')) AS h FROM documents)
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size, doc_id = first_value(doc_id) OVER w AS kept, h AS text_sha256
    FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id)"""

"""Token ids of documents in binary shards, with a minimal perfect hash index from keys to places.

A store is a folder:
- shards: 16 bytes of header (magic, bytes per id), then raw ids, little-endian, of documents in ascending order of id;
- index parts, by hash of key: a minimal perfect hash over the part's keys and, by its slots, a fingerprint of the key,
  the shard, the document's first id in it and its number of ids;
- manifests (Parquet): which shard and index files count. A task that is run again writes new files, and the manifest
  names those of the attempt that Spark took; files that no manifest names are not part of the store.

A key is a document's id and, for rows that repeat an id, their number in order of text (0 for the first). A look-up reads
one slot: hash, fingerprint, place."""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from studygraph.llm import arrays
from studygraph.llm.encoding import encoder
from studygraph.llm.substrings import by_key

_HEADER = 16
_NO_ID = (1 << 63) - 1


def opened(path: str) -> tuple[pa.fs.FileSystem, str]:
    """A path's file system and its path there."""
    return pa.fs.FileSystem.from_uri(path)


def key_hashes(ids: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """64-bit hashes of keys (id, number)."""
    return arrays.mix(arrays.mix(ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) + nth.astype(np.uint64))


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    return (arrays.mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """A minimal perfect hash over distinct 64-bit values: a cascade of bit arrays. A value whose place in a level no other
    value shares sets the bit there; the others go on to the next, smaller level. A value's slot is the number of bits
    set before its own. The few values that no level separates are listed, and take the last slots in ascending order."""

    LEVELS, ROOM = 24, 2.0

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray) -> None:
        self.levels, self.rest = levels, rest
        counts = [int(np.bitwise_count(x).sum()) for x in levels]
        self.before = np.concatenate(([0], np.cumsum(counts))).astype(np.int64)
        self.ranks = [np.concatenate(([0], np.cumsum(np.bitwise_count(x), dtype=np.int64))) for x in levels]

    @staticmethod
    def place(values: np.ndarray, level: int, bits: int) -> np.ndarray:
        return (arrays.mix(values + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) % np.uint64(bits)).astype(np.int64)

    @classmethod
    def build(cls, values: np.ndarray) -> PerfectHash:
        levels, left = [], values
        while len(left) and len(levels) < cls.LEVELS:
            bits = max(64, int(len(left) * cls.ROOM) // 64 * 64 + 64)
            at = cls.place(left, len(levels), bits)
            alone = np.bincount(at, minlength=bits) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            left = left[~alone[at]]
        return cls(levels, np.sort(left))

    def slots(self, values: np.ndarray) -> np.ndarray:
        """The slots of values; of a value that was not built in, any slot or -1."""
        out = np.full(len(values), -1, np.int64)
        todo = np.arange(len(values))
        for i, words in enumerate(self.levels):
            at = self.place(values[todo], i, len(words) * 64)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            has = (words[word] >> bit) & np.uint64(1) > 0
            w, b, t = word[has], bit[has], todo[has]
            low = words[w] & ((np.uint64(1) << b) - np.uint64(1))
            out[t] = self.before[i] + self.ranks[i][w] + np.bitwise_count(low)
            todo = todo[~has]
        if len(self.rest) and len(todo):
            at = np.minimum(np.searchsorted(self.rest, values[todo]), len(self.rest) - 1)
            same = self.rest[at] == values[todo]
            out[todo[same]] = self.before[-1] + at[same]
        return out


def dump(columns: dict[str, np.ndarray]) -> bytes:
    head = json.dumps([[k, v.dtype.str, len(v)] for k, v in columns.items()]).encode()
    return b"".join([len(head).to_bytes(8, "little"), head, *[v.tobytes() for v in columns.values()]])


def load(data: bytes) -> dict[str, np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    out, at = {}, 8 + n
    for name, kind, length in json.loads(data[8 : 8 + n]):
        out[name] = np.frombuffer(data, kind, length, at)
        at += out[name].nbytes
    return out


@dataclass(frozen=True)
class IndexPart:
    """One part of the index, as read from its file."""

    hash: PerfectHash
    fingerprint: np.ndarray
    shard: np.ndarray
    begin: np.ndarray
    length: np.ndarray

    @classmethod
    def build(cls, hashes: np.ndarray, shard: np.ndarray, begin: np.ndarray, length: np.ndarray) -> IndexPart:
        made = PerfectHash.build(hashes)
        order = np.argsort(made.slots(hashes))
        return cls(made, fingerprints(hashes)[order], shard[order].astype(np.uint32), begin[order].astype(np.uint64), length[order].astype(np.uint64))

    def to_bytes(self) -> bytes:
        levels = {f"level{i}": x for i, x in enumerate(self.hash.levels)}
        return dump({**levels, "rest": self.hash.rest, "fingerprint": self.fingerprint, "shard": self.shard, "begin": self.begin, "length": self.length})

    @classmethod
    def from_bytes(cls, data: bytes) -> IndexPart:
        held = load(data)
        levels = [held.pop(f"level{i}") for i in range(sum(k.startswith("level") for k in held))]
        return cls(PerfectHash(levels, held.pop("rest")), **held)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(found, shard, begin, length) of keys by their hashes; a key is found if its slot has its fingerprint."""
        if not len(self.fingerprint):
            zero = np.zeros(len(hashes), np.int64)
            return zero > 0, zero, zero, zero
        slot = self.hash.slots(hashes)
        found = (slot >= 0) & (self.fingerprint[slot] == fingerprints(hashes))
        return found, self.shard[slot].astype(np.int64), self.begin[slot].astype(np.int64), self.length[slot].astype(np.int64)


def read_part(path: str) -> IndexPart:
    fs, at = opened(path)
    with fs.open_input_file(at) as f:
        return IndexPart.from_bytes(f.read())


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = 16 << 20, part_keys: int = 1 << 20) -> TokenStore:
    """Encodes every whole text, end_id last, and writes a store under path, which driver and executors must share.

    Null text is the empty text. Rows without an id come last, numbered by text. An empty table makes an empty store. Texts
    go once through a shuffle by ranges of ids; shards and index parts grow in number, not in size."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = 2 if max(encoder(tokenizer).tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    kind = f"<u{width}"

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, name = TaskContext.get().partitionId(), f"{path}/shards/{uuid.uuid4().hex}.ids"
        encode, out, at, last, nth = encoder(tokenizer).encode, None, 0, None, 0
        for batch in batches:
            for part in arrays.slices(batch, "text"):
                if out is None:
                    fs, place = opened(name)
                    fs.create_dir(place.rpartition("/")[0], recursive=True)
                    out = fs.open_output_stream(place)
                    out.write(b"token-ids" + bytes(6) + bytes([width]))
                ids, offsets = encode(part.column("text"))
                out.write(np.insert(ids, offsets[1:], np.uint32(end_id)).astype(kind).tobytes())
                sizes = np.diff(offsets) + 1
                begin = at + np.cumsum(sizes) - sizes
                at += int(sizes.sum())
                numbers = []
                for i in part.column("id").to_pylist():
                    nth = nth + 1 if i == last else 0
                    last = i
                    numbers.append(nth)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(numbers, pa.int64()), pa.array(np.full(len(part), shard), pa.int32()), pa.array(begin), pa.array(sizes), pa.array([name] * len(part))], ["id", "nth", "shard", "begin", "length", "path"]
                )
        if out is not None:
            out.close()

    ranged = rows.repartitionByRange(int(size // shard_bytes) + 1, "id").sortWithinPartitions("id", "text")
    ranged.mapInArrow(encoded, "id long, nth long, shard int, begin long, length long, path string").write.parquet(f"{path}/entries")
    entries = spark.read.parquet(f"{path}/entries")
    entries.groupBy("shard", "path").agg(F.sum("length").alias("length"), F.count("*").alias("documents")).write.parquet(f"{path}/shard_files")
    parts = int(entries.count() // part_keys) + 1

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, mine in by_key(batches, "part"):
            held = pa.Table.from_batches(list(mine))
            c = {k: held.column(k).to_numpy() for k in ("id", "nth", "shard", "begin", "length")}
            name = f"{path}/index/{uuid.uuid4().hex}.mph"
            fs, place = opened(name)
            fs.create_dir(place.rpartition("/")[0], recursive=True)
            with fs.open_output_stream(place) as out:
                out.write(IndexPart.build(key_hashes(c["id"], c["nth"]), c["shard"], c["begin"], c["length"]).to_bytes())
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([name]), pa.array([len(held)], pa.int64())], ["part", "path", "keys"])

    dealt = entries.withColumn("part", part_of(F.col("id"), parts)).repartition("part").sortWithinPartitions("part")
    dealt.mapInArrow(indexed, "part int, path string, keys long").write.parquet(f"{path}/index_files")
    return TokenStore(spark, path, parts, width)


def part_of(id_: Column, parts: int) -> Column:
    """The index part of an id."""
    return F.pmod(F.crc32(id_.cast("string").cast("binary")), F.lit(parts)).cast("int")


@dataclass(frozen=True)
class TokenStore:
    """A store written by write_store()."""

    spark: SparkSession
    path: str
    parts: int
    width: int

    def keys(self) -> DataFrame:
        """(id, nth) of all documents; an id is null where the document had none."""
        return self.spark.read.parquet(f"{self.path}/entries").select(F.nullif("id", F.lit(_NO_ID)).alias("id"), "nth")

    def shard_files(self) -> DataFrame:
        """(shard, path, length, documents, before): before is the number of ids in all shards ahead."""
        ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
        return self.spark.read.parquet(f"{self.path}/shard_files").withColumn("before", F.coalesce(F.sum("length").over(ahead), F.lit(0)))

    def places(self, keys: DataFrame) -> DataFrame:
        """(id, nth, shard, begin, length) of the keys (id, nth) that the index has, by one slot each."""
        files = self.spark.read.parquet(f"{self.path}/index_files").select("part", "path")

        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            name, index = None, None
            for batch in batches:
                paths = batch.column("path").dictionary_encode()
                for code, file in enumerate(paths.dictionary.to_pylist()):
                    if file != name:
                        name, index = file, read_part(file)
                    mine = batch.filter(pa.compute.equal(paths.indices, code))
                    ok, shard, begin, length = index.find(key_hashes(mine.column("id").to_numpy(), mine.column("nth").to_numpy()))
                    here = mine.filter(pa.array(ok))
                    yield pa.RecordBatch.from_arrays([here.column("id"), here.column("nth"), pa.array(shard[ok], pa.int32()), pa.array(begin[ok]), pa.array(length[ok])], ["id", "nth", "shard", "begin", "length"])

        asked = keys.select(F.coalesce(F.col("id").cast("long"), F.lit(_NO_ID)).alias("id"), F.col("nth").cast("long").alias("nth"))
        dealt = asked.withColumn("part", part_of(F.col("id"), self.parts)).join(F.broadcast(files), "part")  # a row per index part
        return dealt.sortWithinPartitions("part").select("id", "nth", "path").mapInArrow(found, "id long, nth long, shard int, begin long, length long")

    def read(self, keys: DataFrame) -> DataFrame:
        """(id, nth, start, length, ids) of keys: ids as binary, little-endian unsigned 32-bit; start counts the ids of all
        documents before. Every shard is opened by one task, which reads the places asked for in ascending order."""
        kind = f"<u{self.width}"
        width = self.width

        def payload(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            name, file = None, None
            for batch in batches:
                for at in range(0, len(batch), 1000):
                    part = batch.slice(at, 1000)
                    got = []
                    for path, begin, length in zip(part.column("path").to_pylist(), part.column("begin").to_pylist(), part.column("length").to_pylist(), strict=True):
                        if path != name:
                            fs, place = opened(path)
                            name, file = path, Blocks(fs.open_input_file(place))
                        got.append(np.frombuffer(file.read(_HEADER + width * begin, width * length), kind).astype("<u4").tobytes())
                    start = pa.compute.add(part.column("begin"), part.column("before"))
                    yield pa.RecordBatch.from_arrays([part.column("id"), part.column("nth"), start, part.column("length"), pa.array(got, pa.binary())], ["id", "nth", "start", "length", "ids"])

        placed = self.places(keys).join(F.broadcast(self.shard_files().select("shard", "path", "before")), "shard")  # a row per shard
        ordered = placed.repartition("shard").sortWithinPartitions("shard", "begin")
        return ordered.mapInArrow(payload, "id long, nth long, start long, length long, ids binary").withColumn("id", F.nullif("id", F.lit(_NO_ID)))

    def get(self, id_: int, nth: int = 0) -> np.ndarray | None:
        """The ids of one document, or None: one slot of one index part, and one read of one shard."""
        part = zlib.crc32(str(id_).encode()) % self.parts
        files = self.spark.read.parquet(f"{self.path}/index_files").filter(F.col("part") == part).select("path").head()
        if files is None:
            return None
        ok, shard, begin, length = cached_part(files["path"]).find(key_hashes(np.array([id_]), np.array([nth])))
        if not ok[0]:
            return None
        path = self.spark.read.parquet(f"{self.path}/shard_files").filter(F.col("shard") == int(shard[0])).select("path").head()["path"]
        fs, place = opened(path)
        with fs.open_input_file(place) as f:
            f.seek(_HEADER + self.width * int(begin[0]))
            return np.frombuffer(f.read(self.width * int(length[0])), f"<u{self.width}").astype(np.uint32)


@lru_cache(16)
def cached_part(path: str) -> IndexPart:
    return read_part(path)


class Blocks:
    """Reads places of a file in ascending order, a block at a time."""

    def __init__(self, file: pa.NativeFile, block: int = 4 << 20) -> None:
        self.file, self.block, self.at, self.data = file, block, 0, b""

    def read(self, at: int, n: int) -> bytes:
        if at < self.at or at + n > self.at + len(self.data):
            self.file.seek(at)
            self.at, self.data = at, self.file.read(max(n, self.block))
        return self.data[at - self.at : at - self.at + n]

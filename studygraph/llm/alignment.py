"""Tokens of two tokenizers over the same text, aligned by bytes, and how often their ids meet.

The tokens of B are an interval index that never changes: their ends in order. Each token of A finds the B tokens it
overlaps by bisection; a gap between two B tokens that no A token spans is a bound, and bounds cut both lists into
groups. Both tokenizers leave certain places of a text always uncrossed: A's splitting does (before white space, between a
letter and a mark), and B has no piece in which the two characters there follow one another. Texts are cut at such places
into units, and each distinct unit is tokenized and aligned once."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece.sentencepiece_model_pb2 import ModelProto
from tokenizers import Tokenizer

from studygraph.llm import arrays
from studygraph.llm.encoding import cuts
from studygraph.llm.shared import Written
from studygraph.llm.substrings import by_key

#: Distinct units, and bytes of what is known of them, that a worker keeps; past either it starts anew.
KEPT_UNITS, KEPT_BYTES = 250_000, 64 << 20
#: Bytes of text that ask together for the counts of their pairs.
BLOCK_BYTES = 8 << 20


class ByteLevel:
    """A byte-level tokenizer of the tokenizers library. The strings of special tokens are plain text."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves; others are moved past 0xFF
        byte = {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
        vocabulary = self.tokenizer.get_vocab()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]


class Pieces:
    """A sentencepiece model that puts a space before each text. Texts given here begin with that space, or are parts of
    texts, so the model is read as one that puts none."""

    def __init__(self, path: str) -> None:
        proto = ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        if not spec.add_dummy_prefix or spec.remove_extra_whitespaces or spec.precompiled_charsmap:
            raise ValueError("the model changes texts by more than a space before them, so they can't be cut into parts")
        spec.add_dummy_prefix = False
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        pieces = [(i, self.model.id_to_piece(i)) for i in range(self.model.vocab_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
        #: Which ASCII characters follow one another in a piece.
        self.joined = np.zeros((256, 256), bool)
        for i, piece in pieces:
            if not self.model.is_byte(i):
                at = np.frombuffer(piece.replace("▁", " ").encode(), np.uint8)
                self.joined[at[:-1], at[1:]] = True

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def units_of(raw: np.ndarray, offsets: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Where units start: at each text, and where neither tokenizer has a token across. joined: the pairs of bytes that
    follow one another in some piece."""
    at = cuts(raw, offsets, True)
    inner = at[at > 0]
    before, after = raw[inner - 1], raw[inner]
    return np.union1d(offsets[:-1][np.diff(offsets) > 0], inner[(before < 128) & (after < 128) & ~joined[before, after]])


def stab(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The groups of the A tokens and of the B tokens, from 0, where both lists cover the same bytes and end at a_ends and
    b_ends. The B ends are the index: an A token stabs it at its first and at its last byte, and spans all gaps between
    the two B tokens found. Gaps that none spans part the groups."""
    starts = np.concatenate(([0], a_ends[:-1]))
    low, high = np.searchsorted(b_ends, starts, "right"), np.searchsorted(b_ends, a_ends, "left")
    spans = np.cumsum(np.bincount(low, minlength=len(b_ends) + 1) - np.bincount(high, minlength=len(b_ends) + 1))[: len(b_ends)]
    group = np.concatenate(([0], np.cumsum(spans[:-1] == 0)))
    return group[low], group


def crossed(a_group: np.ndarray, a: np.ndarray, b_group: np.ndarray, b: np.ndarray, ids: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, code, times) of the distinct id pairs of each group; code is a * ids + b, times how many links it stands for."""
    ka, na = np.unique(a_group * (1 << 32) + a, return_counts=True)
    kb, nb = np.unique(b_group * (1 << 32) + b, return_counts=True)
    size = np.bincount(kb >> 32, minlength=int(b_group[-1]) + 1)
    first = np.cumsum(size) - size
    group = ka >> 32
    each = size[group]
    at = np.repeat(np.arange(len(ka)), each)
    other = np.repeat(first[group], each) + np.arange(len(at)) - np.repeat(np.cumsum(each) - each, each)
    return group[at], (ka[at] & 0xFFFFFFFF) * ids + (kb[other] & 0xFFFFFFFF), na[at] * nb[other]


class Aligner:
    """What a worker knows of the units it has met: counts, linked pairs and groups as text."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.a_size, self.b_size = (np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b))
        self.ids = len(self.b.bytes)
        self.kind = "<u4" if len(self.a.bytes) * self.ids <= 1 << 32 else "<u8"
        self.clear()

    def clear(self) -> None:
        self.unit: dict[bytes, int] = {}
        self.texts: list[bytes] = []
        self.bytes = 0
        self.counts = np.zeros((1 << 12, 5), np.int64)  # tokens of A, of B, groups, links, pairs up to here
        self.good = np.zeros(1 << 12, bool)
        self.codes, self.times = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def learn(self, fresh: list[bytes]) -> None:
        for at in range(0, len(fresh), 4096):
            self.learn_some(fresh[at : at + 4096])

    def learn_some(self, fresh: list[bytes]) -> None:
        """Units that begin with a space and end with what is none are tokenized together, as neither tokenizer joins one to
        the next; others by themselves."""
        spelled = [x.decode() for x in fresh]
        free = [x[0] == 32 and not t[-1].isspace() and "▁" not in t for x, t in zip(fresh, spelled, strict=True)]
        together, apart = [u for u, f in enumerate(free) if f], [u for u, f in enumerate(free) if not f]
        text, raw = "".join([spelled[u] for u in together]), b"".join([fresh[u] for u in together])
        both = [t.encode([text]) if text else [[]] for t in (self.a, self.b)]
        if any(b"".join([t.bytes[i] for i in ids[0]]) != raw for t, ids in zip((self.a, self.b), both, strict=True)):
            together, apart, both = [], together + apart, [[[]], [[]]]
        for t, ids in zip((self.a, self.b), both, strict=True):
            ids += t.encode([spelled[u] for u in apart]) if apart else []
        ok = [all(b"".join([t.bytes[i] for i in ids[1 + k]]) == fresh[u] for t, ids in zip((self.a, self.b), both, strict=True)) for k, u in enumerate(apart)]
        order = together + [u for u, fine in zip(apart, ok, strict=True) if fine] + [u for u, fine in zip(apart, ok, strict=True) if not fine]
        n, n_good = len(fresh), len(together) + sum(ok)
        a, b = (np.array([i for part, fine in zip(ids, [True, *ok], strict=True) if fine for i in part], np.int64) for ids in both)
        known = len(self.unit)
        if known + n + 1 > len(self.good):
            room = max(n, len(self.good)) + 1
            self.counts = np.concatenate([self.counts, np.zeros((room, 5), np.int64)])
            self.good = np.concatenate([self.good, np.zeros(room, bool)])
        self.good[known : known + n] = np.arange(n) < n_good
        counts, texts = np.zeros((n, 5), np.int64), [b""] * n
        if len(a):
            ends = np.cumsum([len(fresh[u]) for u in order[:n_good]])
            a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
            a_unit, b_unit = np.searchsorted(ends, a_ends), np.searchsorted(ends, b_ends)
            a_group, b_group = stab(a_ends, b_ends)
            group, codes, times = crossed(a_group, a, b_group, b, self.ids)
            first_b = np.flatnonzero(np.concatenate(([True], np.diff(b_group) > 0)))
            unit_of = b_unit[first_b]
            by_code = np.lexsort((codes, unit_of[group]))
            unit, codes, times = unit_of[group][by_code], codes[by_code], times[by_code]
            heads = np.flatnonzero(np.concatenate(([True], (np.diff(codes) != 0) | (np.diff(unit) != 0))))
            unit, codes, times = unit[heads], codes[heads], np.add.reduceat(times, heads)
            counts[:, 0], counts[:, 1], counts[:, 2] = np.bincount(a_unit, minlength=n), np.bincount(b_unit, minlength=n), np.bincount(unit_of, minlength=n)
            counts[:, 3], counts[:, 4] = np.bincount(unit, times, n).astype(np.int64), np.bincount(unit, minlength=n)
            texts[:n_good] = self.spelled(a, a_group, b, b_group, b_unit)
            start = int(self.counts[known, 4])
            if start + len(codes) > len(self.codes):
                more = np.zeros(max(len(codes), len(self.codes)), np.int64)
                self.codes, self.times = np.concatenate([self.codes, more]), np.concatenate([self.times, more])
            self.codes[start : start + len(codes)], self.times[start : start + len(codes)] = codes, times
        self.counts[known : known + n, :4] = counts[:, :4]
        self.counts[known + 1 : known + n + 1, 4] = self.counts[known, 4] + np.cumsum(counts[:, 4])
        self.texts += texts
        self.bytes += sum(map(len, fresh)) + sum(map(len, texts)) + 16 * int(counts[:, 4].sum())
        self.unit.update(zip([fresh[u] for u in order], range(known, known + n), strict=True))

    def spelled(self, a: np.ndarray, a_group: np.ndarray, b: np.ndarray, b_group: np.ndarray, b_unit: np.ndarray) -> list[bytes]:
        """The groups of each unit as text: all tokens in order of group, A before B, each with the mark behind it."""
        last = lambda x: np.append(np.diff(x) > 0, True)
        mark_a = np.where(last(a_group), 1, 0)
        mark_b = np.where(last(b_unit), 3, np.where(last(b_group), 2, 0))
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        tokens = np.concatenate([a * 4 + mark_a, b * 4 + mark_b])[order]
        distinct, each = np.unique(tokens, return_inverse=True)
        written = np.array([b"%d%c" % (t >> 2, b",|;\n"[t & 3]) for t in distinct.tolist()], object)
        return b"".join(written[each].tolist()).split(b"\n")[:-1]

    def align(self, column: pa.Array) -> tuple[np.ndarray, list[bytes | None], np.ndarray, np.ndarray, np.ndarray]:
        """(tokens of A, of B, groups and links of each text, its groups as text or None if it has no tokens, and of the
        distinct pairs of all texts: the text, the code, how many links)."""
        length = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False)
        spaced = pa.compute.binary_join_element_wise(pa.scalar("", pa.large_string()), pa.compute.fill_null(column.cast(pa.large_string()), ""), pa.scalar(" ", pa.large_string()))
        raw, offsets = arrays.text_bytes(spaced)
        starts = units_of(raw, offsets, self.b.joined)
        bounds = np.append(starts, len(raw)).astype(np.int64)
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(raw))]).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.unit) + len(distinct) > KEPT_UNITS or self.bytes > KEPT_BYTES:
            self.clear()
        self.learn([x for x in distinct if x not in self.unit])
        unit = np.array([self.unit[x] for x in distinct], np.int64)[coded.indices.to_numpy()]
        first = np.searchsorted(starts, offsets)
        text = np.repeat(np.arange(len(column)), np.diff(first))
        good = (length > 0) & (np.bincount(text, ~self.good[unit], len(column)) == 0)
        counts = np.stack([np.bincount(text, self.counts[unit, i], len(column)) for i in range(4)], 1).astype(np.int64)
        counts[~good] = 0
        spelled = unit.tolist()
        groups = [b";".join([self.texts[u] for u in spelled[x:z]]) if ok else None for ok, x, z in zip(good.tolist(), first[:-1].tolist(), first[1:].tolist(), strict=True)]
        mine = good[text]
        key, often = np.unique(text[mine] << 32 | unit[mine], return_counts=True)
        at = key & 0xFFFFFFFF
        size = self.counts[at + 1, 4] - self.counts[at, 4]
        place = np.repeat(self.counts[at, 4] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        owner, codes, times = np.repeat(key >> 32, size), self.codes[place], self.times[place] * np.repeat(often, size)
        order = np.argsort(owner << 32 | codes) if self.kind == "<u4" else np.lexsort((codes, owner))
        owner, codes, times = owner[order], codes[order], times[order]
        heads = np.flatnonzero(np.concatenate(([True], (np.diff(codes) != 0) | (np.diff(owner) != 0)))) if len(codes) else np.zeros(0, np.int64)
        return counts, groups, owner[heads], codes[heads], np.add.reduceat(times, heads) if len(heads) else times


@cache
def aligner(a_path: str, b_path: str) -> Aligner:
    """One aligner per worker and pair of tokenizers."""
    return Aligner(a_path, b_path)


def packed(values: np.ndarray, bounds: np.ndarray, kind: str) -> pa.Array:
    """Runs of values as one binary value each; bounds: where each run starts, one more at the end."""
    data = np.ascontiguousarray(values.astype(kind))
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * data.itemsize).astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str, with_groups: bool) -> DataFrame:
    """A row for each text (kind 1) with its counts and pairs, and before the end of each block of texts a row (kind 0) with
    the block's distinct pairs and in how many of its texts each is."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = aligner(a_path, b_path)
        part, number, size, held = TaskContext.get().partitionId(), 0, 0, []
        names = ["kind", "block", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "codes", "times"]

        def whole(id_field: pa.DataType) -> pa.RecordBatch:
            codes, texts = np.unique(np.concatenate(held), return_counts=True)
            one = np.array([0, len(codes)])
            nothing = [pa.array([0], pa.int64())] * 4 + [pa.array([""]), pa.nulls(1, pa.string())]
            return pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([part << 32 | number], pa.int64()), pa.nulls(1, id_field), *nothing, packed(codes, one, made.kind), packed(texts, one, "<u4")], names)

        id_field = None
        for batch in batches:
            for some in arrays.slices(batch, "text"):
                id_field = some.column("id").type
                counts, groups, owner, codes, times = made.align(some.column("text"))
                n = len(some)
                bounds = np.searchsorted(owner, np.arange(n + 1))
                digest = pa.array(["" if g is None else hashlib.sha256(g).hexdigest() for g in groups])
                text = pa.array([None if g is None else g.decode() for g in groups] if with_groups else [None] * n, pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([1] * n, pa.int32()), pa.array([part << 32 | number] * n, pa.int64()), some.column("id"), *(pa.array(counts[:, i]) for i in range(4)), digest, text, packed(codes, bounds, made.kind), packed(times, bounds, "<u8")], names)
                held.append(codes.astype(made.kind))
                size += int(pa.compute.sum(pa.compute.binary_length(some.column("text"))).as_py() or 0)
                if size > BLOCK_BYTES:
                    yield whole(id_field)
                    number, size, held = number + 1, 0, []
        if held:
            yield whole(id_field)

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return given.mapInArrow(rows, f"kind int, block long, id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, codes binary, times binary")


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False) -> DataFrame:
    """(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of docs; with_groups adds groups,
    the ids themselves as text.

    A, a byte-level tokenizer, reads a space and the text; B, a sentencepiece model, the text, before which it puts a space.
    Byte offsets where tokens of both end cut the lists into groups; tokens of one group are linked. A pair of ids counts
    the rows of docs that have it linked; n_best are a row's links whose pair counts most among all pairs of its A id, and
    count_sum is the sum over its links of their pairs' counts. groups_sha256 is of `a1,a2|b1;a3|b2,b3`.

    A text that is null, empty, or not what the tokens of A or of B spell has no tokens: zeros and ''. Rows without id, or
    that repeat one, are rows like others. Empty docs give no row; other columns are not read. Texts are tokenized once and
    are not shuffled: each block of 8 MB of texts asks once for each of its pairs, so a pair that all texts have is a row a
    block; the blocks' answers meet their texts' pairs by one shuffle."""
    tables = Written(docs.sparkSession)
    made = aligner(a_path, b_path)
    ids, kind = made.ids, made.kind
    held = tables.put("aligned", aligned(docs, a_path, b_path, id_col, text_col, with_groups))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, codes, texts in zip(batch.column("block").to_pylist(), batch.column("codes").to_pylist(), batch.column("times").to_pylist(), strict=True):
                code = np.frombuffer(codes, kind).astype(np.int64)
                for at in range(0, len(code), 1 << 16):
                    n = len(code[at : at + (1 << 16)])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block), pa.int64()), pa.array(code[at : at + n]), pa.array(np.frombuffer(texts, "<u4")[at : at + n].astype(np.int64))], ["block", "code", "texts"])

    asks = tables.put("asks", held.filter("kind = 0").select("block", "codes", "times").mapInArrow(told, "block long, code long, texts long"))
    counts = tables.put("pairs", asks.groupBy("code").agg(F.sum("texts").alias("n")))
    best = counts.groupBy(F.floor(F.col("code") / ids).alias("a")).agg(F.max("n").alias("most"))  # a row for each id of A
    known = counts.withColumn("a", F.floor(F.col("code") / ids)).join(F.broadcast(best), "a").select("code", "n", (F.col("n") == F.col("most")).alias("top"))
    answers = asks.select("block", "code").join(known, "code")
    mine = held.filter("kind = 1")
    both = answers.select("block", F.lit(0).alias("kind"), "code", "n", "top", *(F.lit(None).cast(f.dataType).alias(f.name) for f in mine.schema if f.name not in ("block", "kind"))).unionByName(mine.select("*", F.lit(None).cast("long").alias("code"), F.lit(None).cast("long").alias("n"), F.lit(None).cast("boolean").alias("top")))
    kept = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups"]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, run in by_key(batches, "block"):
            answered: list[tuple[np.ndarray, ...]] = []
            index: tuple[np.ndarray, ...] | None = None
            for batch in run:
                texts = batch.column("kind").to_numpy() == 1
                if not texts.all():
                    head = batch.filter(pa.array(~texts))
                    answered.append((head.column("code").to_numpy(), head.column("n").to_numpy(), head.column("top").to_numpy(zero_copy_only=False).astype(bool)))
                rows = batch.filter(pa.array(texts))
                if not len(rows):
                    continue
                if index is None:
                    code, n, top = (np.concatenate(x) for x in zip(*answered, strict=True)) if answered else (np.zeros(0, np.int64),) * 3
                    order = np.argsort(code)
                    index, answered = (code[order], n[order], top[order]), []
                n_best, total = [], []
                for codes, times in zip(rows.column("codes").to_pylist(), rows.column("times").to_pylist(), strict=True):
                    at, often = np.searchsorted(index[0], np.frombuffer(codes, kind).astype(np.int64)), np.frombuffer(times, "<u8").astype(np.int64)
                    n_best.append(int(often[index[2][at].astype(bool)].sum()))
                    total.append(int((often * index[1][at]).sum()))
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), pa.array(n_best, pa.int64()), pa.array(total, pa.int64())], [*kept, "n_best", "count_sum"])

    dealt = both.repartition("block").sortWithinPartitions("block", "kind")
    fields = ", ".join(f"{c} {mine.schema[c].dataType.simpleString()}" for c in kept)
    done = dealt.mapInArrow(summed, f"{fields}, n_best long, count_sum long")
    return done.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *(["groups"] if with_groups else []))

"""Substring dedup: removes every word that lies in a run of `window` words which also starts earlier.

Fixed-block anchors: the reference is every `window // 2`-th block of that many words of every document. A repeated run of
`window` words holds such a block of its earlier copy whole, so each rolling block of all documents is looked up among
the reference blocks, and what is hit is extended: around every hit the whole windows are looked up again, and windows
that follow one another join to maximal repeats.

Both look-ups are rows in a shuffle, as many as there are distinct values in groups of documents: a group asks for each
value once, however often it has it, so a passage that a third of all documents hold is one row for each group. Blocks
are only candidates; windows are equal if their rolling hash and a BLAKE2b digest of their words are."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from studygraph.llm import arrays
from studygraph.llm.shared import Written

#: Bytes of text that a group of documents is made for.
GROUP_BYTES = 8 << 20
#: Values that a task holds before it passes the distinct ones on.
HELD = 1 << 19
_NO_ID = (1 << 63) - 1


def by_key(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """Runs of rows with one key, from batches sorted by it; each run as an iterator of batches."""
    state: dict = {"rest": None}

    def following() -> pa.RecordBatch | None:
        while state["rest"] is None or not len(state["rest"]):
            state["rest"] = next(batches, None)
            if state["rest"] is None:
                return None
        return state["rest"]

    def run(value: int) -> Iterator[pa.RecordBatch]:
        while (batch := following()) is not None:
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            if keys[0] != value:
                return
            n = int(np.argmax(keys != value)) if (keys != value).any() else len(keys)
            state["rest"] = batch.slice(n)
            yield batch.slice(0, n)

    while (batch := following()) is not None:
        value = int(batch.column(key)[0].as_py())
        mine = run(value)
        yield value, mine
        for _ in mine:
            pass


def runs_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts values, and where each run of equal ones starts in it."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    return order, np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(values) else np.zeros(0, np.int64)


def hashed(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, word starts, word ends, first word of each text, word hashes."""
    raw, offsets = arrays.text_bytes(part.column("text"))
    starts, ends, first = arrays.words(raw, offsets)
    return raw, starts, ends, first, arrays.span_hashes(raw, starts, ends)


def windows(hashes: np.ndarray, first: np.ndarray, width: int, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a window of width words of one text starts, and the windows' hashes."""
    at = np.flatnonzero(arrays.window_starts(first, width))
    values = arrays.window_hashes(hashes, width)[at] if len(at) else np.zeros(0, np.uint64)
    return at, (values if bits == 64 else values & np.uint64((1 << bits) - 1)).view(np.int64)


def digests(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """64 bits of BLAKE2b of the words, joined by one space, of each window that starts at word `at`."""
    if not len(at):
        return np.zeros(0, np.int64)
    wanted = np.zeros(len(starts) + 1, np.int32)
    np.add.at(wanted, at, 1)
    np.add.at(wanted, at + width, -1)
    used = np.flatnonzero(np.cumsum(wanted[:-1]) > 0)
    size = ends[used] - starts[used] + 1
    place = np.concatenate(([0], np.cumsum(size)))
    text = np.full(int(place[-1]), 32, np.uint8)
    source = np.repeat(starts[used] - place[:-1], size) + np.arange(len(text))
    last = place[1:] - 1
    source[last] = 0
    text = raw[source]
    text[last] = 32
    data = memoryview(text.tobytes())
    begin = np.searchsorted(used, at)
    one = [blake2b(data[a:z], digest_size=8).digest() for a, z in zip(place[begin].tolist(), last[begin + width - 1].tolist(), strict=True)]
    return np.frombuffer(b"".join(one), np.int64)


def places(known: tuple[np.ndarray, np.ndarray], value: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """Where each (value, digest) stands among known ones, which are sorted; -1 where it does not."""
    values, digests_ = known
    at = np.searchsorted(values, value)
    out = np.full(len(value), -1, np.int64)
    todo = np.arange(len(value))
    while len(todo):
        todo = todo[at[todo] < len(values)]
        todo = todo[values[at[todo]] == value[todo]]
        same = digests_[at[todo]] == digest[todo]
        out[todo[same]] = at[todo[same]]
        todo = todo[~same]  # another digest of the same value may follow
        at[todo] += 1
    return out


def spaced(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))[kept]
    starts, ends = starts[kept], ends[kept]
    goes_on = np.append(text[1:] == text[:-1], False) if len(text) else np.zeros(0, bool)
    out = raw.copy()
    out[ends[goes_on]] = 32
    inside = np.zeros(len(raw) + 1, np.int8)
    inside[starts] += 1
    np.subtract.at(inside, ends + goes_on, 1)
    data = out[np.cumsum(inside[:-1], dtype=np.int8) > 0]
    sizes = np.bincount(text, ends - starts + goes_on, len(first) - 1).astype(np.int64)
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    return pa.Array.from_buffers(pa.large_string(), len(first) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.string())


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, keep: Sequence[str] = (), value_bits: int = 64) -> DataFrame:
    """Per row of docs: the id, n_words, n_removed, kept_text (its kept words, joined by one space) and repeats: the
    maximal runs of removed windows as array<struct<start int, length int>> in words of the input; and the columns named
    in keep, unchanged (a ValueError if one has a name made here).

    Words are [^\\x20\\x09-\\x0D]+. A window starts earlier if it starts in a document with a smaller id or before in the
    same one. Windows are judged on the input, not on what is left, and the first copy of each stays. Null text has no
    words. Rows that repeat an id count as separate documents, in the order of their texts; rows without an id come after
    all others, in the order of their texts' hashes (by which they are spread). An empty table gives no rows; other
    columns are not looked at, so their names may clash. value_bits: of the rolling hashes; the result is the same with
    fewer, there are only more candidates."""
    spark = docs.sparkSession
    tables = Written(spark)
    block = window // 2
    if block < 1:
        raise ValueError("window must be 2 words at least")
    if clash := {id_col, "n_words", "n_removed", "kept_text", "repeats"} & set(keep):
        raise ValueError(f"columns to keep with names made here: {sorted(clash)}")
    extra = [f"kept{i}" for i in range(len(keep))]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *[F.col(c).alias(e) for c, e in zip(keep, extra, strict=True)])
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tie = F.when(F.col("id").isNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    dealt = rows.select(F.pmod(F.coalesce(F.nullif(tie, F.lit(0)), F.xxhash64("id")), F.lit(int(size // GROUP_BYTES) + 1)).cast("int").alias("q"), F.coalesce("id", F.lit(_NO_ID)).alias("id"), tie.alias("tie"), "text", *extra)
    texts = tables.put("texts", dealt.repartition("q").sortWithinPartitions("q", "id", "tie", "text"))

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(value, asked) of rolling blocks, once for each group or for HELD values of it. asked: the group times 4, and 1
        if one of them is a reference block, and 2 if there are several."""

        def distinct(q: int, held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            values, reference = (np.concatenate(x) for x in zip(*held, strict=True))
            order, head = runs_of(values)
            flags = np.bitwise_or.reduceat(reference[order], head).astype(np.int64) + 2 * (np.diff(np.append(head, len(order))) > 1)
            return pa.RecordBatch.from_arrays([pa.array(values[order][head]), pa.array(4 * q + flags)], ["value", "asked"])

        for q, mine in by_key(batches, "q"):
            held, n = [], 0
            for batch in mine:
                for part in arrays.slices(batch, "text"):
                    _, _, _, first, hashes = hashed(part)
                    at, values = windows(hashes, first, block, value_bits)
                    if not len(at):
                        continue
                    held.append((values, (at - np.repeat(first[:-1], np.diff(first))[at]) % block == 0))
                    n += len(at)
                    if n >= HELD:
                        yield distinct(q, held)
                        held, n = [], 0
            if held:
                yield distinct(q, held)

    of_value = Window.partitionBy("value")
    asked = texts.select("q", "text").mapInArrow(probes, "value long, asked long").withColumns({"n": F.count("*").over(of_value), "all": F.bit_or("asked").over(of_value)})
    hit = tables.put("hits", asked.filter("(all & 1) > 0 AND (n > 1 OR (all & 2) > 0)").select((F.shiftright("asked", 2)).cast("int").alias("q"), "value"))

    def with_answers(answers: DataFrame) -> DataFrame:
        """Each group's answers, sorted, before its texts. Their two numbers stand in the columns id and tie."""
        left = texts.select("q", F.lit(1).alias("kind"), "id", "tie", "text", F.lit(None).cast("boolean").alias("here"), *extra)
        right = answers.select("q", F.lit(0).alias("kind"), F.col("value").alias("id"), F.col("digest").alias("tie"), F.lit(None).cast("string").alias("text"), "here", *[F.lit(None).cast(texts.schema[c].dataType).alias(c) for c in extra])
        return left.union(right).repartition("q").sortWithinPartitions("q", "kind", "id", "tie", "text")

    def split(mine: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], pa.RecordBatch]]:
        """Slices of a group's texts, each with the group's answers: value, digest, here, and a mark for the caller."""
        answers, loaded = [], None
        for batch in mine:
            n = int((batch.column("kind").to_numpy(zero_copy_only=False) == 0).sum())
            if n:
                answers.append([batch.column(c).slice(0, n).to_numpy(zero_copy_only=False) for c in ("id", "tie", "here")])
            if n < len(batch):
                if loaded is None:
                    value, digest, here = (np.concatenate([a[k] for a in answers]) if answers else np.zeros(0, kind) for k, kind in enumerate((np.int64, np.int64, bool)))
                    loaded, answers = (value, digest, here, np.zeros(len(value), bool)), []
                for part in arrays.slices(batch.slice(n), "text"):
                    yield loaded, part

    def extensions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The windows around hits, once for each group or for HELD windows of it: hash and digest, where it first starts,
        and the group times 2, and 1 if there are several."""

        def distinct(q: int, held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            value, digest, ids, ties = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((digest, value))  # of equal windows the first stands for all: texts are in the order of ids
            v, d = value[order], digest[order]
            head = np.flatnonzero(np.append(True, (v[1:] != v[:-1]) | (d[1:] != d[:-1])))
            again = np.diff(np.append(head, len(order))) > 1
            lead = order[head]
            return pa.RecordBatch.from_arrays([pa.array(v[head]), pa.array(d[head]), pa.array(ids[lead]), pa.array(ties[lead]), pa.array(2 * q + again.astype(np.int64))], ["value", "digest", "id", "tie", "asked"])

        for q, mine in by_key(batches, "q"):
            held, n = [], 0
            for (live, *_), part in split(mine):
                raw, starts, ends, first, hashes = hashed(part)
                at, values = windows(hashes, first, block, value_bits)
                count = np.zeros(int(first[-1]) + window + 1, np.int64)
                if len(live) and len(at):
                    count[at[live[np.minimum(np.searchsorted(live, values), len(live) - 1)] == values] + 1] = 1
                count = np.cumsum(count)
                at, values = windows(hashes, first, window, value_bits)
                near = count[at + window - block + 1] > count[at]
                at, values = at[near], values[near]
                if not len(at):
                    continue
                row = np.repeat(np.arange(len(part)), np.diff(first))[at]
                held.append((values, digests(raw, starts, ends, at, window), *[part.column(c).to_numpy(zero_copy_only=False)[row] for c in ("id", "tie")]))
                n += len(at)
                if n >= HELD:
                    yield distinct(q, held)
                    held, n = [], 0
            if held:
                yield distinct(q, held)

    of_window = Window.partitionBy("value", "digest")
    group = F.shiftright("asked", 1).cast("int")
    extended = with_answers(hit.select("q", "value", F.lit(0).cast("long").alias("digest"), F.lit(True).alias("here"))).mapInArrow(extensions, "value long, digest long, id long, tie long, asked long")
    known = (
        extended.withColumn("q", group)
        .withColumns({"n": F.count("*").over(of_window), "again": F.bit_or("asked").over(of_window), "least": F.min(F.struct("id", "tie", "q")).over(of_window)})
        .filter("n > 1 OR (again & 1) > 0").select("q", "value", "digest", "asked", (F.col("least.q") == F.col("q")).alias("here"))
        .withColumn("mine", F.count("*").over(Window.partitionBy("value", "digest", "q")))  # partitioned by value and digest already
        .filter("NOT here OR mine > 1 OR (asked & 1) > 0")  # a group that only has the first copy loses nothing
    )
    answer = tables.put("repeats", known.select("q", "value", "digest", "here"))
    tables.drop("hits")

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, mine in by_key(batches, "q"):
            for (value, digest, here, seen), part in split(mine):
                raw, starts, ends, first, hashes = hashed(part)
                at, values = windows(hashes, first, window, value_bits)
                if len(value) and len(at):
                    asked = value[np.minimum(np.searchsorted(value, values), len(value) - 1)] == values
                    at, values = at[asked], values[asked]
                    where = places((value, digest), values, digests(raw, starts, ends, at, window))
                    at, where = at[where >= 0], where[where >= 0]
                else:
                    at = where = np.zeros(0, np.int64)
                order, head = runs_of(where)
                lead = np.zeros(len(at), bool)
                lead[order[head]] = True
                first_copy = lead & here[where] & ~seen[where]
                seen[where] = True
                at = at[~first_copy]
                cover = np.zeros(int(first[-1]) + window + 1, np.int64)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + window, -1)
                gone = np.cumsum(cover)[: int(first[-1])] > 0
                yield result(part, raw, starts, ends, first, gone)

    def result(part: pa.RecordBatch, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, gone: np.ndarray) -> pa.RecordBatch:
        lost = np.concatenate(([0], np.cumsum(gone)))[first]
        spans = []
        for i in range(len(part)):
            a, z = int(first[i]), int(first[i + 1])
            s, e = arrays.runs(gone[a:z], np.array([0, z - a])) if lost[i + 1] > lost[i] else ((), ())
            spans.append([{"start": int(x), "length": int(y - x)} for x, y in zip(s, e, strict=True)])
        ids = part.column("id").to_pylist()
        return pa.RecordBatch.from_arrays(
            [
                pa.array([None if x == _NO_ID else x for x in ids], pa.int64()), pa.array(np.diff(first), pa.int64()), pa.array(np.diff(lost), pa.int64()),
                spaced(raw, starts, ends, first, ~gone), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))),
                *[part.column(c) for c in extra],
            ],
            ["id", "n_words", "n_removed", "kept_text", "repeats", *extra],
        )

    schema = ", ".join(["id long, n_words long, n_removed long, kept_text string, repeats array<struct<start:int,length:int>>", *[f"{c} {texts.schema[c].dataType.simpleString()}" for c in extra]])
    return with_answers(answer).mapInArrow(removed, schema).withColumnsRenamed({"id": id_col, **dict(zip(extra, keep, strict=True))})


def repeats_sql(window: int = 20) -> str:
    """remove_repeats() of documents in DuckDB SQL, by comparing all windows."""
    return f"""
WITH w AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents)),
s AS (SELECT doc_id, pos, word, count(*) OVER r AS n, string_agg(word, ' ') OVER r AS run FROM w WINDOW r AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {window - 1} FOLLOWING)),
t AS (SELECT doc_id, pos, word, n = {window} AND row_number() OVER (PARTITION BY n = {window}, run ORDER BY doc_id, pos) > 1 AS again FROM s),
g AS (SELECT doc_id, pos, word, bool_or(again) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW) AS gone FROM t)
SELECT d.doc_id, count(g.pos) AS n_words, count(g.pos) FILTER (gone) AS n_removed, sha256(coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM documents d LEFT JOIN g ON g.doc_id = d.doc_id GROUP BY d.doc_id
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers

from studygraph.llm import queries, token_store
from studygraph.llm.shared import fresh_path, table
from tests.llm.test_packing import reference

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_all_documents(spark):
    data = "/root/testdata/sf0.01"
    docs = sorted((r["doc_id"], r["text"]) for r in table(spark, data, "documents").collect())
    want, start = [], 0
    for (d, _), ids in zip(docs, reference([t for _, t in docs], BYTES), strict=True):
        ids = [*ids, 2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, queries.QUERIES["op3_perfect_hash_store"](spark, data).collect())) == want


def test_perfect_hash():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 63, 1000, 100_000):
        values = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        made = token_store.PerfectHash.build(values)
        assert sorted(made.slots(values)) == list(range(len(values)))
        part = token_store.IndexPart.build(values, np.arange(len(values)), values >> np.uint64(1), values & np.uint64(255))
        again = token_store.IndexPart.from_bytes(part.to_bytes())
        ok, shard, begin, length = again.find(values)
        assert ok.all() and (shard == np.arange(len(values))).all() and (begin == (values >> np.uint64(1)).astype(np.int64)).all()
        assert again.find(rng.integers(0, 1 << 63, 10_000, dtype=np.uint64) | np.uint64(1 << 63))[0].sum() <= 2
    # what no level separates is listed
    small = token_store.PerfectHash([], np.sort(np.array([5, 3, 9], np.uint64)))
    assert list(small.slots(np.array([9, 3, 5, 4], np.uint64))) == [2, 0, 1, -1]


def test_cases(spark):
    rows = [(5, "b"), (5, "a"), (1, None), (2, ""), (3, "word, " * 100_000), (None, "z"), (-4, "x # y")]
    docs = spark.createDataFrame([(*r, 1, 1) for r in rows], "doc_id long, text string, id int, nth int")
    store = token_store.write_store(docs, fresh_path(spark, "tokens"), BYTES, end_id=2, shard_bytes=1000, part_keys=2)
    got = {(r["id"], r["nth"]): (r["start"], np.frombuffer(r["ids"], "<u4").tolist()) for r in store.read(store.keys()).collect()}
    order = [(-4, 0, "x # y"), (1, 0, ""), (2, 0, ""), (3, 0, rows[4][1]), (5, 0, "a"), (5, 1, "b"), (None, 0, "z")]
    at = 0
    for (i, n, _), ids in zip(order, reference([t for _, _, t in order], BYTES), strict=True):
        assert got.pop((i, n)) == (at, [*ids, 2])
        at += len(ids) + 1
        if i is not None:
            assert store.get(i, n).tolist() == [*ids, 2]
    assert not got and store.get(77) is None
    assert store.read(spark.createDataFrame([(77, 0), (5, 1), (5, 2)], "id long, nth long")).count() == 1
    empty = token_store.write_store(docs.limit(0), fresh_path(spark, "tokens"), BYTES, end_id=2)
    assert empty.read(empty.keys()).count() == 0 and empty.get(1) is None

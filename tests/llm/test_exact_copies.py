from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from studygraph.llm import exact_copies


def reference(rows):
    """(id, kept id, size, digest) of each row."""
    out, groups = [], {}
    for nth, (i, text) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), i is None, i or 0, nth, i))
    for i, text in rows:
        mine = groups[key := re.sub(r"[\x20\x09-\x0D]", "", text or "")]
        out.append((i, min(mine)[4], len(mine), hashlib.sha256(key.encode()).hexdigest()))
    return out


def ordered(rows):
    return sorted(rows, key=repr)


ROWS = [(3, "a b"), (1, "ab"), (2, "a  b"), (7, "a\tb "), (5, None), (4, ""), (6, " \n\v"), (8, "ä b"), (9, "ä b"), (None, "only here"), (None, "only here"), (10, "onlyhere"), (11, "x" * 300_000), (12, "x " * 300_000), (13, "once"), (13, "once"), (14, "a\x1cb")]


@pytest.mark.parametrize("history", ["true", "false", "doc_id % 2 = 0", "doc_id > 6", "CAST(NULL AS BOOLEAN)"])
def test_any_history_gives_the_same(spark, history):
    frame = spark.createDataFrame([(*r, 0, "", 0) for r in ROWS], "doc_id long, text string, row int, digest string, part int")
    got = exact_copies.exact_copies(frame, F.expr(history), part_keys=3, part_rows=2).collect()
    assert ordered((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == ordered(reference(ROWS))
    assert sum(r["kept"] for r in got) == len({r[3] for r in reference(ROWS)}) and all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])
    assert exact_copies.exact_copies(frame.limit(0), F.expr(history)).count() == 0


def test_parts_stay_whole_whatever_the_join(spark):
    """No part is written twice where joins are broadcast at run time and shuffles are read locally."""
    frame = spark.createDataFrame([(i, f"text {i // 2}") for i in range(4000)], "doc_id long, text string").repartition(7)
    got = exact_copies.exact_copies(frame, F.col("doc_id") < 2000, part_keys=900, part_rows=300)
    assert got.count() == 4000 and got.filter("group_size = 2 AND kept").count() == 2000


def test_batches_one_after_another(spark):
    """Three batches: the third has only members, so parts change without new digests; rows it lacks are left out."""
    texts = [f"t {i % 40}" for i in range(100)] + ["t  7 ", "t   9  "]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = exact_copies.digests(frame, "doc_id", "text", {}).withColumn("row", F.col("id"))
    index = exact_copies.DigestIndex.new(spark, 40, part_keys=8)
    assert index.found(rows).count() == 0
    index = index.extended(rows.filter("id < 20")).extended(rows.filter("id BETWEEN 20 AND 59"))
    assert index.files.agg(F.sum("digests"), F.sum("members")).first() == (40, 20)
    index = index.extended(rows.filter("id >= 100"))
    assert index.files.agg(F.sum("digests"), F.sum("members")).first() == (40, 2)
    index = index.extended(rows.filter("id BETWEEN 60 AND 99"))
    got = index.found(rows, part_rows=5).collect()
    assert ordered((r["id"], r["keep_id"], r["group_size"]) for r in got) == ordered(r[:3] for r in reference(list(enumerate(texts))))
    other = exact_copies.digests(spark.createDataFrame([(1, "not there"), (2, "t7")], "doc_id long, text string"), "doc_id", "text", {}).withColumn("row", F.col("id"))
    assert [r["keep_id"] for r in index.found(other).collect()] == [100]


def test_digests_of_one_hash():
    """Digests that share eight bytes, and digests that only hash to a taken slot, are told apart by all their bytes."""
    rng = np.random.default_rng(1)
    digest = rng.integers(0, 256, (500, 32), dtype=np.uint8)
    digest[100:110, :8] = digest[0, :8]
    slots = {k: np.arange(500).astype(t) for k, t in exact_copies.SLOT.items()}
    part = exact_copies.Part.build(digest[:400], {k: v[:400] for k, v in slots.items()})
    found = part.find(digest)
    assert (part.slots["row"][found[:400]] == np.arange(400)).all() and (found[400:] == -1).all()
    more, members = part.extended(digest[300:], {k: v[300:] for k, v in slots.items()})
    assert members == 100 and (more.slots["row"][more.find(digest)] == np.arange(500)).all()

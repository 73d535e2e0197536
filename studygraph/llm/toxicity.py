"""Toxicity by a factorization machine over hashed terms.

A text is the set of its terms, each hashed to one of 2**bits buckets. The score is
sigmoid(b + sum_i w_i + sum_{i<j} <v_i, v_j>) over the buckets that the model kept, so pairs of terms count beyond what
each counts alone. The model is learned on a bounded sample of labelled rows and holds at most max_terms buckets; scoring
reads every whole text once, in tasks, without a shuffle."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studygraph.llm import arrays


@dataclass(frozen=True)
class Machine:
    """A learned factorization machine. slot: bucket -> row of the parameters, or -1."""

    bits: int
    slot: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray


def buckets(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every term of a string column, repeated terms repeated."""
    raw, offsets = arrays.text_bytes(column)
    low, starts, ends, first = arrays.terms(raw, offsets)
    hashes = arrays.span_hashes(low, starts, ends) >> np.uint64(64 - bits)
    return np.repeat(np.arange(len(first) - 1), np.diff(first)), hashes.astype(np.int64)


def distinct(row: np.ndarray, value: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (row, value) pairs; values are below width."""
    both = np.unique(row * width + value)
    return both // width, both % width


def sums(row: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    """Sums of x by row."""
    if x.ndim == 1:
        return np.bincount(row, x, n)
    return np.stack([np.bincount(row, x[:, k], n) for k in range(x.shape[1])], 1)


def logits(row: np.ndarray, slot: np.ndarray, n: int, bias: float, linear: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The machine's logits, and each row's sum of factors."""
    total = sums(row, factors[slot], n)
    square = sums(row, (factors[slot] ** 2).sum(1), n)
    return bias + sums(row, linear[slot], n) + 0.5 * ((total**2).sum(1) - square), total


def log_likelihood_ratio(with1: np.ndarray, with0: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """Of terms in with1 of n1 texts with label 1 and with0 of n0 others: twice the log-likelihood ratio of their having to
    do with the label."""
    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12)), 0)

    held, n = with1 + with0, max(1.0, n1 + n0)
    return 2 * (part(with1, held * n1 / n) + part(with0, held * n0 / n) + part(n1 - with1, (n - held) * n1 / n) + part(n0 - with0, (n - held) * n0 / n))


def fit(rows: list[tuple[np.ndarray, int]], bits: int = 20, max_terms: int = 4096, rank: int = 4, least: int = 6, steps: int = 300, ridge: float = 2e-3, seed: int = 7) -> Machine:
    """Learns from (distinct buckets, label) rows. Rows that are copies of one another count once. Kept are
    the at most max_terms buckets in at least `least` texts that tell most of the label, by a log-likelihood ratio beyond
    25; then bias, linear weights and factors are learned together by
    full-batch Adam on the mean log loss with a ridge. Without rows, or with one class only, the score is the smoothed
    share of label 1."""
    rows = [(b, y) for (_, y), b in {(b.tobytes(), y): b for b, y in rows}.items()]
    labels = np.array([int(y) for _, y in rows], np.float64)
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    slot = np.full(1 << bits, -1, np.int32)
    empty = Machine(bits, slot, float(np.log(share / (1 - share))), np.zeros(0), np.zeros((0, rank)))
    if not rows:
        return empty
    row, bucket = np.repeat(np.arange(len(rows)), [len(b) for b, _ in rows]), np.concatenate([b for b, _ in rows]).astype(np.int64)
    n1, n0 = labels.sum(), len(labels) - labels.sum()
    with1 = np.bincount(bucket, labels[row], 1 << bits)
    with0 = np.bincount(bucket, 1 - labels[row], 1 << bits)
    told = log_likelihood_ratio(with1, with0, n1, n0)
    kept = np.flatnonzero((with1 + with0 >= least) & (told > 25))
    kept = np.sort(kept[np.argsort(-told[kept], kind="stable")[:max_terms]])
    if not len(kept) or not n1 or not n0:
        return empty
    slot[kept] = np.arange(len(kept))
    use = slot[bucket] >= 0
    row, col = row[use], slot[bucket[use]]
    rng = np.random.default_rng(seed)
    params = [np.array([empty.bias]), np.zeros(len(kept)), rng.normal(0, 0.05, (len(kept), rank))]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, steps + 1):
        score, total = logits(row, col, len(labels), params[0][0], params[1], params[2])
        wrong = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels
        of_pair = wrong[row][:, None] * (total[row] - params[2][col])
        grads = [
            np.array([wrong.mean()]),
            np.bincount(col, wrong[row], len(kept)) / len(labels) + ridge / len(kept) * params[1],
            np.stack([np.bincount(col, of_pair[:, k], len(kept)) for k in range(rank)], 1) / len(labels) + ridge / len(kept) * params[2],
        ]
        rate = 0.05 * (1 - step / (steps + 1)) + 0.002
        for p, g, (m, v) in zip(params, grads, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Machine(bits, slot, float(params[0][0]), params[1], params[2])


def distinct_buckets(column: pa.Array, bits: int) -> list[np.ndarray]:
    """The distinct buckets of each text's terms, ascending."""
    row, bucket = distinct(*buckets(column, bits), 1 << bits)
    return np.split(bucket.astype(np.int32), np.searchsorted(row, np.arange(1, len(column))))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_fit_rows: int = 16_000, max_fit_terms: int = 16_000_000, bits: int = 20, **how) -> Machine:
    """fit() on at most max_fit_rows labelled ids, those with the smallest hashes, read in that order until max_fit_terms
    distinct terms of whole texts are held. Labels other than 0 and 1, and rows without a label, are left out. Texts are
    hashed in tasks; the driver reads the sample's buckets one partition after the other, within these bounds."""
    chosen = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"), F.xxhash64(F.col(id_col).cast("string")).alias("_h")).orderBy("_h", "_id", "_y").limit(max_fit_rows)
    ids = chosen.collect()
    if not ids:
        return fit([], bits, **how)
    small = docs.sparkSession.createDataFrame([(r["_id"], r["_y"], r["_h"]) for r in ids], chosen.schema)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.slices(batch, "_text"):
                made = [b.tobytes() for b in distinct_buckets(part.column("_text"), bits)]
                yield pa.RecordBatch.from_arrays([part.column("_h"), part.column("_y"), pa.array(made, pa.binary())], ["_h", "_y", "_b"])

    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(small), "_id").select("_h", "_y", "_text")
    rows, held = [], 0
    for r in texts.mapInArrow(hashed, "_h long, _y int, _b binary").orderBy("_h", "_y", "_b").toLocalIterator():
        held += len(r["_b"]) // 4
        if rows and held > max_fit_terms:
            break
        rows.append((np.frombuffer(bytes(r["_b"]), np.int32), r["_y"]))
    return fit(rows, bits, **how)


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """Each row's id and score (double, 0 to 1, higher for label 1); with keep, all columns of docs and _score instead.
    The machine goes with the tasks; its size is bounded by its bits and max_terms. Null text is the empty text, which
    scores the bias alone; repeated rows give repeated results, an empty table none. With keep, a column _score of docs
    is replaced."""
    name = "_score" if keep else "score"
    docs = docs.drop("_score") if keep else docs
    kept = docs if keep else docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    text = text_col if keep else "_text"
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            for part in arrays.slices(batch, text):
                row, bucket = buckets(part.column(text), m.bits)
                at = m.slot[bucket]
                row, at = row[at >= 0], at[at >= 0].astype(np.int64)
                row, at = distinct(row, at, max(1, len(m.linear)))
                z, _ = logits(row, at, len(part), m.bias, m.linear, m.factors)
                out = pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))), pa.float64())
                columns = part.columns if keep else [part.column(0)]
                names = part.schema.names if keep else [part.schema.names[0]]
                yield pa.RecordBatch.from_arrays([*columns, out], [*names, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if keep or f.name != "_text")
    return kept.mapInArrow(scored, f"{schema}, {name} double")

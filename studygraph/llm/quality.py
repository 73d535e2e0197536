"""Quality by a sparse rule ensemble: statistics of a text, conjunctive rules from the paths of small trees over them, and
lasso logistic weights. The rules that keep a weight are compiled into one Spark column expression."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studygraph.llm import arrays
from studygraph.llm.shared import Written

#: What is known of a text, all doubles, 0 for the empty text.
STATISTICS = ["bytes", "words", "lines", "word_bytes", "words_a_line", "upper", "digit", "punctuation", "symbol", "space", "beyond_ascii", "bars", "exclamations", "distinct_words", "distinct_lines", "distinct_grams", "ends", "top_word"]

_CLASS = {
    "upper": range(65, 91), "digit": range(48, 58), "punctuation": [33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63], "symbol": [35, 36, 37, 38, 42, 43, 47, 60, 61, 62, 64, 91, 92, 93, 94, 95, 96, 123, 124, 125, 126],
    "space": [9, 10, 11, 12, 13, 32], "beyond_ascii": range(128, 256), "bars": [124], "exclamations": [33],
}

#: One condition: statistic, whether it is at most (else above) the value.
Condition = tuple[str, bool, float]


@dataclass(frozen=True)
class Ensemble:
    """Bias and weighted rules; a rule is a conjunction of conditions."""

    bias: float
    rules: list[tuple[float, list[Condition]]]

    def score(self) -> Column:
        """The probability of label 1 as a column expression over the statistics."""
        z = reduce(lambda a, b: a + b, [F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0)) for weight, rule in self.rules], F.lit(self.bias))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def holds(rule: list[Condition]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(s) <= F.lit(v) if below else F.col(s) > F.lit(v) for s, below, v in rule])


def shares_distinct(row: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row's hashes: the share that is distinct, and the share of the most frequent one."""
    count = np.bincount(row, minlength=n)
    order = np.lexsort((hashes, row))
    r, h = row[order], hashes[order]
    head = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (h[1:] != h[:-1]))) if len(r) else np.zeros(0, np.int64)
    often = np.diff(np.append(head, len(r)))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, r[head], often)
    some = np.maximum(count, 1)
    return np.bincount(r[head], minlength=n) / some, most / some


def measure(column: pa.Array) -> np.ndarray:
    """The statistics (rows, len(STATISTICS)) of a string column's texts."""
    raw, offsets = arrays.text_bytes(column)
    n, size = len(offsets) - 1, np.diff(offsets)
    some = np.maximum(size, 1)
    row_of_byte = np.repeat(np.arange(n), size)
    starts, ends, first = arrays.words(raw, offsets)
    words = np.diff(first)
    word_row = np.repeat(np.arange(n), words)
    hashes = arrays.span_hashes(raw, starts, ends)
    line_start, line_end = arrays.runs(raw != 10, offsets)
    line_first = np.searchsorted(line_start, offsets)
    lines = np.diff(line_first)
    line_row = np.repeat(np.arange(n), lines)
    grams = arrays.window_hashes(hashes, 5)
    inside = np.flatnonzero(arrays.window_starts(first, 5)) if len(first) and first[-1] else np.zeros(0, np.int64)
    out = {"bytes": size, "words": words, "lines": lines, "word_bytes": np.bincount(word_row, ends - starts, n) / np.maximum(words, 1), "words_a_line": words / np.maximum(lines, 1)}
    for name, members in _CLASS.items():
        table = np.zeros(256, bool)
        table[list(members)] = True
        out[name] = np.bincount(row_of_byte, table[raw], n) / some
    out["distinct_words"], out["top_word"] = shares_distinct(word_row, hashes, n)
    out["distinct_lines"], _ = shares_distinct(line_row, arrays.span_hashes(raw, line_start, line_end), n)
    out["distinct_grams"], _ = shares_distinct(word_row[inside], grams[inside], n)
    out["ends"] = np.bincount(word_row, np.isin(raw[ends - 1], [33, 46, 63]), n) / np.maximum(words, 1) if len(ends) else np.zeros(n)
    return np.stack([np.asarray(out[s], np.float64) for s in STATISTICS], 1).reshape(n, len(STATISTICS))


def statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each row's id and its text's statistics; null is the empty text."""
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.slices(batch, "_text"):
                x = measure(part.column("_text"))
                yield pa.RecordBatch.from_arrays([part.column("_id"), *[pa.array(np.ascontiguousarray(x[:, i])) for i in range(len(STATISTICS))]], ["_id", *STATISTICS])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(measured, ", ".join([f"_id {rows.schema['_id'].dataType.simpleString()}", *[f"{s} double" for s in STATISTICS]]))


def paths(tree: str) -> list[list[Condition]]:
    """All paths from the root to a node, of a tree as Spark ML prints it."""
    out, held = [], []
    for line in tree.splitlines():
        found = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-0-9.E]+)\)", line)
        if found:
            depth = len(found[1])
            held = [(d, c) for d, c in held if d < depth]
            held.append((depth, (STATISTICS[int(found[2])], found[3] == "<=", float(found[4]))))
            out.append([c for _, c in held])
    return out


def merged(path: list[Condition]) -> tuple[Condition, ...]:
    """A path with one condition for each statistic and direction, the narrowest, in a fixed order."""
    narrow: dict[tuple[str, bool], float] = {}
    for s, below, v in path:
        narrow[s, below] = v if (s, below) not in narrow else min(narrow[s, below], v) if below else max(narrow[s, below], v)
    return tuple(sorted((s, below, v) for (s, below), v in narrow.items()))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_fit_rows: int = 20_000, trees: int = 24, depth: int = 3, penalty: float = 2e-3, seed: int = 3) -> Ensemble:
    """An ensemble from at most max_fit_rows labelled rows, those whose id has the smallest hash; their ids are broadcast,
    whole texts are measured in tasks, and trees and weights are fitted by Spark ML. Labels other than 0 and 1 are left
    out. Without rows, or with one class only, the score is the smoothed share of label 1."""
    spark = docs.sparkSession
    tables = Written(spark)
    chosen = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_key"), F.col(label_col).cast("double").alias("_y"), F.xxhash64(F.col(id_col).cast("string")).alias("_h")).orderBy("_h", "_key", "_y").limit(max_fit_rows)
    ids = spark.createDataFrame(chosen.select("_key", "_y").collect(), chosen.select("_key", "_y").schema)
    sampled = docs.select(F.col(id_col).alias("_key"), F.col(text_col).alias("_text")).join(F.broadcast(ids.select("_key").distinct()), "_key")
    rows = statistics(sampled, "_key", "_text").join(F.broadcast(ids), F.col("_id") == F.col("_key")).select("_y", *STATISTICS)
    table = tables.put("statistics", rows.repartition(max(1, max_fit_rows // 5000)))
    total, ones = table.agg(F.count("*"), F.coalesce(F.sum("_y"), F.lit(0.0))).first()
    share = (ones + 0.5) / (total + 1)
    bias = float(np.log(share / (1 - share)))
    if ones in (0, total):
        tables.drop("statistics")
        return Ensemble(bias, [])
    data = VectorAssembler(inputCols=STATISTICS, outputCol="_x").transform(table).select("_y", "_x", *STATISTICS)
    forest = RandomForestClassifier(featuresCol="_x", labelCol="_y", numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", minInstancesPerNode=5, seed=seed).fit(data)
    rules = sorted({merged(p) for t in forest.trees for p in paths(t.toDebugString)})
    if not rules:
        tables.drop("statistics")
        return Ensemble(bias, [])
    # a rule and its opposite say the same: one of them is enough
    rules = [r for r in rules if len(r) > 1 or r[0][1]]
    flagged = table.select("_y", *[holds(list(r)).cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    flags = tables.put("flags", VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="_r").transform(flagged).select("_y", "_r"))
    lasso = LogisticRegression(featuresCol="_r", labelCol="_y", elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=60, tol=1e-5).fit(flags)
    tables.drop("statistics", "flags")
    weights = lasso.coefficients.toArray()
    return Ensemble(float(lasso.intercept), [(float(w), list(r)) for w, r in zip(weights, rules, strict=True) if w != 0])


def score(docs: DataFrame, ensemble: Ensemble, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id and score (double, 0 to 1, higher for label 1). Null text is the empty text; repeated rows give
    repeated results, an empty table none; other columns are not looked at."""
    return statistics(docs, id_col, text_col).select(F.col("_id").alias(id_col), ensemble.score().alias("score"))

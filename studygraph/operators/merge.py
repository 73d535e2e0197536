"""Merging and enriching entities: windows, regimens, components, codes, references and footnotes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Characters that text recognition takes for one another in footnote marks.
LOOKALIKES: dict[str, tuple[str, ...]] = {"1": ("i", "l"), "i": ("1", "l"), "l": ("1", "i"), "0": ("o",), "o": ("0",), "5": ("s",), "s": ("5",)}

# Statistical methods and how many operations each has; a method that is none of these has two.
METHOD_OPERATIONS = (
    ("ancova", 5),
    ("mmrm", 5),
    ("t-test", 4),
    ("chi-square", 4),
    ("fisher", 3),
    ("kaplan-meier", 3),
    ("cox", 3),
    ("log-rank", 2),
    ("wilcoxon", 3),
)

# Patterns of study identifiers and their types, in order of precedence.
IDENTIFIERS = (
    (r"^nct[0-9]{8}$", "ClinicalTrials.gov"),
    (r"^[0-9]{4}-[0-9]{6}-[0-9]{2}$", "EudraCT"),
    (r"^ind\s*[0-9]+$", "IND"),
)


def enhance(primary: DataFrame, secondary: DataFrame, keys: Sequence[str], fill: Sequence[str]) -> DataFrame:
    """The rows of primary, with values missing there (null or 0) taken from the secondary row of the same key, and the
    rows of secondary whose key primary lacks. Both have a key once; other columns are those of fill."""
    p = primary.select(*keys, *[F.nullif(F.col(c), F.lit(0)).alias(f"_p_{c}") for c in fill], F.lit(True).alias("_in"))
    both = p.join(secondary.select(*keys, *fill), list(keys), "full")
    return both.select(*keys, *[F.coalesce(f"_p_{c}", c).alias(c) for c in fill], F.when(F.col("_in"), "primary").otherwise("secondary").alias("origin"))


def most_complete(df: DataFrame, key: Column, parts: Sequence[Column], order: str) -> DataFrame:
    """Of the rows of one key that with the most parts there, ties by order; adds key."""
    score = sum((F.when(p, 1).otherwise(0) for p in parts), F.lit(0))
    rows = df.withColumn("key", key)
    return rows.groupBy("key").agg(F.min_by(F.struct(*df.columns), F.struct(-score, F.col(order))).alias("_r")).select("key", "_r.*")


def unite(*components: DataFrame) -> DataFrame:
    """Components one after the other; columns that one lacks are null there."""
    out = components[0]
    for c in components[1:]:
        out = out.unionByName(c, allowMissingColumns=True)
    return out


def corrected_refs(refs: Column, valid: Column) -> Column:
    """Footnote marks with those that are not valid replaced by a look-alike that is; marks without one stay."""
    def fix(r: Column) -> Column:
        out = F.when(F.array_contains(valid, r), r)
        for mark, like in LOOKALIKES.items():
            for other in like:
                out = out.when((r == mark) & F.array_contains(valid, F.lit(other)), F.lit(other))
        return out.otherwise(r)

    return F.transform(refs, fix)


def coded(df: DataFrame, text: str, codes: Mapping[str, tuple[str, str]], system: str, version: str) -> DataFrame:
    """df with code: struct(code, decode, system, version) of its text in lower case; of unknown texts the text itself."""
    low = F.lower(F.trim(F.col(text)))
    code, decode = F.when(F.lit(False), F.lit("")), F.when(F.lit(False), F.lit(""))
    for key, (c, d) in codes.items():
        code, decode = code.when(low == key, c), decode.when(low == key, d)
    return df.withColumn("code", F.struct(code.otherwise(F.col(text)).alias("code"), decode.otherwise(F.col(text)).alias("decode"), F.lit(system).alias("system"), F.lit(version).alias("version")))


def rewrite_references(df: DataFrame, id_: str, refs: str, known: DataFrame, old: str, new: str) -> DataFrame:
    """df's arrays of references by their current ids, in their order; references without one are dropped. known has each
    old id once."""
    one = df.select(id_, F.posexplode(refs).alias("_pos", "_old"))
    found = one.join(known.select(F.col(old).alias("_old"), F.col(new).alias("_new")), "_old")
    arrays = found.groupBy(id_).agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_new"))), lambda s: s["_new"]).alias("_refs"))
    return df.join(arrays, id_, "left").withColumn(refs, F.coalesce("_refs", F.array().cast("array<string>"))).drop("_refs")


def precedence(df: DataFrame, keys: Sequence[str], enriched: str, order: str) -> DataFrame:
    """Of the instances of one cell the scheduled one before an enriched one, then the first."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(enriched, order)).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def placed(df: DataFrame, keys: Sequence[Column], group: str | None = None) -> DataFrame:
    """Adds place (from 1) in an order of several keys, within a group."""
    w = Window.partitionBy(group) if group else Window.partitionBy(F.lit(0))
    return df.withColumn("place", F.row_number().over(w.orderBy(*keys)).cast("long"))


def method_operations(method: Column) -> Column:
    """How many operations a statistical method has: that of the first known method whose name holds it or is held by it,
    spaces and hyphens apart."""
    plain = F.regexp_replace(F.lower(method), r"[\s-]", "")
    out = F.when(F.lit(False), 0)
    for name, n in METHOD_OPERATIONS:
        known = name.replace("-", "").replace(" ", "")
        out = out.when(F.contains(plain, F.lit(known)) | F.contains(F.lit(known), plain), n)
    return out.otherwise(2)


def distinct_notes(df: DataFrame, group: str, order: str, note: str, least: float = 0.8) -> DataFrame:
    """Notes that repeat no earlier one of their group: none holds the other, and their words' Jaccard similarity is at most
    `least`. It depends on the order, so a group (a document's notes) meets in one task. A null note is none and goes."""
    def kept(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order)
        held: list[tuple[str, set[str]]] = []
        keep = []
        for text in rows[note]:
            low = text.lower().strip()
            words = set(low.split())
            new = not any(low in t or t in low or len(words & w) > least * len(words | w) for t, w in held)
            keep.append(new)
            if new:
                held.append((low, words))
        return rows[keep]

    return df.filter(F.col(note).isNotNull()).groupBy(group).applyInPandas(kept, df.schema)


def catalogue_issues(df: DataFrame, id_: str, catalogue: Sequence[tuple[str, str]]) -> DataFrame:
    """(id, attribute, problem) by a catalogue of (attribute, cardinality): '1' must be there, '1..*' must not be empty."""
    problems = []
    for attribute, cardinality in catalogue:
        if cardinality == "1":
            problems.append(F.when(F.col(attribute).isNull(), F.struct(F.lit(attribute).alias("attribute"), F.lit("missing").alias("problem"))))
        elif cardinality == "1..*":
            problems.append(F.when(F.coalesce(F.size(attribute), F.lit(0)) <= 0, F.struct(F.lit(attribute).alias("attribute"), F.lit("empty").alias("problem"))))
    return df.select(id_, F.explode(F.array_compact(F.array(*problems))).alias("_p")).select(id_, "_p.attribute", "_p.problem")

"""Pages by domain, valid notes, notes from two sources, and extracted entities against two others."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def domain_pages(df: DataFrame, id_: Sequence[str], text: str, domains: Mapping[str, tuple[Sequence[str], int]]) -> DataFrame:
    """(id, domain, hits) of the pages on which at least a domain's threshold of its keywords occur. domains: name ->
    (keywords in lower case, threshold). A null text has none; each text is read once for all domains."""
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    found = [
        F.struct(F.lit(name).alias("domain"), sum((F.contains(low, F.lit(w)).cast("long") for w in words), F.lit(0).cast("long")).alias("hits"), F.lit(least).alias("least"))
        for name, (words, least) in domains.items()
    ]
    kept = F.filter(F.array(*found), lambda d: d["hits"] >= d["least"])
    return df.select(*id_, F.explode(kept).alias("_d")).select(*id_, "_d.domain", "_d.hits")


def valid_note(note: Column, keywords: Sequence[str], noise: Sequence[str], least: int = 15, most: int = 800, long: int = 50) -> Column:
    """Whether a note is one: of `least` to `most` characters, not all capitals, without a noise prefix, at most half
    digits, and with a keyword or longer than `long`. A null note is none."""
    low, size = F.lower(note), F.length(note)
    good = (size >= least) & (size <= most) & (note != F.upper(note)) & (F.regexp_count(note, F.lit("[0-9]")) * 2 <= size)
    for prefix in noise:
        good = good & ~F.startswith(low, F.lit(prefix))
    held = size > long
    for word in keywords:
        held = held | F.contains(low, F.lit(word))
    return F.coalesce(good & held, F.lit(False))


def merge_notes(first: DataFrame, second: DataFrame, group: str, marker: str, note: str) -> DataFrame:
    """The notes of first, and those of second whose marker (any case) first does not have in the same group."""
    columns = [F.col(group), F.lower(marker).alias(marker), F.col(note)]
    a, b = first.select(*columns), second.select(*columns)
    new = b.join(a.select(group, marker).distinct(), [group, marker], "left_anti")
    return a.withColumn("origin", F.lit("first")).union(new.withColumn("origin", F.lit("second")))


def compare_three(golden: DataFrame, extracted: DataFrame, combined: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """A row for each key that any of the three has, with the three values and a verdict: 'lost' (golden, in neither
    other), 'dropped' (golden and extracted, not combined), 'extra' (not golden), 'changed' (the combined value is not the
    golden one) or 'same'. Each side has a key once; keys are not null."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.col(value).alias(name), F.lit(True).alias(f"_{name}"))

    every = side(golden, "golden").join(side(extracted, "extracted"), list(keys), "full").join(side(combined, "combined"), list(keys), "full")
    verdict = (
        F.when(F.col("_golden").isNull(), "extra").when(F.col("_extracted").isNull() & F.col("_combined").isNull(), "lost")
        .when(F.col("_combined").isNull(), "dropped").when(~F.col("golden").eqNullSafe(F.col("combined")), "changed").otherwise("same")
    )
    return every.select(*keys, "golden", "extracted", "combined", verdict.alias("verdict"))


def standard_ids(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Hyphens of simple ids in columns become underscores; nulls stay."""
    return df.withColumns({c: F.translate(c, "-", "_") for c in columns})

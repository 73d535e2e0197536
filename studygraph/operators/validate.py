"""Integrity and conformance rules, and measures of completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dangling(child: DataFrame, fk: str, parent: DataFrame, pk: str, severity: str = "error") -> DataFrame:
    """Rows whose reference names no parent, with the rule and its severity."""
    known = parent.select(F.col(pk).alias(fk)).distinct()
    return child.filter(F.col(fk).isNotNull()).join(known, fk, "left_anti").withColumns({"rule": F.lit(f"{fk}->{pk}"), "severity": F.lit(severity)})


def orphans(parent: DataFrame, pk: str, child: DataFrame, fk: str) -> DataFrame:
    """Parents that no child refers to."""
    return parent.join(child.select(F.col(fk).alias(pk)).distinct(), pk, "left_anti")


def issues(df: DataFrame, id_: str, rules: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """(id, rule, severity) for every rule whose predicate holds. One pass over df."""
    found = F.array_compact(F.array(*[F.when(p, F.struct(F.lit(r).alias("rule"), F.lit(s).alias("severity"))) for r, s, p in rules]))
    return df.select(id_, F.explode(found).alias("_i")).select(id_, "_i.rule", "_i.severity")


def quality_score(errors: Column, warnings: Column) -> Column:
    """1 less 0.15 for each error and 0.05 for each warning, within 0 and 1."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - 0.15 * errors - 0.05 * warnings))


def confidence(complete: Sequence[Column], quality: Column) -> Column:
    """0.6 of the share of parts that are there and 0.4 of a quality within 0 and 1."""
    share = sum((F.when(c, 1.0).otherwise(0.0) for c in complete), F.lit(0.0)) / len(complete)
    return 0.6 * share + 0.4 * quality


def field_population(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(field, populated, total, share) for each field: null, empty text and 0 count as missing."""
    def there(c: str) -> Column:
        return F.count_if(F.coalesce(~F.col(c).cast("string").isin("", "0", "0.0"), F.lit(False)))

    counts = df.agg(F.count("*").alias("total"), *[there(c).alias(c) for c in fields])
    return counts.unpivot(["total"], list(fields), "field", "populated").select("field", "populated", "total", F.round(F.col("populated") / F.col("total"), 6).alias("share"))


# Rules of a study's structure, whether each is an error or a warning, and what it asks for.
CONFORMANCE = (
    ("USDM001", "ERROR", "study"),
    ("USDM002", "ERROR", "versions"),
    ("USDM010", "WARNING", "titles"),
    ("USDM011", "WARNING", "studyIdentifiers"),
    ("USDM020", "WARNING", "studyDesigns"),
    ("USDM030", "WARNING", "scheduleTimelines"),
    ("USDM031", "WARNING", "eligibilityCriteria"),
    ("USDM032", "WARNING", "objectives"),
)


def study_conformance(df: DataFrame, id_: str, study: str) -> DataFrame:
    """(id, rule, severity, version, design) of what each study lacks, by the structure rules. study: a struct of versions,
    each with titles, studyIdentifiers and studyDesigns, each with scheduleTimelines, eligibilityCriteria and objectives (all
    arrays). Null and empty arrays both count as missing; version and design are positions from 0, null above them."""
    def lacks(x: Column) -> Column:
        return F.coalesce(F.size(x), F.lit(0)) <= 0

    def fault(rule: str, when: Column, version: Column, design: Column) -> Column:
        severity = next(s for r, s, _ in CONFORMANCE if r == rule)
        return F.when(when, F.struct(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), version.cast("int").alias("version"), design.cast("int").alias("design")))

    none = F.lit(None)
    versions = F.coalesce(F.col(f"{study}.versions"), F.array())

    def of_design(d: Column, j: Column, i: Column) -> Column:
        return F.array(*[fault(r, lacks(d[name]), i, j) for r, _, name in CONFORMANCE if r >= "USDM030"])

    def of_version(v: Column, i: Column) -> Column:
        own = F.array(*[fault(r, lacks(v[name]), i, none) for r, _, name in CONFORMANCE if "USDM010" <= r < "USDM030"])
        designs = F.coalesce(F.flatten(F.transform(v["studyDesigns"], lambda d, j: of_design(d, j, i))), F.array().cast("array<struct<rule:string,severity:string,version:int,design:int>>"))
        return F.concat(own, designs)

    found = F.concat(F.array(fault("USDM001", F.col(study).isNull(), none, none), fault("USDM002", lacks(F.col(f"{study}.versions")), none, none)), F.flatten(F.transform(versions, of_version)))
    return df.select(id_, F.explode(F.array_compact(found)).alias("_f")).select(id_, "_f.rule", "_f.severity", "_f.version", "_f.design")

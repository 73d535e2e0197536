"""Superscript marks in the names of a whole schedule: names without them, marks kept with what they stand at, and held
against the notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studygraph.functions.text import strip_superscripts, superscript_refs
from studygraph.operators.merge import corrected_refs

PARTS = ("epochs", "encounters", "activities")


def note_keys(notes: Column) -> Column:
    """The marks that notes begin with, one letter or digit before a dot, a bracket or white space, in lower case."""
    found = F.transform(notes, lambda n: F.lower(F.regexp_extract(F.trim(n), r"^([a-zA-Z0-9])[.\s)]", 1)))
    return F.array_distinct(F.filter(found, lambda k: k != ""))


def normalized_schedule(schedules: DataFrame, keys: list[str]) -> DataFrame:
    """schedules (keys, epochs, encounters and activities as array<struct<id, name, refs>>, notes as array of texts) with clean
    names: keys, the three arrays as array<struct<id, name, original_name, refs>>, corrections (part, id, mark, corrected) and
    invalid (part, id, mark).

    A name's superscripts become plain marks behind the refs that it has; original_name is null where it had none. Where
    notes have marks, refs are written in lower case, one that no note has is replaced by a look-alike that one has (told in
    corrections), or stays and is told in invalid. Null arrays count as empty, null names stay null. All is done in the row."""
    shape = "array<struct<id: string, name: string, refs: array<string>>>"
    none = F.array().cast("array<string>")
    df = schedules.select(*keys, *(F.coalesce(F.col(p).cast(shape), F.array().cast(shape)).alias(p) for p in PARTS), note_keys(F.coalesce("notes", none)).alias("_keys"))

    def cleaned(x: Column) -> Column:
        marks = F.coalesce(F.filter(F.split(superscript_refs(x["name"]), ""), lambda m: m != ""), none)
        had = F.size(marks) > 0
        return F.struct(x["id"].alias("id"), F.when(had, strip_superscripts(x["name"])).otherwise(x["name"]).alias("name"), F.when(had, x["name"]).alias("original_name"), F.concat(F.coalesce(x["refs"], none), marks).alias("given"))

    def checked(x: Column) -> Column:
        low = F.transform(x["given"], F.lower)
        refs = F.when(F.size("_keys") > 0, corrected_refs(low, F.col("_keys"))).otherwise(x["given"])
        return F.struct(x["id"].alias("id"), x["name"].alias("name"), x["original_name"].alias("original_name"), refs.alias("refs"), x["given"].alias("given"))

    for p in PARTS:
        df = df.withColumn(p, F.transform(F.transform(p, cleaned), checked))

    def each(p: str, told) -> Column:
        return F.flatten(F.transform(p, lambda x: F.filter(F.zip_with(x["given"], x["refs"], lambda a, b: told(p, x["id"], a, b)), lambda t: t.isNotNull())))

    fixed = lambda p, id_, a, b: F.when((F.size("_keys") > 0) & (F.lower(a) != b), F.struct(F.lit(p).alias("part"), id_.alias("id"), a.alias("mark"), b.alias("corrected")))
    wrong = lambda p, id_, a, b: F.when((F.size("_keys") > 0) & ~F.array_contains("_keys", b), F.struct(F.lit(p).alias("part"), id_.alias("id"), a.alias("mark")))
    df = df.withColumn("corrections", F.concat(*(each(p, fixed) for p in PARTS))).withColumn("invalid", F.concat(*(each(p, wrong) for p in PARTS)))
    bare = lambda x: F.struct(x["id"].alias("id"), x["name"].alias("name"), x["original_name"].alias("original_name"), x["refs"].alias("refs"))
    return df.select(*keys, *(F.transform(p, bare).alias(p) for p in PARTS), "corrections", "invalid")

"""Sources and sinks: site lists, JSON documents and run artefacts, page text, CSV, JSON and Markdown."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as t

#: Names that a site list may use for one column, in order of preference.
SITE_COLUMNS = {
    "site_number": ("site_number", "site_id", "number"),
    "site_name": ("site_name", "name", "site"),
    "country": ("country",),
    "city": ("city",),
    "state": ("state", "region"),
    "pi_name": ("pi_name", "principal_investigator", "investigator"),
    "pi_email": ("pi_email", "email"),
    "status": ("status",),
    "target_enrollment": ("target_enrollment", "enrollment"),
}


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """A site list in CSV, one row per site, all columns as text: numbers keep their zeros. Headers are brought to lower
    case with _ for spaces; empty and 'nan' are null; columns that the list lacks are null."""
    raw = spark.read.csv(path, header=True)
    raw = raw.toDF(*[c.strip().lower().replace(" ", "_") for c in raw.columns])
    return raw.select(*[F.coalesce(*[given(F.col(a)) for a in names if a in raw.columns], F.lit(None).cast("string")).alias(c) for c, names in SITE_COLUMNS.items()])


def given(text: Column) -> Column:
    """The trimmed text; null where it is empty or says that it is missing."""
    trimmed = F.trim(text)
    return F.when(~F.lower(trimmed).isin("", "nan", "none", "null"), trimmed)


def site_entities(sites: DataFrame) -> dict[str, DataFrame]:
    """organizations, sites, and people with their roles, of a site list. A person's given name is what stands before the
    first space of the name, titles apart."""
    org = sites.select(F.concat(F.lit("org_"), "site_number").alias("id"), F.col("site_name").alias("name"), "country", "city", "state")
    site = sites.select(F.concat(F.lit("site_"), "site_number").alias("id"), F.col("site_name").alias("name"), "status", F.col("target_enrollment").try_cast("int").alias("target_enrollment"), F.concat(F.lit("org_"), "site_number").alias("organization_id"))
    named = sites.filter("pi_name IS NOT NULL").withColumn("n", F.regexp_replace("pi_name", r"(?i)^(?:dr|prof)\.?\s+", ""))
    person = named.select(F.concat(F.lit("person_"), "site_number").alias("id"), F.regexp_extract("n", r"^(\S+)", 1).alias("given_name"), F.nullif(F.regexp_extract("n", r"^\S+\s+(.*)$", 1), F.lit("")).alias("family_name"), F.col("pi_email").alias("email"), F.concat(F.lit("org_"), "site_number").alias("organization_id"), F.lit("Principal investigator").alias("role"))
    return {"organization": org, "site": site, "person": person}


def read_phase_results(spark: SparkSession, path: str, schema: str | t.StructType | None = None) -> DataFrame:
    """Stored JSON results, one document a file, without those that failed (success: false)."""
    reader = spark.read.option("multiLine", True)
    found = (reader.schema(schema) if schema is not None else reader).json(path).withColumn("_path", F.input_file_name())
    return found.filter(F.coalesce(F.col("success"), F.lit(True))) if "success" in found.columns else found


def token_usage(spark: SparkSession, path: str) -> DataFrame:
    """(path, phase, input, output, calls) of stored token counts: a row a phase."""
    found = spark.read.option("multiLine", True).schema("by_phase map<string,struct<input:long,output:long,calls:long>>").json(path)
    return found.select(F.input_file_name().alias("path"), F.explode("by_phase").alias("phase", "v")).select("path", "phase", "v.input", "v.output", "v.calls")


def read_pages(spark: SparkSession, path: str, parse: Callable[[bytes], Sequence[str]], partitions: int | None = None) -> DataFrame:
    """(doc_id, page_no, text) of binary files, by a parser from a file's bytes to its pages' texts (from 1). Files are
    parsed in tasks; a file is one row until then, so it must fit a task."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    files = files.repartition(partitions) if partitions else files

    def parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield pd.DataFrame([(p, i, x) for p, c in zip(rows["path"], rows["content"], strict=True) for i, x in enumerate(parse(c), 1)], columns=["doc_id", "page_no", "text"])

    return files.mapInPandas(parsed, "doc_id string, page_no int, text string")


def trial_files(paths: DataFrame) -> DataFrame:
    """Of each folder the protocol, the statistical plan and the site list, by file name: (folder, kind, path), the first in
    order of the alphabet."""
    name = F.lower(F.regexp_extract("path", r"([^/]+)$", 1))
    kind = F.when(name.rlike(r"sap.*\.pdf$"), "sap").when(name.rlike(r"sites.*\.(csv|xlsx)$"), "sites").when(name.rlike(r"\.pdf$"), "protocol")
    rows = paths.select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("folder"), kind.alias("kind"), "path").filter("kind IS NOT NULL")
    return rows.groupBy("folder", "kind").agg(F.min("path").alias("path"))


def protocol_listing(documents: DataFrame) -> DataFrame:
    """(protocol_id, generated, activities, encounters) of documents (protocol_id, raw JSON), newest first; what does not
    parse is skipped."""
    shape = "generated string, study struct<activities:array<struct<id:string>>,encounters:array<struct<id:string>>>"
    v = documents.withColumn("d", F.when(F.try_parse_json("raw").isNotNull(), F.from_json("raw", shape))).filter("d IS NOT NULL AND d.study IS NOT NULL")
    size = lambda c: F.coalesce(F.size(F.col(c)), F.lit(0))
    return v.select("protocol_id", "d.generated", F.greatest(size("d.study.activities"), F.lit(0)).alias("activities"), F.greatest(size("d.study.encounters"), F.lit(0)).alias("encounters")).orderBy(F.col("generated").desc_nulls_last(), "protocol_id")


def write_csv(df: DataFrame, path: str, cut: int = 100) -> None:
    """A component as CSV: texts cut to `cut` characters, arrays joined by '; ', structs as JSON."""
    def flat(f: t.StructField) -> Column:
        if isinstance(f.dataType, t.StringType):
            return F.substring(f.name, 1, cut)
        if isinstance(f.dataType, t.ArrayType) and not isinstance(f.dataType.elementType, t.StructType | t.ArrayType):
            return F.array_join(F.col(f.name).cast("array<string>"), "; ")
        if isinstance(f.dataType, t.StructType | t.ArrayType | t.MapType):
            return F.to_json(f.name)
        return F.col(f.name)

    df.select(*[flat(f).alias(f.name) for f in df.schema]).write.csv(path, header=True)


def write_documents(df: DataFrame, path: str) -> None:
    """Documents as one JSON object a line; missing values are left out."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.text(path)


def markdown(counts: DataFrame, title: str) -> str:
    """A report of (kind, n) counts as a Markdown table. The counts are one row a kind."""
    rows = counts.orderBy("kind").collect()
    return "\n".join([f"# {title}", "", "| Kind | Count |", "|---|---|", *[f"| {r['kind']} | {r['n']} |" for r in rows], "", f"Total: {sum(r['n'] for r in rows)}", ""])


def misses(asked: DataFrame, cache: DataFrame, key: Sequence[str], now: Column, days: int = 30) -> DataFrame:
    """The rows that the cache (hash, cached_at) does not hold or holds no longer, with their hash: 16 characters of the
    SHA-256 of the key columns."""
    hashed = asked.withColumn("hash", F.substring(F.sha2(F.to_json(F.struct(*key)).cast("binary"), 256), 1, 16))
    fresh = cache.filter(F.col("cached_at") > now - F.make_dt_interval(F.lit(days))).select("hash")
    return hashed.join(fresh, "hash", "left_anti")


def latest_run(results: DataFrame, keys: Sequence[str], run: str) -> DataFrame:
    """The rows of each key's last run."""
    w = Window.partitionBy(*keys).orderBy(F.col(run).desc())
    return results.withColumn("_r", F.rank().over(w)).filter("_r = 1").drop("_r")

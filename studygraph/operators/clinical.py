"""The clinical layer: epochs, encounters and activities reconciled from several sources, references resolved, and what was
found in text promoted to entities."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from studygraph.functions import text as T
from studygraph.operators import reconcile

# Priorities of the sources of each kind of entity.
PRIORITIES = {
    "epoch": {"soa": 10, "execution": 20, "sap": 25, "traversal": 30},
    "encounter": {"soa": 10, "execution": 20, "windows": 25},
    "activity": {"soa": 100, "procedures": 20, "execution": 25, "footnotes": 30},
}

# Words that mean the same visit, in order of precedence.
ALIASES = (
    ("end of study", ("end of study", "eos", "study completion")),
    ("screening", ("screening", "screen")),
    ("day 1", ("day 1", "baseline", "randomization")),
    ("follow-up", ("follow-up", "followup", "safety")),
    ("end of treatment", ("end of treatment", "eot")),
)

# Words of an enumeration's text and the value they stand for, in order of precedence.
ENUMS = {
    "blinding": (("double", "Double Blind"), ("single", "Single Blind"), ("triple", "Triple Blind"), ("open", "Open Label")),
    "arm": (("placebo", "Placebo Comparator"), ("active", "Active Comparator"), ("control", "No Intervention"), ("experimental", "Experimental")),
    "impact": (("major", "Major"), ("substantial", "Major"), ("minor", "Minor"), ("admin", "Administrative")),
}

#: Timing words that a visit's name may carry.
TIMING = r"(?i)((?:day|week|month)\s*[-−+]?[0-9]+(?:\s*(?:±|\+/-)\s*[0-9]+\s*(?:days?|weeks?))?)"


def prepared(contributions: DataFrame) -> DataFrame:
    """Contributions (protocol_id, source, priority, pos, id, name, ...) with raw_name, the cleaned name, the footnote marks
    of the raw one and key, the normalised name by which they are one entity. Names that are empty then are left out."""
    c = contributions.withColumn("raw_name", F.col("name")).withColumn("name", T.clean_name(F.col("name")))
    c = c.withColumn("footnotes", T.footnote_refs(F.col("raw_name"))).withColumn("key", T.normalize_name(F.col("name")))
    return c.filter("key <> ''")


def reconciled(contributions: DataFrame, policies: dict[str, str]) -> DataFrame:
    """One entity per document and key: the first-seen name, the raw name and id of the highest priority (a stable id
    where none has one), its sources and footnotes, and the other columns by their policies."""
    c = prepared(contributions).withColumn("sources", F.col("source"))
    out = reconcile.reconcile(c, ["protocol_id", "key"], {"name": "seen", "raw_name": "first", "id": "first", "sources": "set", "footnotes": "union", **policies})
    return out.withColumn("id", F.coalesce("id", T.stable_id(F.col("protocol_id"), F.col("key"))))


def epochs(contributions: DataFrame) -> DataFrame:
    """Epochs: main if any source says so, else the first and last; in order of main ones first, then sequence (999 where
    none), with previous and next ids."""
    found = reconciled(contributions, {"is_main": "any", "sequence": "first"})
    found = found.withColumn("is_main", F.coalesce("is_main", F.lit(False))).withColumn("_s", F.coalesce("sequence", F.lit(999)))
    out = reconcile.main_fallback(found, "protocol_id", ["_s", "name"], "is_main")
    w = Window.partitionBy("protocol_id").orderBy(F.col("is_main").desc(), "_s", "name")
    return out.withColumns({"place": F.row_number().over(w), "previous_id": F.lag("id").over(w), "next_id": F.lead("id").over(w)}).drop("_s")


#: Contributions that one task takes of encounters().
ROWS = 200_000


def encounters(contributions: DataFrame) -> DataFrame:
    """Encounters with an epoch: window bounds come from one source together; study day from the source or the name.
    Contributions are dealt by document to tasks of about ROWS each, so that what a task holds does not grow with them; how
    many there are comes from a count. Merging and ordering both stay within these."""
    many = max(1, -(-contributions.count() // ROWS), int(contributions.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    c = contributions.repartition(many, "protocol_id")
    c = c.withColumn("window", F.when(F.col("window_before").isNotNull() | F.col("window_after").isNotNull(), F.struct("window_before", "window_after"))).drop("window_before", "window_after")
    found = reconciled(c, {"epoch_id": "first", "study_day": "first", "window": "first"}).filter("epoch_id IS NOT NULL")
    found = found.withColumn("study_day", F.coalesce("study_day", T.number_after(F.col("name"), "day"))).withColumn("study_week", T.number_after(F.col("name"), "week"))
    kind = T.first_rule(F.lower("name"), (("screening", "Screening Visit"), ("baseline", "Baseline Visit"), ("follow-up", "Follow-up Visit")), "Study Visit")
    w = Window.partitionBy("protocol_id").orderBy(F.coalesce("study_day", F.lit(9999)), F.coalesce("study_week", F.lit(9999)), "name")
    return found.withColumn("type", kind).withColumn("place", F.row_number().over(w)).select("*", "window.window_before", "window.window_after").drop("window")


def activities(contributions: DataFrame, groups: DataFrame) -> DataFrame:
    """Activities without those that are a group's header (groups: protocol_id, name): required if all sources say so,
    conditional if any does, in order of group and name."""
    found = reconciled(contributions, {"group_id": "first", "is_required": "all", "is_conditional": "any"})
    heads = groups.select("protocol_id", T.normalize_name(F.col("name")).alias("key")).distinct()
    w = Window.partitionBy("protocol_id").orderBy(F.coalesce("group_id", F.lit("zzz")), "name")
    return found.join(heads, ["protocol_id", "key"], "left_anti").withColumn("place", F.row_number().over(w))


def visit_facts(name: Column) -> Column:
    """What two names of visits are compared by: struct<plain, kinds, week, visit, day>; kinds has a bit for each group of
    ALIASES that the name has a word of. Nulls where the name has no such part."""
    plain = T.normalize_name(name)
    kinds = F.lit(0)
    for bit, (_, words) in enumerate(ALIASES):
        some = F.lit(False)
        for w in words:
            some = some | F.contains(plain, F.lit(w))
        kinds = kinds + F.when(some, 1 << bit).otherwise(0)
    return F.struct(plain.alias("plain"), kinds.alias("kinds"), *(T.number_after(name, word).alias(word) for word in ("week", "visit", "day")))


def visit_rank(wanted: Column, found: Column) -> Column:
    """How well one visit answers to another that is asked for, both as visit_facts(): 1 equal, 2 one name holds the other,
    3 both mean the same visit, 4 same week, 5 same visit number, 6 same day; null where not at all."""
    a, b = wanted["plain"], found["plain"]
    out = F.when(a == b, 1).when((a != "") & (b != "") & (F.contains(a, b) | F.contains(b, a)), 2).when(wanted["kinds"].bitwiseAND(found["kinds"]) != 0, 3)
    for tier, word in ((4, "week"), (5, "visit"), (6, "day")):
        out = out.when(wanted[word] == found[word], tier)
    return out


def resolve_visits(asked: DataFrame, encounters: DataFrame, keys: list[str], facts: str | None = None) -> DataFrame:
    """(keys, wanted, id, tier) for each visit asked for by name (protocol_id, wanted): the encounter of its document
    (id, name, pos) with the best rank, then the first; null where none answers, also where wanted or all names are null.

    Names are taken apart once for each row, before a document's visits meet its encounters, which are as few as the columns
    of its schedule; what meets then are numbers and short texts. Where both tables hold visit_facts() of their names
    already, facts is that column."""
    e = encounters.select("protocol_id", F.col("id").alias("_id"), F.col("pos").alias("_pos"), (F.col(facts) if facts else visit_facts(F.col("name"))).alias("_f"))
    w = asked.select(*dict.fromkeys(["protocol_id", *keys]), "wanted", (F.col(facts) if facts else visit_facts(F.col("wanted"))).alias("_w"))
    ranked = w.join(e, "protocol_id").withColumn("tier", visit_rank(F.col("_w"), F.col("_f"))).filter("tier IS NOT NULL")
    best = ranked.groupBy(*keys, "wanted").agg(F.min_by(F.struct(F.col("_id").alias("id"), "tier"), F.struct("tier", "_pos")).alias("_b"))
    return asked.select(*keys, "wanted").join(best, [*keys, "wanted"], "left").select(*keys, "wanted", "_b.id", "_b.tier")


def canonical_windows(windows: DataFrame, group: list[str]) -> DataFrame:
    """One window per canonical visit of a group: of ends of study or treatment the last day, of screening and baseline the
    first, of others the first row. windows: name, day, pos."""
    low = T.normalize_name(F.col("name"))
    canonical = F.when(low.rlike("end of study|eos|early termination"), "eos").when(F.contains(low, F.lit("screening")), "screening").when(F.contains(low, F.lit("baseline")), "baseline").otherwise(low)
    order = F.when(F.col("canonical") == "eos", -F.col("day")).when(F.col("canonical").isin("screening", "baseline"), F.col("day")).otherwise(F.col("pos"))
    rows = windows.withColumn("canonical", canonical)
    best = rows.groupBy(*group, "canonical").agg(F.min_by(F.struct("name", "day", "pos"), F.struct(order.alias("o"), F.col("pos").alias("p"))).alias("_w"))
    return best.select(*group, "canonical", "_w.*")


def split_timing(name: Column) -> Column:
    """struct(name, timing): a visit's name without the timing that it carries, and that timing; dashes, colons and
    brackets left over are trimmed."""
    timing = F.nullif(F.regexp_extract(name, TIMING, 1), F.lit(""))
    rest = F.regexp_replace(F.regexp_replace(name, TIMING, ""), r"^[\s\-–—:()]+|[\s\-–—:()]+$", "")
    return F.struct(F.coalesce(F.nullif(rest, F.lit("")), name).alias("name"), timing.alias("timing"))


def clean_text(text: Column) -> Column:
    """Text without control characters, with single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"[\x00-\x1f\x7f-\x9f]", " "), " +", " "))


def enum_value(domain: str, text: Column, default: str) -> Column:
    return T.first_rule(F.lower(text), ENUMS[domain], default)


def dose_elements(regimens: DataFrame, key: list[str], levels: str) -> DataFrame:
    """One element per dose level of a regimen, chained to the one before."""
    rows = regimens.select(*key, F.posexplode(levels).alias("pos", "amount"))
    w = Window.partitionBy(*key).orderBy("pos")
    return rows.withColumn("element_id", T.stable_id(*[F.col(k) for k in key], F.col("pos"))).withColumn("previous_id", F.lag("element_id").over(w))


def promoted_anchors(anchors: DataFrame) -> DataFrame:
    """Anchors that are visits or events, in order of day and of their order within a day, each with an instance id;
    conceptual anchors make none. anchors: protocol_id, kind, day."""
    order = T.first_rule(F.col("kind"), (("Consent", "10"), ("Screening", "20"), ("Enrol", "30"), ("Randomization", "40"), ("Baseline", "50"), ("FirstDose", "60"), ("Treatment", "60"), ("Cycle", "70"), ("Day1", "80"), ("Collection", "90")), "100").cast("int")
    rows = anchors.withColumn("intra_day", order).withColumn("anchor_class", F.when(F.col("kind").isin("Screening", "Day1", "Baseline"), "visit").when(F.col("kind").isin("FirstDose", "TreatmentStart", "Randomization", "Consent", "Enrolment"), "event").otherwise("conceptual"))
    w = Window.partitionBy("protocol_id").orderBy("day", "intra_day", "kind")
    return rows.filter("anchor_class <> 'conceptual'").withColumn("place", F.row_number().over(w)).withColumn("instance_id", T.stable_id(F.col("protocol_id"), F.col("kind"), F.col("day")))


def base_similarity(a: str | None, b: str | None) -> float:
    """Similarity of two texts: 1 where both are empty, 0 where one is; else the Ratcliff-Obershelp ratio, at least 0.85
    where one of 8 characters or more is in the other, and at least 0.6 + 0.3 r where a share r of half or more of the
    shorter one's words is in the other. 'tbd', '-', 'n/a', 'none' and 'unknown' are empty."""
    x, y = ("" if t is None or t.strip().lower() in ("tbd", "-", "n/a", "none", "unknown") else " ".join(t.lower().split()) for t in (a, b))
    if not x or not y:
        return float(x == y)
    out = difflib.SequenceMatcher(None, x, y).ratio()
    if min(len(x), len(y)) >= 8 and (x in y or y in x):
        out = max(out, 0.85)
    u, v = set(x.split()), set(y.split())
    r = len(u & v) / min(len(u), len(v))
    return max(out, 0.6 + 0.3 * r) if r >= 0.5 else out


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """base_similarity() of two columns."""
    return pd.Series([base_similarity(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

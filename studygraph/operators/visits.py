"""Visits with their days and windows, from the lines of a text and from a schedule, merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# How visits are written, with the name that a find gets ({} is its first group).
VISITS = (
    (r"(?i)(?:Visit|V)\s*(\d+)", "Visit {}"),
    (r"(?i)(Screening|Baseline|Randomization)\s*(?:Visit)?", "{}"),
    (r"(?i)Week\s*(\d+)\s*(?:Visit)?", "Week {}"),
    (r"(?i)Day\s*(\d+)", "Day {}"),
    (r"(?i)Month\s*(\d+)", "Month {}"),
    (r"(?i)(End\s+of\s+(?:Study|Treatment)|EOS|EOT)", "{}"),
    (r"(?i)(Follow[\-\s]?up)\s*(?:Visit)?", "Follow-up"),
    (r"(?i)(Early\s+Termination|ET)", "Early Termination"),
)
# How windows are written; with one group the days on both sides, with two those before and after.
ALLOWANCES = (
    r"(?i)[±]\s*(\d+)\s*days?",
    r"(?i)\+[\s/]*-\s*(\d+)\s*days?",
    r"(?i)\(\s*[±]\s*(\d+)\s*days?\s*\)",
    r"(?i)within\s*(\d+)\s*days?",
    r"(?i)[\-−]\s*(\d+)\s*(?:days?)?\s*(?:to|through|and)\s*\+?\s*(\d+)\s*days?",
    r"(?i)window\s*(?:of|:)?\s*(\d+)\s*days?",
    r"(?i)(\d+)[\-\s]?day\s+window",
    r"(?i)(?:allowable|allowed)\s+(?:deviation|variance)[:\s]+(\d+)\s*days?",
)
# Windows of visits for which none is written, by words of their names, and of all others.
DEFAULT_WINDOWS = (("screening", 7, 0), ("baseline", 1, 1), ("day 1", 0, 0), ("randomization", 0, 0), ("follow-up", 7, 7), ("end of study", 3, 7), ("end of treatment", 3, 3), ("early termination", 0, 0))
OTHER_WINDOW = (3, 3)
# Words of visits that come with an event and not on a day, and days of those that always have the same.
EVENTS = ("early termination", "et visit", "withdrawal", "end of treatment", "eot", "end-of-treatment", "end of study", "eos", "end-of-study", "unscheduled")
FIXED_DAYS = (("screening", -14), ("baseline", 0), ("randomization", 1), ("follow", 365))
OPTIONAL = ("optional", "if applicable", "as needed", "prn", "unscheduled")
REQUIRED = ("required", "mandatory", "must")
# Names of one visit.
SYNONYMS = {
    "end of treatment": ("eot", "end of treatment", "end-of-treatment", "treatment end"),
    "end of study": ("eos", "end of study", "end-of-study", "study end", "study completion"),
    "early termination": ("et", "early termination", "early withdrawal", "discontinuation"),
}


def _has(text: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w))
    return out


def canonical_visit(name: Column) -> Column:
    """A visit's name in lower case without what stands in brackets or behind a dash at its end; synonyms are one name."""
    low = F.lower(F.trim(name))
    low = F.regexp_replace(low, r"\s*\([^)]+\)\s*$", "")
    low = F.regexp_replace(low, r"\s*[-/]\s*(discharge|start|return|end|visit).*$", "")
    out = low
    for one, names in SYNONYMS.items():
        out = F.when(low.isin(*names), F.lit(one)).otherwise(out)
    return F.trim(out)


def visit_day(name: Column, context: Column) -> Column:
    """struct<day, week> of a visit: told in its name, fixed for its kind, null for visits that come with an event, else told
    in the context. Week 1 begins on day 1."""
    number = lambda text, word: F.regexp_extract(text, rf"(?i){word}\s*(\d+)", 1).try_cast("long")
    low = F.lower(name)
    week_day = lambda w: (w - 1) * 7 + 1
    day = F.when(number(name, "Day").isNotNull(), number(name, "Day")).when(number(name, "Week").isNotNull(), week_day(number(name, "Week"))).when(_has(low, EVENTS), None)
    for word, fixed in FIXED_DAYS:
        day = day.when(F.contains(low, F.lit(word)), F.lit(fixed).cast("long"))
    day = day.otherwise(F.coalesce(number(context, "Day"), week_day(number(context, "Week"))))
    special = _has(low, EVENTS) | _has(low, tuple(w for w, _ in FIXED_DAYS))
    week = F.when(number(name, "Day").isNotNull(), None).when(number(name, "Week").isNotNull(), number(name, "Week")).when(special, None).otherwise(number(context, "Week"))
    return F.struct(day.alias("day"), week.alias("week"))


def allowance(context: Column, name: Column) -> Column:
    """struct<before, after> in days: the first way of writing a window that the context has; where it has none, or no
    days, that of the visit's kind."""
    found = F.lit(None).cast("struct<before: long, after: long>")
    for p in reversed(ALLOWANCES):
        first = F.regexp_extract(context, p, 1).try_cast("long")
        second = F.regexp_extract(context, p, 2).try_cast("long") if p.count("(\\d+)") > 1 else first
        found = F.when(context.rlike(p), F.struct(first.alias("before"), second.alias("after"))).otherwise(found)
    low, default = F.lower(name), F.struct(*(F.lit(n).cast("long").alias(a) for n, a in zip(OTHER_WINDOW, ("before", "after"), strict=True)))
    for word, before, after in reversed(DEFAULT_WINDOWS):
        default = F.when(F.contains(low, F.lit(word)), F.struct(F.lit(before).cast("long").alias("before"), F.lit(after).cast("long").alias("after"))).otherwise(default)
    return F.when((found["before"] != 0) | (found["after"] != 0), found).otherwise(default)


def visit_windows(rows: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys, nth, visit, day, week, before, after, required) of every visit that a row's text names, each by its first line;
    nth counts lines and ways of writing from 1. A line is read with the two after it. Visits are required but where those lines
    say otherwise. Null and empty texts give none. A row's lines stay in it: no line is shuffled."""
    lines = F.split(F.col(text), "\n")

    def named(line: Column, i: Column) -> Column:
        context = F.array_join(F.slice(lines, i + 1, F.lit(3)), "\n")
        made = []
        for n, (pattern, name) in enumerate(VISITS):
            head, _, tail = name.partition("{}")
            visit = F.concat(F.lit(head), F.regexp_extract(line, pattern, 1), F.lit(tail)) if "{}" in name else F.lit(name)
            made.append(F.when(line.rlike(pattern), F.struct((i * len(VISITS) + n + 1).alias("nth"), visit.alias("visit"), context.alias("context"))))
        return F.array_compact(F.array(*made))

    worth = F.col(text).rlike("|".join(p for p, _ in VISITS))
    found = F.flatten(F.transform(lines, named))
    with_names = rows.select(*keys, F.when(worth, F.transform(found, lambda v: F.struct(v["nth"], v["visit"], v["context"], canonical_visit(v["visit"]).alias("canonical")))).alias("_v"))
    names = F.transform("_v", lambda v: v["canonical"])
    once = with_names.select(*keys, F.explode(F.filter("_v", lambda v, i: F.array_position(names, v["canonical"]) == i + 1)).alias("_v"))
    told = once.select(*keys, F.col("_v.nth").alias("nth"), F.col("_v.visit").alias("visit"), visit_day(F.col("_v.visit"), F.col("_v.context")).alias("_d"), allowance(F.col("_v.context"), F.col("_v.visit")).alias("_w"), F.lower("_v.context").alias("_c"))
    required = F.when(_has(F.col("_c"), OPTIONAL), False).otherwise(True)
    return told.select(*keys, "nth", "visit", "_d.day", "_d.week", "_w.before", "_w.after", required.alias("required"))


def merged_visits(primary: DataFrame, secondary: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, number, visit, day, week, before, after, origin) of the visits of two sources (keys, nth, visit, day, week,
    before, after), those of the primary one first in rank.

    Within the primary source a name (canonical_visit) counts once, by its first visit; so does a day, with its longest name.
    A visit of the secondary source is taken if neither its name nor its day is there; else it only gives the visit of that
    name, or else of that day, the days before and after where it has none (0 or null). Visits are numbered by day, those
    without a day as if at 0, then by order. Keys are compared as equal where both are null."""
    cols = ["visit", "day", "week", "before", "after"]

    def ready(df: DataFrame, origin: int) -> DataFrame:
        return df.select(*keys, F.struct(F.lit(origin).alias("origin"), "nth").alias("_at"), *cols, canonical_visit(F.col("visit")).alias("_name"))

    def one_per(df: DataFrame, by: str, order: Column) -> DataFrame:
        rest = [c for c in df.columns if c not in keys and c != by]
        best = df.groupBy(*keys, by).agg(F.min_by(F.struct(*rest), order).alias("_b"), F.min("_at").alias("_first"))
        return best.select(*keys, by, *(F.col(f"_b.{c}").alias(c) for c in rest if c != "_at"), F.col("_first").alias("_at"))

    def once(df: DataFrame) -> DataFrame:
        named = one_per(df, "_name", F.col("_at"))
        dated = one_per(named.filter("day IS NOT NULL"), "day", F.struct((-F.length("visit")).alias("l"), "_at"))
        return dated.unionByName(named.filter("day IS NULL"))

    first, others = once(ready(primary, 0)), once(ready(secondary, 1))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]

    def hits(on: str) -> DataFrame:
        return others.alias("b").join(first.alias("a"), [*same, F.col(f"a.{on}") == F.col(f"b.{on}")]).select(*(F.col(f"b.{k}").alias(k) for k in keys), F.col("b._at").alias("_by"), F.col("a._at").alias("_to"), F.lit(on == "_name").alias("_named"))

    met = hits("_name").unionByName(hits("day")).groupBy(*keys, "_by").agg(F.max_by("_to", "_named").alias("_to"))
    left = [F.col(f"o.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys]
    linked = others.alias("o").join(met.alias("m"), [*left, F.col("o._at") == F.col("m._by")], "left").select("o.*", F.col("m._to").alias("_to"))
    fresh = linked.filter("_to IS NULL").drop("_to")
    positive = lambda c: F.when(F.col(c) > 0, F.col(c))
    gives = linked.filter("_to IS NOT NULL").groupBy(*keys, "_to").agg(F.min_by(positive("before"), F.when(F.col("before") > 0, F.col("_at"))).alias("_before"), F.min_by(positive("after"), F.when(F.col("after") > 0, F.col("_at"))).alias("_after"))
    right = [F.col(f"f.{k}").eqNullSafe(F.col(f"g.{k}")) for k in keys]
    filled = first.alias("f").join(gives.alias("g"), [*right, F.col("f._at") == F.col("g._to")], "left")
    enhanced = filled.select(*(F.col(f"f.{k}").alias(k) for k in keys), F.col("f._name").alias("_name"), F.col("f._at").alias("_at"), *(F.col(f"f.{c}").alias(c) for c in ("visit", "day", "week")), *(F.coalesce(F.nullif(F.col(f"f.{c}"), F.lit(0)), F.col(f"g._{c}"), F.col(f"f.{c}")).alias(c) for c in ("before", "after")))
    both = enhanced.unionByName(fresh)
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(F.coalesce("day", F.lit(0)), "_at"))  # the visits of one study
    return both.select(*keys, number.cast("long").alias("number"), *cols, F.when(F.col("_at.origin") == 0, "primary").otherwise("secondary").alias("origin"))

"""Days that a text names: intervals of signed days, daily collections bound to them, analysis windows, collection days and
the details of repetitions; and joins of intervals.

A day interval is struct<start: long, end: long>; day 1 is the first of treatment, days before have a minus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studygraph.functions.literals import can_match
from studygraph.operators import rules as R

# Activities that are collected every day.
DAILY_COLLECTIONS = (
    (r"(?:24[\-\s]?hour|daily)\s+urine\s+(?:collection|sample)", "urine_collection"),
    (r"(?:feces|stool|fecal)\s+(?:collection|sample)", "feces_collection"),
    (r"(?:controlled|standardized)\s+(?:meal|diet)", "controlled_meal"),
    (r"daily\s+(?:meal|food)\s+(?:intake|consumption)", "meal_intake"),
    (r"(?:copper|cu|molybdenum|mo)\s+balance", "balance_collection"),
    (r"daily\s+weight", "daily_weight"),
    (r"daily\s+diary", "daily_diary"),
)
DAY_RANGE = r"(?i)(?:days?\s*)?([-–]?\d+)\s*(?:to|through|[-–])\s*(?:days?\s*)?([-–]?\d+)"
# Windows of analysis with their days, by kind, with their names.
WINDOWS = (
    (r"(?i)(?:baseline|pre[\-\s]?treatment)\s+(?:period|window|phase|days?)?\s*[:\-]?\s*(?:days?\s*)?([-–−]?\s*\d+)\s*(?:to|through|[-–−])\s*(?:days?\s*)?([-–−]?\s*\d+)", "baseline", "Baseline Period"),
    (r"(?i)(?:treatment|dosing|active)\s+(?:period|window|phase)?\s*[:\-]?\s*(?:days?\s*)?(\d+)\s*(?:to|through|[-–])\s*(?:days?\s*)?(\d+)", "treatment", "Treatment Period"),
    (r"(?i)steady[\-\s]?state\s+(?:period|window|phase|days?)?\s*[:\-]?\s*(?:days?\s*)?(\d+)\s*(?:to|through|[-–])\s*(?:days?\s*)?(\d+)", "steady_state", "Steady-State Period"),
)
# Where a day of collection begins.
COLLECTION_DAYS = (
    r"(?i)24[\-\s]?hour\s+(?:urine|collection)\s+(?:period|window|from)\s*(\d{1,2})[:\.]?(\d{2})?\s*(?:am|pm|hours?)?",
    r"(?i)collection\s+(?:day|period)\s+(?:begins?|starts?|from)\s*(\d{1,2})[:\.]?(\d{2})?\s*(?:am|pm|hours?)?",
    r"(?i)(?:morning|am)\s+(?:of\s+)?day\s+\d+\s+to\s+(?:morning|am)\s+(?:of\s+)?day\s+\d+",
    r"(?i)(?:complete\s+)?24[\-\s]?hour\s+(?:urine|stool|feces|collection)",
)
_DETAIL = "array<struct<kind: string, confidence: double, place: int, match: string, interval: string, observations: int, cycle_length: string, start_offset: string, end_offset: string, exit_condition: string>>"
#: How far around a find its days are looked for.
AROUND = 200


def signed_day(text: Column) -> Column:
    """A day's number with its sign, whatever dash that is; null for numbers of more than 18 digits."""
    return F.regexp_replace(F.translate(text, "–−—", "---"), r"[^\d\-]", "").try_cast("long")


def offset(day: Column) -> Column:
    """A signed day as an ISO duration."""
    return F.when(day < 0, F.concat(F.lit("-P"), -day, F.lit("D"))).otherwise(F.concat(F.lit("P"), day, F.lit("D")))


def finds(text: Column, pattern: str) -> Column:
    """array<struct<place, match>> of all matches of a pattern, place from 0."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    both = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda gap, m: F.struct(F.length(gap).alias("gap"), m.alias("match")))
    none = F.array().cast("array<struct<place: int, match: string>>")
    step = lambda s, x: F.struct((s["at"] + x["gap"] + F.length(x["match"])).alias("at"), F.concat(s["out"], F.array(F.struct((s["at"] + x["gap"]).alias("place"), x["match"].alias("match")))).alias("out"))
    places = F.aggregate(both, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda s: s["out"])
    return F.when(F.size(found) > 0, places).otherwise(none)


def around(text: Column, place: Column, match: Column, width: int = AROUND) -> Column:
    """The match with up to width characters on both sides."""
    start = F.greatest(place - width, F.lit(0))
    return F.substr(text, start + 1, place + F.length(match) + width - start)


def _interval(match: Column, pattern: str) -> Column:
    return F.struct(signed_day(F.regexp_extract(match, pattern, 1)).alias("start"), signed_day(F.regexp_extract(match, pattern, 2)).alias("end"))


def _known(rows: DataFrame) -> DataFrame:
    return rows.filter("days.start IS NOT NULL AND days.end IS NOT NULL")


def daily_bindings(rows: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys, activity, name, days, expected, start_offset, end_offset, source) of every daily collection that a row's text
    names and every range of days within 200 characters of it: expected is how many days the range has, whichever way it
    is written. Null texts, and collections without days, give none; a collection named twice near one range counts twice."""
    found = F.array(*(F.transform(finds(F.col("_t"), f"(?i){p}"), lambda x: F.struct(F.lit(a).alias("activity"), x["place"].alias("place"), x["match"].alias("match"))) for p, a in DAILY_COLLECTIONS))
    named = rows.select(*keys, F.col(text).alias("_t")).select(*keys, "_t", F.explode(F.flatten(found)).alias("_f"))
    ranges = F.regexp_extract_all(around(F.col("_t"), F.col("_f.place"), F.col("_f.match")), F.lit(DAY_RANGE), F.lit(0))
    told = named.select(*keys, "_f", F.explode(ranges).alias("_r")).withColumn("days", _interval(F.col("_r"), DAY_RANGE))
    start, end = F.col("days.start"), F.col("days.end")
    return _known(told).select(*keys, F.col("_f.activity").alias("activity"), F.col("_f.match").alias("name"), "days", (F.abs(end - start) + 1).alias("expected"), offset(start).alias("start_offset"), offset(end).alias("end_offset"), F.concat("_f.match", F.lit(" ("), "_r", F.lit(")")).alias("source"))


def analysis_windows(rows: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys, kind, name, days, source) of every window of analysis that a row's text gives days for."""
    found = F.array(*(F.transform(F.regexp_extract_all(F.col(text), F.lit(p), F.lit(0)), lambda m: F.struct(F.lit(k).alias("kind"), F.lit(n).alias("name"), _interval(m, p).alias("days"), m.alias("source"))) for p, k, n in WINDOWS))
    return _known(rows.select(*keys, F.explode(F.flatten(found)).alias("_w")).select(*keys, "_w.*"))


def collection_day(text: Column) -> Column:
    """The first mention of a 24-hour day of collection, in the order of COLLECTION_DAYS; null where there is none."""
    return F.coalesce(*(F.nullif(F.regexp_extract(text, p, 0), F.lit("")) for p in COLLECTION_DAYS))


def repetition_details(rows: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys, kind, confidence, place, match, interval, observations, cycle_length, start_offset, end_offset, exit_condition)
    of every match of every rule of R.REPETITIONS in a row's text.

    Daily: interval a day, from and to the first range of days within 200 characters. Interval: the number found, in hours
    where its rule speaks of them, else minutes; of a list of minutes the first step, and how many they are. Cycle: its days,
    and how it ends as told near it. Continuous windows: from and to their days. Parts that the text lacks are null."""
    duration = r"(?i)day(?:s)?\s*[-–]?\s*(\d+)\s*(?:to|through|[-–])\s*(?:day\s*)?[-–]?\s*(\d+)"
    t, null = F.col("_t"), F.lit(None).cast("string")

    def one(pattern: str, kind: str, confidence: float) -> Column:
        def told(x: Column) -> Column:
            near, first, second = around(t, x["place"], x["match"]), F.lit(""), F.lit("")
            groups = _groups(pattern)
            if groups:
                first = F.regexp_extract(x["match"], f"(?i){pattern}", 1)
            if groups > 1:
                second = F.regexp_extract(x["match"], f"(?i){pattern}", 2)
            interval = cycle = start = end = leaves = null
            many = F.lit(None).cast("int")
            if kind == "Daily":
                interval = F.lit("P1D")
                has = near.rlike(duration)
                start, end = (F.when(has, F.concat(F.lit("P"), F.regexp_extract(near, duration, g).try_cast("long"), F.lit("D"))) for g in (1, 2))
            elif kind == "Interval":
                listed = F.transform(F.split(first, ","), lambda p: F.trim(p).try_cast("int"))
                is_list = F.contains(first, F.lit(",")) & ~F.exists(listed, lambda n: n.isNull())
                unit = "H" if "hour" in pattern or "hr" in pattern or pattern.endswith("h") else "M"
                interval = F.when(is_list, F.concat(F.lit("PT"), F.try_element_at(listed, F.lit(2)) - F.try_element_at(listed, F.lit(1)), F.lit("M"))).when(~F.contains(first, F.lit(",")), F.concat(F.lit("PT"), first.try_cast("long"), F.lit(unit)))
                many = F.when(is_list, F.size(listed))
            elif kind == "Cycle":
                cycle = F.concat(F.lit("P"), F.when(first.try_cast("long") > 0, first.try_cast("long")), F.lit("D"))
                low = F.lower(near)
                leaves = F.when(F.contains(low, F.lit("progression")), "Disease progression").when(F.contains(low, F.lit("toxicity")), "Unacceptable toxicity")
            elif groups > 1:
                start, end = (offset(F.when(signed_day(d) != 0, signed_day(d))) for d in (first, second))
            return F.struct(
                F.lit(kind).alias("kind"), F.lit(confidence).alias("confidence"), x["place"].alias("place"), x["match"].alias("match"), interval.alias("interval"), many.alias("observations"), cycle.alias("cycle_length"),
                start.alias("start_offset"), end.alias("end_offset"), leaves.alias("exit_condition"),
            )

        found = F.transform(finds(t, f"(?i){pattern}"), told)
        return F.when(can_match(F.col("_low"), pattern), found).otherwise(F.array().cast(_DETAIL))

    found = F.flatten(F.array(*(one(p, k, c) for p, k, c in R.REPETITIONS)))
    given = rows.select(*keys, F.col(text).alias("_t"), F.lower(text).alias("_low"))
    return given.select(*keys, F.explode(found).alias("_r")).select(*keys, "_r.*")


def _groups(pattern: str) -> int:
    """How many capturing groups a pattern has."""
    return sum(c == "(" and pattern[i + 1 : i + 2] != "?" and pattern[i - 1 : i] != "\\" for i, c in enumerate(pattern))


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], width: int = 28) -> DataFrame:
    """The pairs of rows of left and right with equal keys (null meets nothing) whose intervals `days` share a day, ends
    included and in either order: the columns of left, those of right but keys as right_ and their name, and relation, what
    left is to right: "equal", "within", "contains" or "overlaps". Intervals without start or end meet nothing.

    Intervals are spread to buckets of width days, and pairs are joined by keys and bucket, and kept in the first bucket that
    both have; so a key with very many intervals is joined piece by piece."""
    low, high = (lambda d: F.least(d["start"], d["end"])), (lambda d: F.greatest(d["start"], d["end"]))
    whole = lambda df: df.filter("days.start IS NOT NULL AND days.end IS NOT NULL")
    bucket = lambda d: F.floor(d / width)
    other = right.select(*keys, *(F.col(c).alias(f"right_{c}") for c in right.columns if c not in keys))
    a, b = F.col("days"), F.col("right_days")
    spread = whole(left).withColumn("_bucket", F.explode(F.sequence(bucket(low(a)), bucket(high(a)))))
    others = other.filter("right_days.start IS NOT NULL AND right_days.end IS NOT NULL").withColumn("_bucket", F.explode(F.sequence(bucket(low(b)), bucket(high(b)))))
    met = spread.join(others, [*keys, "_bucket"]).filter((low(a) <= high(b)) & (low(b) <= high(a)) & (F.col("_bucket") == bucket(F.greatest(low(a), low(b)))))
    relation = F.when((low(a) == low(b)) & (high(a) == high(b)), "equal").when((low(a) >= low(b)) & (high(a) <= high(b)), "within").when((low(a) <= low(b)) & (high(a) >= high(b)), "contains").otherwise("overlaps")
    return met.withColumn("relation", relation).drop("_bucket")

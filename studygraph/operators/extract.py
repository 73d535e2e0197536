"""Rule-based extraction from text: each extractor is a table of patterns and a few expressions over their matches. Texts
are matched in lower case; a rule table is an argument, so that other vocabularies can be used."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studygraph.functions.literals import can_match
from studygraph.operators import rules as R
from studygraph.operators.rules import ANCHORS, EXECUTION_TYPES, REPETITIONS, Rule

__all__ = ["ANCHORS", "EXECUTION_TYPES", "REPETITIONS", "Rule"]

# Classes of this library's own making for single lines, in order of precedence; what matches none is general. The kinds of
# conditions are in notes.py.
FOOTNOTE_CLASSES: tuple[tuple[str, str], ...] = (
    (r"within\s+[0-9]+|prior\s+to|before|after|hours?|minutes?", "timing"),
    (r"only\s+(?:for|if|in)|female|childbearing|eligib", "eligibility"),
    (r"fasting|supine|collected|perform", "procedure"),
    (r"every|weekly|monthly|daily", "frequency"),
)

# States and the patterns that show them.
STATES: tuple[tuple[str, str], ...] = (
    ("Screening", r"screening"),
    ("Enrolled", r"enroll(?:ed|ment)"),
    ("Randomized", r"random(?:ized?|ization)"),
    ("OnTreatment", r"(?:on\s+)?treatment\s+(?:period|phase)"),
    ("Completed", r"complet(?:ed?|ion)"),
    ("Discontinued", r"discontinu(?:ed?|ation)"),
    ("FollowUp", r"follow[- ]?up"),
    ("LostToFollowUp", r"lost\s+to\s+follow[- ]?up"),
    ("Withdrawn", r"withdr(?:ew|awn|awal)"),
    ("Death", r"death|died|deceased"),
)

# Standard transitions between states.
TRANSITIONS: tuple[tuple[str, str, str], ...] = (
    ("Screening", "Enrolled", "Meets eligibility criteria"),
    ("Screening", "Discontinued", "Screen failure"),
    ("Enrolled", "Randomized", "Randomization"),
    ("Enrolled", "Discontinued", "Early withdrawal before randomization"),
    ("Randomized", "OnTreatment", "First dose administered"),
    ("Randomized", "Discontinued", "Withdrawal before treatment"),
    ("OnTreatment", "Completed", "Completes treatment period"),
    ("OnTreatment", "Discontinued", "Discontinues treatment"),
    ("OnTreatment", "FollowUp", "Enters follow-up"),
    ("OnTreatment", "Death", "Death on treatment"),
    ("FollowUp", "Completed", "Completes follow-up"),
    ("FollowUp", "LostToFollowUp", "Lost to follow-up"),
    ("FollowUp", "Withdrawn", "Withdraws during follow-up"),
    ("FollowUp", "Death", "Death during follow-up"),
    ("Discontinued", "FollowUp", "Safety follow-up after discontinuation"),
    ("Discontinued", "Completed", "Completes early termination procedures"),
)


def all_matches(low: Column, pattern: str) -> Column:
    """All matches of a pattern in a text in lower case; the pattern is tried where a text that it needs is there."""
    return F.when(can_match(low, pattern), F.regexp_extract_all(low, F.lit(f"({pattern})"), 1)).otherwise(F.array().cast("array<string>"))


def lowered(df: DataFrame, text: str, id_: Sequence[str]) -> DataFrame:
    """(id, _low): the text in lower case, as a column that every pattern reads; null is the empty text. Other columns of
    df, whatever their names, are not looked at."""
    return df.select(*id_, F.lower(F.coalesce(F.col(text), F.lit(""))).alias("_low"))


def first_of(text: Column, patterns: Sequence[str]) -> Column:
    """The first group of the first pattern that matches, without white space around it; null where none does."""
    return F.coalesce(*[F.nullif(stripped(F.regexp_extract(text, p, 1)), F.lit("")) for p in patterns])


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def all_of(text: Column, patterns: Sequence[str]) -> Column:
    """The distinct first groups of all matches of the patterns, in their order."""
    return F.array_distinct(F.concat(*[F.regexp_extract_all(text, F.lit(p), 1) for p in patterns]))


def kind_of(text: Column, found: Sequence[Rule], default: str) -> Column:
    """The kind of the first rule that matches a text in lower case."""
    return F.coalesce(*[F.when(text.rlike(p), F.lit(kind)) for p, kind, _ in found], F.lit(default))


def rule_hits(df: DataFrame, text: str, rules: Sequence[Rule], id_: Sequence[str] | None = None) -> DataFrame:
    """One row for each text and rule that matches: id (by default all other columns), rule_no (from 1), kind, confidence,
    n (matches) and first (the first match). Null is the empty text; an empty table gives no rows."""
    rest = [c for c in df.columns if c != text] if id_ is None else list(id_)
    low = F.col("_low")
    hits = F.array(*[
        F.struct(F.lit(i).alias("rule_no"), F.lit(kind).alias("kind"), F.lit(c).alias("confidence"), all_matches(low, p).alias("found")) for i, (p, kind, c) in enumerate(rules, 1)
    ])
    kept = F.filter(hits, lambda h: F.size(h["found"]) > 0)
    return lowered(df, text, rest).select(*rest, F.explode(kept).alias("_h")).select(*rest, "_h.rule_no", "_h.kind", "_h.confidence", F.size("_h.found").cast("long").alias("n"), F.element_at("_h.found", 1).alias("first"))


def first_per_kind(df: DataFrame, text: str, id_: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """Of each text and kind the first rule that matches: confidence, first match and number of matches. Each text is looked
    at by itself, so repeated ids give repeated rows."""
    low = F.col("_low")
    hits = F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(c).alias("confidence"), all_matches(low, p).alias("found")) for p, kind, c in rules])
    rows = lowered(df, text, id_).withColumn("_hits", F.filter(hits, lambda h: F.size(h["found"]) > 0))
    kinds = F.transform("_hits", lambda h: h["kind"])
    leading = F.filter("_hits", lambda h, i: F.array_position(kinds, h["kind"]) == i + 1)
    return rows.select(*id_, F.explode(leading).alias("_h")).select(*id_, "_h.kind", "_h.confidence", F.element_at("_h.found", 1).alias("first"), F.size("_h.found").cast("long").alias("n"))


def anchors(df: DataFrame, text: str, id_: Sequence[str]) -> DataFrame:
    """The time anchors of each text, one of each type, by the first rule that matches: kind, definition, confidence, day
    (told in the match or within 100 characters of it, else 1) and first (the match). Null is the empty text."""
    low = F.col("_low")
    hits = F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(c).alias("confidence"), F.when(can_match(low, p), F.regexp_extract(low, f"({p})", 1)).otherwise("").alias("first")) for p, kind, c in R.ANCHORS])
    rows = lowered(df, text, id_).withColumn("_hits", F.filter(hits, lambda h: h["first"] != ""))
    kinds = F.transform("_hits", lambda h: h["kind"])
    found = rows.select(*id_, "_low", F.explode(F.filter("_hits", lambda h, i: F.array_position(kinds, h["kind"]) == i + 1)).alias("_h")).select(*id_, "_low", "_h.*")
    at = F.instr(low, F.col("first"))
    begin = F.greatest(at - 100, F.lit(1))
    around = F.concat_ws(" ", "first", F.substr(low, begin, at + F.length("first") + 100 - begin))
    definition = F.coalesce(*[F.when(F.col("kind") == k, F.lit(d)) for k, d in R.ANCHOR_DEFINITIONS.items()], F.col("first"))
    return found.select(*id_, "kind", definition.alias("definition"), "confidence", F.coalesce(F.regexp_extract(around, r"day\s*(\d+)", 1).try_cast("int"), F.lit(1)).alias("day"), "first")


def best_kind(df: DataFrame, text: str, id_: Sequence[str], rules: Sequence[Rule], default: str) -> DataFrame:
    """Each text's kind with the most matches of its rules together, then the highest confidence of those that match, then
    the first in the order of rules; without a match the default at 0.5."""
    counts = F.array(*[F.when(can_match(F.col("_low"), p), F.regexp_count("_low", F.lit(p))).otherwise(0) for p, _, _ in rules])
    rows = lowered(df, text, id_).select(*id_, counts.alias("_n"))
    scores = []
    for order, kind in enumerate(dict.fromkeys(k for _, k, _ in rules)):
        mine = [(F.col("_n")[i], c) for i, (_, k, c) in enumerate(rules) if k == kind]
        confidence = reduce(lambda a, b: F.greatest(a, b), [F.when(n > 0, F.lit(c)).otherwise(F.lit(0.0)) for n, c in mine])
        scores.append(F.struct(sum((n for n, _ in mine), F.lit(0)).alias("n"), confidence.alias("confidence"), F.lit(-order).alias("at"), F.lit(kind).alias("kind")))
    rows = rows.select(*id_, F.array_max(F.array(*scores)).alias("_b"))
    return rows.select(*id_, F.when(F.col("_b.n") > 0, F.col("_b.kind")).otherwise(F.lit(default)).alias("kind"), F.when(F.col("_b.n") > 0, F.col("_b.confidence")).otherwise(F.lit(0.5)).alias("confidence"))


def footnotes(text: Column) -> Column:
    """array<struct<marker, note>> of the footnotes in a text, each begun by a letter and a period or bracket at the start
    of a line: 'a. Fasting', 'b) Only if'. Notes of at most 15 or at least 800 characters are none."""
    lines = F.filter(F.split(text, "\n"), lambda l: l.rlike(r"^\s*[a-z][.)]\s+"))
    made = F.transform(lines, lambda l: F.struct(F.regexp_extract(l, r"^\s*([a-z])[.)]", 1).alias("marker"), F.trim(F.regexp_replace(l, r"^\s*[a-z][.)]\s+", "")).alias("note")))
    return F.filter(made, lambda n: (F.length(n["note"]) > 15) & (F.length(n["note"]) < 800))


def states(df: DataFrame, text: str, id_: Sequence[str]) -> DataFrame:
    """(id, states): those that the text shows, in the standard order; Screening always."""
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    return df.select(*id_, F.array_compact(F.array(*[F.when(low.rlike(p) | F.lit(s == "Screening"), F.lit(s)) for s, p in STATES])).alias("states"))


def transitions(found: DataFrame, id_: Sequence[str]) -> DataFrame:
    """The standard transitions whose two states a text shows."""
    standard = found.sparkSession.createDataFrame(list(TRANSITIONS), "from_state string, to_state string, trigger string")
    joined = found.join(F.broadcast(standard), F.array_contains("states", F.col("from_state")) & F.array_contains("states", F.col("to_state")))  # 16 standard rows
    return joined.select(*id_, "from_state", "to_state", "trigger")


def randomization(text: Column) -> Column:
    """struct(ratio, block_size) from 'randomized 2:1' and 'block size of 4'; nulls where none."""
    low = F.lower(text)
    ratio = F.nullif(F.regexp_extract(low, r"([0-9]+(?::[0-9]+)+)", 1), F.lit(""))
    return F.struct(ratio.alias("ratio"), F.regexp_extract(low, r"block\s+size\s+(?:of\s+)?([0-9]+)", 1).try_cast("int").alias("block_size"))


def time_window(text: Column) -> Column:
    """An ISO duration from 'within N units'; null without one."""
    low = F.lower(text)
    n, unit = F.regexp_extract(low, r"within\s+([0-9]+)\s+(?:minute|hour|day|week)", 1), F.regexp_extract(low, r"within\s+[0-9]+\s+(minute|hour|day|week)", 1)
    return F.when(unit == "minute", F.concat(F.lit("PT"), n, F.lit("M"))).when(unit == "hour", F.concat(F.lit("PT"), n, F.lit("H"))).when(unit == "day", F.concat(F.lit("P"), n, F.lit("D"))).when(unit == "week", F.concat(F.lit("P"), n, F.lit("W")))


def sampling_minutes(text: Column) -> Column:
    """The sampling times of 'at 0, 30, 60 and 120 minutes', as an array of whole numbers."""
    listed = F.regexp_extract(F.lower(text), r"at\s+((?:[0-9]+(?:,\s*|\s+and\s+))*[0-9]+)\s+minutes", 1)
    return F.transform(F.regexp_extract_all(listed, F.lit("([0-9]+)"), 1), lambda x: x.cast("int"))


def titration(text: Column) -> Column:
    """array<double> of the dose levels of '10 mg to 20 mg to 40 mg'; empty where fewer than two."""
    levels = F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"([0-9]+(?:\.[0-9]+)?)\s*mg"), 1), lambda x: x.cast("double"))
    return F.when(F.lower(text).rlike("titrat|escalat|increase") & (F.size(levels) > 1), levels).otherwise(F.array().cast("array<double>"))


def is_crossover(text: Column) -> Column:
    """Whether a text tells of a crossover: one of its signs, and fewer than two of a titration or a single arm."""
    low = F.lower(text)
    against = sum((F.when(low.rlike(p), 1).otherwise(0) for p in R.NOT_CROSSOVER), F.lit(0))
    return reduce(lambda a, b: a | b, [low.rlike(p) for p, _, _ in R.CROSSOVER]) & (against < 2)


def crossovers(df: DataFrame, text: str, id_: Sequence[str]) -> DataFrame:
    """The crossover design of each text that tells of one: confidence and source (of its surest sign), periods (2, unless
    more are numbered), sequences (told, else all orders of two or three periods), washout (ISO duration, null where none is told),
    washout_required and carryover (whether it is to be prevented). Null is the empty text."""
    low = F.col("_low")
    signs = F.array(*[F.struct(F.lit(c).alias("confidence"), F.lit(-i).alias("at"), F.regexp_extract(low, f"({p})", 1).alias("source")) for i, (p, _, c) in enumerate(R.CROSSOVER)])
    rows = lowered(df, text, id_).filter(is_crossover(low)).withColumn("_s", F.array_max(F.filter(signs, lambda x: x["source"] != "")))
    numbered = F.array_max(F.transform(F.regexp_extract_all(low, F.lit(r"period\s+(\d+)"), 1), lambda x: x.try_cast("long")))
    ways = F.regexp_extract(low, r"(\d+)[\-\s]?(?:period|way)\s+crossover", 1).try_cast("long")
    rows = rows.withColumn("periods", F.greatest(F.coalesce(ways, F.lit(2)), F.coalesce(numbered, F.lit(0))))
    told = F.transform(all_of(low, R.SEQUENCES), lambda x: F.upper(x))
    inferred = F.when(F.col("periods") == 2, F.array(F.lit("AB"), F.lit("BA"))).when(F.col("periods") == 3, F.array(*map(F.lit, ("ABC", "ACB", "BAC", "BCA", "CAB", "CBA")))).otherwise(F.array().cast("array<string>"))
    unit = [F.when(low.rlike(p), F.concat(F.lit("P"), F.regexp_extract(low, p, 1), F.when(F.contains(F.regexp_extract(low, p, 0), F.lit("week")), "W").otherwise("D"))) for p in R.WASHOUTS]
    return rows.select(
        *id_, "_s.confidence", "_s.source", "periods", F.when(F.size(told) > 0, told).otherwise(inferred).alias("sequences"), F.coalesce(*unit).alias("washout"), F.coalesce(*unit).isNotNull().alias("washout_required"),
        low.rlike(r"(?:prevent|minimize|avoid|reduce)\s+(?:potential\s+)?carry[\-\s]?over").alias("carryover"),
    )


def traversals(df: DataFrame, text: str, id_: Sequence[str]) -> DataFrame:
    """How subjects go through a study by each text: epochs in order (four standard ones where none is named; END_OF_STUDY
    last), mandatory visits (Screening first, End of Study always), early_exit (whether it is allowed) and exit_procedures."""
    low = F.col("_low")
    named = F.array_compact(F.array(*[F.when(low.rlike(p), F.lit(e)) for e, p in R.EPOCHS]))
    epochs = F.when(F.size(named) == 0, F.array(*map(F.lit, R.DEFAULT_EPOCHS))).otherwise(F.concat(F.array_remove(named, "END_OF_STUDY"), F.array(F.lit("END_OF_STUDY"))))
    visits = F.array_compact(F.array(F.lit("Screening"), *[F.when(low.rlike(p), F.lit(v)) for p, v in R.MANDATORY_VISITS], F.lit("End of Study")))
    early = reduce(lambda a, b: a | b, [low.rlike(p) for p in R.EARLY_EXITS])
    exits = F.array_compact(F.array(*[F.when(low.rlike(p), F.lit(v)) for p, v in R.EXIT_PROCEDURES]))
    return lowered(df, text, id_).select(*id_, epochs.alias("epochs"), F.array_distinct(visits).alias("mandatory"), early.alias("early_exit"), exits.alias("exit_procedures"))


def sections(df: DataFrame, text: str, id_: Sequence[str], mark: str) -> DataFrame:
    """(id, section_no, section) of each text, cut before every match of mark; from 1. Sections of fewer than 30 characters
    are left out but counted."""
    cut = F.split(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), f"({mark})", "\u0001$1"), "\u0001")
    rows = df.select(*id_, F.posexplode(cut).alias("_at", "section"))
    return rows.filter(F.length(stripped(F.col("section"))) >= 30).select(*id_, (F.col("_at") + 1).alias("section_no"), "section")


ENDPOINT_MARK = r"(?i)(?:primary|secondary|exploratory|safety)\s+(?:efficacy\s+)?(?:endpoint|objective)"
VARIABLE_MARK = r"\n(?:\d+\.\d+|•|-)\s+"


def endpoints(df: DataFrame, text: str, id_: Sequence[str]) -> DataFrame:
    """The endpoints of each text, one for each section that begins at a type of endpoint or objective (and one for what is before):
    section_no, kind, confidence, name (up to the first period, at most 100 characters, else the kind and number), inputs
    (known names and what is to be measured, sorted), time_reference, duration (ISO), algorithm and success (null where
    not told)."""
    rows = sections(df, text, id_, ENDPOINT_MARK).withColumn("_low", F.lower("section"))
    low = F.col("_low")
    kind = kind_of(low, R.ENDPOINT_TYPES, "Exploratory")
    sure = F.coalesce(*[F.when(low.rlike(p), F.lit(c)) for p, _, c in R.ENDPOINT_TYPES], F.lit(0.5))
    name = F.substring(first_of(F.col("section"), [ENDPOINT_MARK + r"[:\s]*([^.]+)"]), 1, 100)
    known = F.filter(F.array(*map(F.lit, R.ENDPOINT_INPUTS)), lambda x: F.contains(low, F.lower(x)))
    inputs = F.array_sort(F.array_distinct(F.concat(known, F.regexp_extract_all(low, F.lit(r"(?:measure|assess|evaluate|determine)\s+(?:the\s+)?(\w+(?:\s+\w+)?)"), 1))))
    change = F.when(F.contains(low, F.lit("change from baseline")), F.nullif(F.regexp_extract(low, r"change\s+from\s+baseline\s+(?:in\s+)?(\w+)", 1), F.lit("")))
    threshold = r"(>=?|≥|<=?|≤)\s*(\d+(?:\.\d+)?)\s*(\S+)?"
    section = F.col("section")
    above = F.when(section.rlike(threshold), F.concat(F.lit("value "), F.replace(F.replace(F.regexp_extract(section, threshold, 1), F.lit("≥"), F.lit(">=")), F.lit("≤"), F.lit("<=")), F.lit(" "), F.regexp_extract(section, threshold, 2), F.regexp_extract(section, threshold, 3)))
    better = F.when(F.contains(low, F.lit("respon")) & low.rlike("responder|response"), F.nullif(F.regexp_extract(low, r"(\d+)%?\s+(?:or\s+more\s+)?(?:reduction|improvement|decrease)", 1), F.lit("")))
    parts = F.concat_ws(" AND ", F.concat(change, F.lit("_postbaseline - "), change, F.lit("_baseline")), above, F.concat(F.lit("improvement >= "), better, F.lit("%")))
    return rows.select(
        *id_, "section_no", kind.alias("kind"), sure.alias("confidence"), F.coalesce(name, F.concat(kind, F.lit(" Endpoint "), "section_no")).alias("name"), inputs.alias("inputs"), first_of(low, R.TIME_REFERENCES).alias("time_reference"),
        time_window(low).alias("duration"), F.coalesce(first_of(low, R.ENDPOINT_FORMULAS), F.nullif(parts, F.lit(""))).alias("algorithm"), first_of(low, R.SUCCESS).alias("success"),
    )


def derived_variables(df: DataFrame, text: str, id_: Sequence[str]) -> DataFrame:
    """The derived variables of each text, one for each numbered or listed section that has a word of them: section_no, kind, confidence, name
    (at most 80 characters, else its number), sources (known measurements and what it is based on or uses, sorted),
    baseline, baseline_visit, derivation, analysis_window and imputation (null where not told)."""
    rows = sections(df, text, id_, VARIABLE_MARK).withColumn("_low", F.lower("section"))
    low = F.col("_low")
    rows = rows.filter(reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in R.VARIABLE_WORDS]))
    kind = kind_of(low, R.VARIABLE_TYPES, "Custom")
    sure = F.coalesce(*[F.when(low.rlike(p), F.lit(c)) for p, _, c in R.VARIABLE_TYPES], F.lit(0.5))
    name = F.substring(first_of(F.col("section"), [f"(?i){p}" for p in R.VARIABLE_NAMES]), 1, 80)
    known = F.filter(F.array(*map(F.lit, R.MEASUREMENTS)), lambda x: F.contains(low, F.lower(x)))
    sources = F.array_sort(F.array_distinct(F.concat(known, all_of(low, [r"based\s+on\s+(?:the\s+)?(\w+(?:\s+\w+)?)", r"using\s+(?:the\s+)?(\w+(?:\s+\w+)?)"]))))
    by_kind = F.coalesce(*[F.when(kind == k, F.lit(d)) for k, d in R.DERIVATION_OF_TYPE.items()])
    return rows.select(
        *id_, "section_no", kind.alias("kind"), sure.alias("confidence"), F.coalesce(name, F.concat(F.lit("Derived Variable "), "section_no")).alias("name"), sources.alias("sources"), first_of(low, R.BASELINES).alias("baseline"),
        first_of(low, R.BASELINE_VISITS).alias("baseline_visit"), F.coalesce(first_of(low, R.DERIVATIONS), by_kind).alias("derivation"), first_of(low, R.ANALYSIS_WINDOWS).alias("analysis_window"),
        F.coalesce(*[F.when(low.rlike(p), F.lit(m)) for p, m in R.IMPUTATIONS]).alias("imputation"),
    )

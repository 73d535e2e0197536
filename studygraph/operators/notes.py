"""Footnotes of a text in five layouts, with the condition that each states.

Every layout is one pattern over the text; a note runs to the next mark of its layout or to the end of its paragraph. All of
it is column expressions over one row, so no text moves. White space is that of ASCII."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studygraph.functions.text import first_rule
from studygraph.operators.nested import bound

# The kinds of conditions, in the order in which they are tried.
TIMING = (
    (r"(\d+)\s*(?:min(?:ute)?s?|hours?)\s+(?:before|prior\s+to)\s+(.+)", "timing_before", 0.90),
    (r"(?:before|prior\s+to)\s+(.+)", "timing_before", 0.80),
    (r"(\d+)\s*(?:min(?:ute)?s?|hours?)\s+(?:after|following)\s+(.+)", "timing_after", 0.90),
    (r"(?:after|following)\s+(.+)", "timing_after", 0.80),
    (r"(?:at|on)\s+(?:day|week)\s+(\d+)", "timing_at", 0.85),
    (r"(?:at|during)\s+(?:each|every)\s+(?:visit|timepoint)", "timing_recurring", 0.85),
    # one character on either side is enough: .+ would be tried from every place of the note to its end
    (r".\s+(?:then|followed\s+by)\s+.", "sequence", 0.85),
    (r".\s+(?:before|prior\s+to)\s+.+\s+(?:before|prior\s+to)\s+.", "sequence", 0.90),
)
ELIGIBILITY = (
    (r"(?:only\s+)?(?:for|in)\s+(?:women|female)\s+(?:of\s+)?(?:childbearing|reproductive)\s+(?:potential|age)", "eligibility_wocbp", 0.95),
    (r"(?:only\s+)?(?:for|in)\s+(?:patients?|subjects?)\s+(?:with|who\s+have)\s+(.+)", "eligibility_condition", 0.85),
    (r"(?:if|when)\s+(?:applicable|indicated|required)", "eligibility_conditional", 0.80),
    (r"(?:only\s+)?(?:for|in)\s+(?:patients?|subjects?)\s+(?:age[d]?\s+)?(\d+)\s*(?:years?|and\s+older)", "eligibility_age", 0.85),
    (r"(?:exclude[d]?\s+)?(?:for|in)\s+(?:patients?|subjects?)\s+(?:with|taking)\s+(.+)", "eligibility_exclusion", 0.85),
)
PROCEDURES = (
    (r"(?:performed|collected|measured)\s+(?:in\s+)?(?:triplicate|duplicate)", "procedure_replicate", 0.90),
    (r"(?:triplicate|duplicate)\s+(?:measurements?|readings?|samples?)", "procedure_replicate", 0.90),
    (r"(?:at|on|during)\s+(?:weeks?|days?|visits?)\s+([\d,\s]+(?:and\s+\d+)?)", "procedure_timepoints", 0.85),
    (r"(?:if|when)\s+(?:clinically\s+)?(?:indicated|necessary|required)", "procedure_conditional", 0.85),
    (r"(?:as\s+)?(?:clinically\s+)?indicated", "procedure_conditional", 0.80),
    (r"(?:fasting|after\s+(?:\d+[\-\s]?hour)?\s*fast)", "procedure_fasting", 0.90),
)
FREQUENCIES = (
    (r"(?:daily|once\s+daily|every\s+day)", "frequency_daily", 0.90),
    (r"(?:weekly|once\s+(?:a|per)\s+week)", "frequency_weekly", 0.90),
    (r"(?:twice|two\s+times?)\s+(?:daily|per\s+day)", "frequency_bid", 0.90),
    (r"(?:during|throughout)\s+(?:the\s+)?(?:treatment|study|dosing)\s+(?:period|phase)", "frequency_continuous", 0.85),
)
# How texts begin that are no notes, and words of which a short note has one.
NOISE = ("page ", "table ", "figure ", "section ", "chapter ", "version ", "protocol ", "confidential", "proprietary", "amendment", "revision", "date:", "sponsor:")
RELEVANT = (
    "visit", "day", "week", "hour", "minute", "before", "after", "if", "when", "only", "must", "should", "may", "can", "patient", "subject", "sample", "blood", "urine", "fasting", "female", "male", "women", "men",
    "childbearing", "triplicate", "duplicate", "repeat", "collect", "assess", "perform", "measure", "record", "document", "applicable", "indicated", "required", "optional",
)
# The characters that raise a mark, and the layouts.
RAISED = r"[\^ᵃᵇᶜᵈᵉᶠᵍʰⁱʲᵏˡᵐⁿᵒᵖʳˢᵗᵘᵛʷˣʸᶻ]"
#: The same characters; all others are mostly told by a few ranges, as single ones beyond Latin-1 are tried one by one.
RAISED_FAST = rf"[\^ʰ-ˣᵃ-ᶻⁱⁿ&&{RAISED}]"
LAYOUTS = (
    # all of a note; its mark and its text within it; what the mark is called
    (r"(?dms)^[a-z][.)]\s+.+?(?=^[a-z][.)]|\z)", r"(?ds)^([a-z])[.)]\s+(.+)$", "{}"),
    (r"(?is)\[[a-z\d]+\]\s*[:.]?\s*.+?(?=\[[a-z\d]+\]|\n\n|\z)", r"(?is)^\[([a-z\d]+)\]\s*[:.]?\s*(.+)$", "[{}]"),
    (rf"(?is){RAISED}[a-z]\s*[:.]?\s*.+?(?={RAISED}[a-z]|\n\n|\z)", rf"(?is)^{RAISED}([a-z])\s*[:.]?\s*(.+)$", "^{}"),
    (r"(?dms)(?:^|\n)\d{1,2}[.)]\s+[A-Z].+?(?=(?:^|\n)\d{1,2}[.)]|\n\n|\z)", r"(?ds)^\n?(\d{1,2})[.)]\s+([A-Z].+)$", "{}"),
)
SECTIONS = (
    r"(?dims)(?:footnotes?|notes?\s+to\s+table|table\s+notes?)\s*[:\-]?\s*\n(.+?)(?=\n\n\n|\z|(?:^[A-Z][A-Z\s]+:))",
    r"(?dims)(?:abbreviations?.*?:?\s*\n)?([a-z]\.\s+.+?)(?=\n\n\n|\z)",
)
SHORTEST, LONGEST = 15, 800


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(" \t\n\x0b\f\r"))


def _flat(text: Column) -> Column:
    return F.regexp_replace(stripped(text), r"\s+", " ")


def _fits(text: Column) -> Column:
    return (F.length(text) > SHORTEST) & (F.length(text) < LONGEST)


def _none() -> Column:
    return F.array().cast("array<struct<marker: string, note: string>>")


def footnotes(text: Column) -> Column:
    """array<struct<marker, note>> of a text: notes behind a letter at the start of a line, a mark in brackets, a raised
    letter, a number at the start of a line, and those of a section of notes, in this order; a note that two layouts find
    comes twice. Of a section, parts without a letter are called fn_ and their number. Notes have more than 15 and fewer
    than 800 characters. Null gives an empty array."""
    out = []
    for pattern, inside, name in LAYOUTS:
        matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        if RAISED in pattern:  # slow to look for, and rare
            matches = F.when(text.rlike(RAISED_FAST), matches)
        found = F.transform(matches, lambda m: F.struct(F.format_string(name.replace("{}", "%s"), F.regexp_extract(m, inside, 1)).alias("marker"), _flat(F.regexp_extract(m, inside, 2)).alias("note")))
        out.append(F.filter(found, lambda x: _fits(x["note"])))
    out[3] = F.filter(out[3], lambda x: ~x["note"].rlike("^(?:Table|Figure|Section)"))
    all_ = F.concat(*(F.coalesce(x, _none()) for x in out))
    for pattern in SECTIONS:
        parts = F.filter(F.transform(F.split(F.regexp_extract(text, pattern, 1), r"\n(?=[a-z][.)])"), stripped), _fits)
        told = F.filter(F.transform(parts, lambda p: F.struct(F.nullif(F.regexp_extract(p, r"^([a-z])[.)]\s*", 1), F.lit("")).alias("marker"), F.regexp_replace(F.regexp_replace(p, r"^[a-z][.)]\s*", ""), r"\s+", " ").alias("note"))), lambda x: x["note"] != "")
        numbered = lambda before: F.transform(told, lambda x, i: F.struct(F.coalesce(x["marker"], F.concat(F.lit("fn_"), F.size(before) + i + 1)).alias("marker"), x["note"].alias("note")))
        all_ = bound(all_, lambda before: F.concat(before, F.coalesce(numbered(before), _none())))
    return all_


def is_note(note: Column) -> Column:
    """Whether a text can be a note's: no heading in capitals, no page or table line, no row of numbers, and either longer
    than 50 characters or with a word that notes have."""
    low = F.lower(F.trim(note))
    heading = (F.upper(note) == note) & (F.lower(note) != note) & (F.length(note) > 20)
    digits = F.length(F.regexp_replace(note, r"[^0-9]", ""))
    noise = low.rlike("^(?:" + "|".join(NOISE) + ")")
    return (F.length(low) >= SHORTEST) & ~heading & ~noise & (digits <= F.length(note) * 0.5) & ((F.length(note) > 50) | low.rlike("|".join(RELEVANT)))


def distinct(notes: Column) -> Column:
    """An array of struct<marker, note> without those whose words, without marks, are part of an earlier one's that stays,
    hold it, or share more than four fifths with it. Earlier ones stay; each note is held against those that stay."""
    plain = lambda n: F.regexp_replace(F.regexp_replace(F.lower(F.trim(n)), r"\s+", " "), r"(?U)[^\w\s]", "")
    ready = F.transform(notes, lambda x: F.struct(x["marker"].alias("marker"), x["note"].alias("note"), plain(x["note"]).alias("plain"), F.array_distinct(F.filter(F.split(plain(x["note"]), " "), lambda w: w != "")).alias("words")))
    shared = lambda x, y: F.size(F.array_intersect(x["words"], y["words"])) > F.size(F.array_union(x["words"], y["words"])) * 0.8
    alike = lambda x, y: F.contains(y["plain"], x["plain"]) | F.contains(x["plain"], y["plain"]) | shared(x, y)
    with_next = lambda kept, x: F.when(F.exists(kept, lambda y: alike(x, y)), kept).otherwise(F.concat(kept, F.array(x)))
    return bound(ready, lambda all_: F.aggregate(all_, F.filter(all_, lambda _: F.lit(False)), with_next))


def condition(note: Column) -> Column:
    """struct<kind, confidence, timing, structured> of a note: the first kind of which a pattern matches, "general" at 0.5
    where none does; a duration (timing kinds only) and an expression where the note states one, else null."""
    rules = [*TIMING, *ELIGIBILITY, *PROCEDURES, *FREQUENCIES]
    told = lambda low: F.struct(low.alias("low"), first_rule(low, [(p, f"{sure} {k}") for p, k, sure in rules], "0.5 general", regex=True).alias("rule"))
    return bound(bound(F.lower(note), told), _condition)


def _condition(told: Column) -> Column:
    """The condition of a note in lower case, of which the first rule that matches is known."""
    low, confidence, kind = told["low"], F.substring_index(told["rule"], " ", 1).cast("double"), F.substring_index(told["rule"], " ", -1)
    number = F.regexp_extract(low, r"(\d+)\s*(?:min(?:ute)?s?|hours?)", 1)
    timed = F.startswith(kind, F.lit("timing")) | (kind == "sequence")
    timing = F.when(timed & (number != ""), F.concat(F.lit("PT"), number, F.when(F.contains(low, F.lit("hour")), "H").otherwise("M")))

    def around(word: str, words: str) -> Column:
        pattern = rf"(\d+)\s*(?:min(?:ute)?s?|hours?)\s+(?:{words})\s+(.+)"
        return F.when(F.startswith(kind, F.lit("timing")) & low.rlike(pattern), F.concat(F.lit(f"timing.{word}("), stripped(F.regexp_extract(low, pattern, 2)), F.lit(", PT"), F.regexp_extract(low, pattern, 1), F.lit("M)")))

    eligible, age = F.startswith(kind, F.lit("eligibility")), F.regexp_extract(low, r"(?:age[d]?\s+)?(\d+)\s*(?:years?|and\s+older)", 1)
    hours = F.regexp_extract(low, r"(\d+)[\-\s]?hour\s*fast", 1)
    structured = F.coalesce(
        around("before", r"before|prior\s+to"), around("after", "after|following"),
        F.when(eligible & low.rlike("childbearing|reproductive"), "subject.sex == 'Female' AND subject.isOfChildbearingPotential == true"), F.when(eligible & (age != ""), F.concat(F.lit("subject.age >= "), age)),
        F.when((kind == "procedure_replicate") & F.contains(low, F.lit("triplicate")), "procedure.replicates = 3"), F.when((kind == "procedure_replicate") & F.contains(low, F.lit("duplicate")), "procedure.replicates = 2"),
        F.when((kind == "procedure_fasting") & (hours != ""), F.concat(F.lit("subject.fastingHours >= "), hours)), F.when(kind == "procedure_fasting", "subject.isFasting == true"),
    )
    return F.struct(kind.alias("kind"), confidence.alias("confidence"), timing.alias("timing"), structured.alias("structured"))


def footnote_conditions(rows: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys, nth, marker, note, kind, confidence, timing, structured) of each note of each row's text that stays: notes as
    footnotes() finds them, without what is_note() rejects and without near copies within a row. nth counts from 1. Rows
    without notes, or with null, give none; rows that repeat a key are taken one by one."""
    kept = distinct(F.filter(footnotes(F.col(text)), lambda x: is_note(x["note"])))
    found = rows.select(*keys, F.posexplode(kept).alias("_pos", "_note")).select(*keys, (F.col("_pos") + 1).alias("nth"), F.col("_note.marker").alias("marker"), F.col("_note.note").alias("note"))
    return found.withColumn("_c", condition(F.col("note"))).select(*keys, "nth", "marker", "note", "_c.*")

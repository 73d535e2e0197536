"""Scalar text functions as column expressions: names, footnotes, study days, durations, windows and doses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Superscript characters and the plain characters they stand for.
SUPERSCRIPTS = "⁰¹²³⁴⁵⁶⁷⁸⁹ᵃᵇᶜᵈᵉᶠᵍʰⁱʲᵏˡᵐⁿᵒᵖʳˢᵗᵘᵛʷˣʸᶻ"
PLAIN = "0123456789abcdefghijklmnoprstuvwxyz"

# Days allowed before and after a visit, by words of its name, in order of precedence.
DEFAULT_WINDOWS = (
    ("screening", 7, 0),
    ("baseline", 1, 1),
    ("day 1", 0, 0),
    ("randomization", 0, 0),
    ("follow-up", 7, 7),
    ("end of study", 3, 7),
    ("end of treatment", 3, 3),
    ("early termination", 0, 0),
)

#: Patterns of a symmetric window, tried in order, and that of one with two sides.
SYMMETRIC = (r"±\s*(\d+)\s*day", r"\+\s*/?\s*-\s*(\d+)\s*day", r"within\s*(\d+)\s*day", r"window\s*(?:of|:)?\s*(\d+)\s*day", r"(\d+)[- ]?day\s+window")
TWO_SIDED = r"[-−]\s*(\d+)\s*(?:days?)?\s*(?:to|through|and)\s*\+?\s*(\d+)\s*day"


def normalize_name(name: Column) -> Column:
    """Lower case, only a-z, 0-9, white space and hyphens, single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(name), r"[^a-z0-9\s\-]", ""), r"\s+", " "))


def clean_name(name: Column) -> Column:
    """The name without a one-letter footnote mark at its end: ' a', ' a.', '(a)' or '[a]'."""
    out = F.trim(name)
    for pattern in (r"(?i)\s+[a-z]$", r"(?i)\s+[a-z]\.$", r"(?i)\s*\([a-z]\)$", r"(?i)\s*\[[a-z]\]$"):
        out = F.regexp_replace(out, pattern, "")
    return F.trim(out)


def footnote_refs(name: Column) -> Column:
    """The one-letter footnote marks at a name's end, as an array."""
    plain = F.nullif(F.regexp_extract(name, r"\s+([a-z])\.?$", 1), F.lit(""))
    bracketed = F.nullif(F.regexp_extract(name, r"\(([a-z])\)$", 1), F.lit(""))
    return F.array_compact(F.array(plain, bracketed))


def superscript_refs(name: Column) -> Column:
    """The superscript characters of a name as plain characters, in order."""
    kept = F.regexp_replace(name, f"[^{SUPERSCRIPTS}]", "")
    return F.translate(kept, SUPERSCRIPTS, PLAIN)


def strip_superscripts(name: Column) -> Column:
    return F.trim(F.translate(name, SUPERSCRIPTS, ""))


def number_after(text: Column, word: str) -> Column:
    """The first whole number after a word, with its sign, as in 'Day -7'; null without one."""
    return F.regexp_extract(F.translate(F.lower(text), "−–—", "---"), rf"(?:^|[^a-z]){word}\s*(-?[0-9]+)", 1).try_cast("int")


def study_day(text: Column) -> Column:
    """The day of a visit's name: its day; else that of its week, (week - 1) * 7 + 1; else that of a special visit."""
    low = F.lower(text)
    special = F.when(F.contains(low, F.lit("screening")), -14).when(F.contains(low, F.lit("baseline")), 0).when(F.contains(low, F.lit("randomization")), 1).when(F.contains(low, F.lit("follow-up")), 365)
    return F.coalesce(number_after(text, "day"), (number_after(text, "week") - 1) * 7 + 1, special)


def visit_window(name: Column, text: Column) -> Column:
    """struct(before, after) in days, from a text, or by the visit's name where the text gives none (or 0 for both)."""
    low = F.lower(F.coalesce(text, F.lit("")))
    found = [F.regexp_extract(low, p, 1).try_cast("int") for p in SYMMETRIC]
    before = F.coalesce(F.regexp_extract(low, TWO_SIDED, 1).try_cast("int"), *found, F.lit(0))
    after = F.coalesce(F.regexp_extract(low, TWO_SIDED, 2).try_cast("int"), *found, F.lit(0))
    none = (before == 0) & (after == 0)

    def default(at: int) -> Column:
        out = F.when(F.lit(False), 0)
        for row in DEFAULT_WINDOWS:
            out = out.when(F.contains(F.lower(name), F.lit(row[0])), row[at])
        return out.otherwise(3)

    return F.struct(F.when(none, default(1)).otherwise(before).alias("before"), F.when(none, default(2)).otherwise(after).alias("after"))


def window_label(day: Column, before: Column, after: Column) -> Column:
    """As in 'Day 8 (−1/+2)'."""
    return F.concat(F.lit("Day "), day.cast("string"), F.lit(" (−"), before.cast("string"), F.lit("/+"), after.cast("string"), F.lit(")"))


def iso_duration(value: Column, unit: Column) -> Column:
    """An ISO 8601 duration of a signed whole number of minutes, hours, days, weeks, months or years; else null."""
    size = F.abs(value).cast("string")
    low = F.regexp_replace(F.lower(F.trim(unit)), "s$", "")
    body = (
        F.when(low == "minute", F.concat(F.lit("PT"), size, F.lit("M"))).when(low == "hour", F.concat(F.lit("PT"), size, F.lit("H")))
        .when(low == "day", F.concat(F.lit("P"), size, F.lit("D"))).when(low == "week", F.concat(F.lit("P"), size, F.lit("W")))
        .when(low == "month", F.concat(F.lit("P"), size, F.lit("M"))).when(low == "year", F.concat(F.lit("P"), size, F.lit("Y")))
    )
    return F.when(value < 0, F.concat(F.lit("-"), body)).otherwise(body)


def duration_days(iso: Column) -> Column:
    """Signed days of 'P7D', '-P2W', 'PT36H'; null for what is none of these."""
    sign = F.when(F.startswith(iso, F.lit("-")), -1).otherwise(1)

    def part(pattern: str) -> Column:
        return F.regexp_extract(iso, pattern, 1).try_cast("double")

    return sign * F.coalesce(part(r"^-?P([0-9]+)D$"), part(r"^-?P([0-9]+)W$") * 7, part(r"^-?PT([0-9]+)H$") / 24, part(r"^-?PT([0-9]+)M$") / 1440)


def dose(text: Column) -> Column:
    """struct(low, high, unit) of the first dose in a text, as in '5 mg' or '10-20 mg'; null without one."""
    pattern = r"([0-9]+(?:\.[0-9]+)?)(?:\s*(?:-|to)\s*([0-9]+(?:\.[0-9]+)?))?\s*(mg|mcg|ml|iu|units|g)(?:[^a-z]|$)"
    low = F.lower(text)
    first = F.regexp_extract(low, pattern, 1).try_cast("double")
    high = F.coalesce(F.regexp_extract(low, pattern, 2).try_cast("double"), first)
    return F.when(first.isNotNull(), F.struct(first.alias("low"), high.alias("high"), F.regexp_extract(low, pattern, 3).alias("unit")))


def first_rule(text: Column, rules: Sequence[tuple[str, str]], default: str, regex: bool = False) -> Column:
    """The value of the first rule (word or pattern, value) that text satisfies, in the rules' order; else the default."""
    out = F.when(F.lit(False), F.lit(""))
    for what, value in rules:
        out = out.when(text.rlike(what) if regex else F.contains(text, F.lit(what)), F.lit(value))
    return out.otherwise(F.lit(default))


def stable_id(*parts: Column) -> Column:
    """A UUID-shaped id that depends on its parts alone."""
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))


def needs_id(id_: Column) -> Column:
    """Whether a simple id is to be replaced: no UUID yet, shorter than 50, and with _ or -."""
    uuid = id_.rlike("^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$")
    return (F.contains(id_, F.lit("_")) | F.contains(id_, F.lit("-"))) & (F.length(id_) < 50) & ~uuid


def repaired_json(response: Column, schema: str) -> Column:
    """The JSON object of a model's answer: fences and prose around it are dropped; trailing commas are, where it does not
    parse as it is. Null where nothing parses."""
    body = F.regexp_extract(response, r"(?s)(\{.*\})", 1)
    tidy = F.regexp_replace(body, r",\s*([}\]])", "$1")
    single = F.regexp_replace(tidy, "'", '"')
    return F.from_json(F.when(F.try_parse_json(body).isNotNull(), body).when(F.try_parse_json(tidy).isNotNull(), tidy).when(F.try_parse_json(single).isNotNull(), single), schema)


def continued_json(base: Column, more: Column) -> Column:
    """A truncated answer with its continuation: fences around the continuation go, what it repeats of the end (in steps
    of ten characters, at most 100) is written once, and a comma is put between a value and a new object. Nulls count as
    empty."""
    b = F.rtrim(F.coalesce(base, F.lit("")))
    m = F.ltrim(F.coalesce(more, F.lit("")))
    m = F.when(F.startswith(m, F.lit("```")), F.regexp_replace(F.regexp_replace(m, r"^[^\n]*\n?", ""), r"\s*```\s*$", "")).otherwise(m)
    most = F.least(F.lit(100), F.length(b), F.length(m))
    lengths = F.when(most > 10, F.filter(F.sequence(most, F.least(most, F.lit(11)), F.lit(-10)), lambda n: (n > 10) & F.endswith(b, F.left(m, n)))).otherwise(F.array().cast("array<int>"))
    last, first = F.right(b, F.lit(1)), F.left(m, F.lit(1))
    comma = last.rlike('["}0-9]') & (first == "{")
    return F.when(first.isin("}", "]"), F.concat(b, m)).when(F.size(lengths) > 0, F.concat(b, F.substr(m, F.element_at(lengths, 1) + 1))).when(comma, F.concat(b, F.lit(",\n"), m)).otherwise(F.concat(b, m))


def response_fault(response: Column, least: int = 1) -> Column:
    """What is wrong with the shape of an answer, a JSON object with an array of activities that have an id and a name; null
    where nothing is. No object at all counts as one without activities."""
    top = F.coalesce(F.from_json(response, "map<string,string>"), F.create_map().cast("map<string,string>"))
    raw = F.try_element_at(top, F.lit("activities"))
    items = F.from_json(raw, "array<string>")
    parsed = F.transform(items, lambda x: F.from_json(x, "map<string,string>"))
    wrong = F.filter(F.transform(parsed, lambda x, i: F.when(x.isNull() | ~F.startswith(F.ltrim(items[i]), F.lit("{")), F.concat(F.lit("Activity "), i, F.lit(" is not an object"))).when(~F.map_contains_key(x, "id"), F.concat(F.lit("Activity "), i, F.lit(" missing 'id'"))).when(~F.map_contains_key(x, "name"), F.concat(F.lit("Activity "), i, F.lit(" missing 'name'")))), lambda f: f.isNotNull())
    nested = F.map_contains_key(top, "study") | F.map_contains_key(top, "studyDesigns") | F.map_contains_key(top, "activityGroups")
    few = F.concat(F.lit(f"Expected at least {least} activities, got "), F.size(items))
    return (
        F.when(~F.map_contains_key(top, "activities") & nested, F.lit("Response has wrong structure")).when(~F.map_contains_key(top, "activities"), F.lit("Missing 'activities' key in response"))
        .when(raw.isNull() | ~F.startswith(F.ltrim(raw), F.lit("[")), F.lit("'activities' must be an array")).when(F.size(items) < least, few).when(F.size(wrong) > 0, F.element_at(wrong, 1))
    )


def canonical_json(value: Column) -> Column:
    """JSON text in one form, keys in order and without spaces, so that equal values are equal texts; null where it does
    not parse."""
    return F.to_json(F.try_parse_json(value))

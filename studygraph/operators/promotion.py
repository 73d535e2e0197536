"""Promotion of what extractors found into the design of a study: ten ordered steps over one row for each study.

A row holds the design (activities, encounters, epochs, timings, ...) and the findings (anchors, repetitions, ...) as arrays.
Each step reads what the steps before made: ids that one mints are keys for the next, and `mapping` carries which finding
became what. All of it is column expressions over the row, so studies are promoted where they lie, without a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studygraph.registry import cut

DESIGN = {
    "activities": "array<struct<id: string, name: string, label: string>>",
    "epochs": "array<struct<id: string, name: string, previous_id: string, next_id: string>>",
    "encounters": "array<struct<id: string, name: string, label: string, epoch_id: string, timing_id: string, previous_id: string, next_id: string, start_rule: string, end_rule: string>>",
    "instances": "array<struct<id: string, name: string, kind: string, activity_id: string, encounter_id: string, epoch_id: string, day: long, place: int, source: string, target_id: string>>",
    "timings": "array<struct<id: string, name: string, from_instance_id: string, value: string, window_lower: string, window_upper: string, window_label: string>>",
    "interventions": "array<struct<id: string, name: string, administration_ids: array<string>>>",
    "endpoints": "array<struct<id: string, name: string>>",
    "estimands": "array<struct<id: string, name: string, endpoint_id: string, algorithm: string>>",
    "administrations": "array<struct<id: string, name: string, description: string, dose: double, unit: string, route_code: string, route: string>>",
    "conditions": "array<struct<id: string, name: string, text: string, applies_to: array<string>>>",
    "elements": "array<struct<id: string, name: string, description: string, previous_id: string, start_rule: string>>",
    "conceptual": "array<struct<id: string, name: string, class: string>>",
}
FINDINGS = {
    "anchors": "array<struct<id: string, name: string, class: string, day: long, place: int, activity_id: string>>",
    "repetitions": "array<struct<id: string, kind: string, activity: string, start_day: long, end_day: long, every: long>>",
    "regimens": "array<struct<id: string, treatment: string, dose: string, route: string, frequency: string>>",
    "visit_windows": "array<struct<visit: string, day: long, before: long, after: long>>",
    "traversals": "array<array<string>>",
    "footnotes": "array<struct<id: string, kind: string, text: string, applies_to: array<string>>>",
    "transitions": "array<struct<from_state: string, to_state: string, trigger: string, guard: string>>",
    "algorithms": "array<struct<name: string, algorithm: string>>",
    "titrations": "array<struct<id: string, name: string, levels: array<struct<dose: string, duration: string, criteria: string>>>>",
}
TRACES = {"mapping": "array<struct<kind: string, source_id: string, target_id: string>>", "issues": "array<struct<category: string, about: string, told: string>>"}
#: The arrays of a study, as a schema for from_json.
SCHEMA = ", ".join(f"{name} {kind}" for name, kind in (DESIGN | FINDINGS).items())

# Words by which things are told.
NAMED_ANCHORS = ("first dose", "randomization", "baseline", "screening")
FIRST_ENCOUNTERS, TREATMENT_EPOCHS = ("day 1", "baseline", "first"), ("treatment", "period 1", "day 1", "inpatient")
ANCHOR_ACTIVITIES = {
    "firstdose": ("dose", "administration", "infusion", "injection", "drug"), "treatmentstart": ("dose", "administration", "treatment", "drug"), "randomization": ("randomization", "randomize", "allocation"),
    "informedconsent": ("consent", "informed consent", "icf"), "enrollment": ("enrollment", "enroll", "registration"),
}
PROSE_STARTS = ("the ", "is ", "with ", "of ", "for ", "to ", "and ", "or ", "in ", "on ", "at ", "by ", "from ", "as ")
PROSE_WORDS = ("the", "is", "with", "of", "for", "to", "and", "or", "in", "on", "at", "by")
PROSE_INSIDE = ("reconstituted", "lyophilized", "concentration", "administered", "provided", "according to")
ROUTES = {"oral": ("C38288", "Oral"), "intravenous": ("C38276", "Intravenous"), "iv": ("C38276", "Intravenous"), "subcutaneous": ("C38299", "Subcutaneous"), "intramuscular": ("C38273", "Intramuscular"), "topical": ("C38304", "Topical")}
REFERENCE_WORDS = ("first dose", "baseline", "day 1", "randomization", "screening")
VISIT_WORDS = ("day 1", "day1", "baseline", "screening", "visit", "check-in", "checkin", "admission", "discharge", "end of study", "eos", "follow-up", "followup")
EVENT_WORDS = ("first dose", "dose", "randomization", "randomisation", "informed consent", "enrollment", "enrolment", "treatment start", "drug admin")
EVENT_ACTIVITIES = {
    "dose": ("dose", "drug", "treatment", "administration"), "randomization": ("random",), "randomisation": ("random",), "informed consent": ("consent", "icf"), "enrollment": ("enroll", "registration"), "enrolment": ("enroll", "registration"),
}
DECISIONS = ("procedure_variant", "conditional_collection", "visit_required")


def low(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def has_any(text: Column, words: Sequence[str]) -> Column:
    """Whether a text in lower case contains one of the words."""
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w))
    return out


def first(array: Column, holds: Callable[[Column], Column]) -> Column:
    """The first member for which a condition holds, else null."""
    return F.try_element_at(F.filter(array, lambda x: F.coalesce(holds(x), F.lit(False))), F.lit(1))


def either_in(a: Column, b: Column) -> Column:
    """Whether one text contains the other."""
    return F.contains(a, b) | F.contains(b, a)


def told(**fields: Column) -> Column:
    return F.struct(*(c.alias(n) for n, c in fields.items()))


def made(array: str, **fields: Column) -> Column:
    """A member of a design array: the fields given, the others null."""
    kinds = [f.split(": ", 1) for f in _fields((DESIGN | TRACES)[array])]
    return F.struct(*((fields[n] if n in fields else F.lit(None)).cast(k).alias(n) for n, k in kinds))


def _fields(kind: str) -> list[str]:
    """The "name: type" parts of array<struct<...>>."""
    out, depth, start, body = [], 0, 0, kind[len("array<struct<") : -2]
    for i, c in enumerate(body + ","):
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            out.append(body[start:i].strip())
            start = i + 1
    return out


def changed(x: Column, array: str, **fields: Column) -> Column:
    """A member of a design array with some fields replaced."""
    return made(array, **{n: x[n] for n in (f.split(": ", 1)[0] for f in _fields(DESIGN[array]))} | fields)


def add(df: DataFrame, array: str, new: Column) -> DataFrame:
    return df.withColumn(array, F.concat(array, F.coalesce(new, F.filter(array, lambda _: F.lit(False)))))


def distinct_by(array: Column, key: Callable[[Column], Column]) -> Column:
    """The members whose key no member before has."""
    keys = F.transform(array, key)
    return F.filter(array, lambda x, i: F.array_position(keys, key(x)) == i + 1)


def anchor_encounter() -> Column:
    name = lambda e: low(e["name"])
    e = F.col("encounters")
    return F.coalesce(first(e, lambda x: has_any(name(x), FIRST_ENCOUNTERS)), first(e, lambda x: ~F.contains(name(x), F.lit("screen"))), F.try_element_at(e, F.lit(1)))["id"]


def treatment_epoch() -> Column:
    e = F.col("epochs")
    return F.coalesce(first(e, lambda x: has_any(low(x["name"]), TREATMENT_EPOCHS)), first(e, lambda x: ~F.contains(low(x["name"]), F.lit("screen"))), F.try_element_at(e, F.lit(1)))["id"]


def with_anchor_encounter(df: DataFrame, study: str, needed: Column) -> DataFrame:
    """An encounter for anchors to stand at, where one is needed and the study has none at all."""
    new = made("encounters", id=F.concat(F.lit("enc_anchor_"), F.col(study)), name=F.lit("Anchor Reference Point"))
    return add(df, "encounters", F.when(needed & (F.size("encounters") == 0), F.array(new)))


def promote_anchors(df: DataFrame, study: str) -> DataFrame:
    """1: time anchors become instances, by day and place in the day. One whose name a named anchor instance or an earlier
    anchor has stands for the first instance that holds the name; conceptual ones stay references."""
    df = with_anchor_encounter(df, study, F.size("anchors") > 0)
    ordered = F.array_sort(F.transform("anchors", lambda a, i: told(day_=F.coalesce(a["day"], F.lit(1)), place_=F.coalesce(a["place"], F.lit(100)), i=i, a=told(id=a["id"], name=F.coalesce(F.nullif(a["name"], F.lit("")), F.lit("Anchor")), **{"class": a["class"]}, day=a["day"], place=F.coalesce(a["place"], F.lit(100)), activity_id=a["activity_id"]))))
    df = df.withColumn("_sorted", F.transform(ordered, lambda x: x["a"]))
    df = df.withColumn("_named", F.transform(F.filter("instances", lambda x: F.contains(low(x["kind"]), F.lit("anchor")) | has_any(low(x["name"]), NAMED_ANCHORS)), lambda x: low(x["name"])))
    df = df.withColumn("_real", F.filter("_sorted", lambda a: (F.coalesce(a["class"], F.lit("")) != "Conceptual") & ~F.array_contains("_named", low(a["name"]))))
    df = df.withColumn("_new", distinct_by(F.col("_real"), lambda a: low(a["name"])))

    def activity(a: Column) -> Column:
        key = F.regexp_replace(low(a["name"]), "[ _]", "")
        words = F.lit(None).cast("array<string>")
        for name, known in ANCHOR_ACTIVITIES.items():
            words = F.coalesce(words, F.when(key == name, F.array(*map(F.lit, known))))
        words = F.coalesce(words, F.array(low(a["name"])))
        return F.coalesce(F.nullif(a["activity_id"], F.lit("")), first(F.col("activities"), lambda x: F.exists(words, lambda w: F.contains(low(x["name"]), w)))["id"])

    df = df.withColumn("_encounter", anchor_encounter()).withColumn("_epoch", treatment_epoch())
    new = F.transform("_new", lambda a: made("instances", id=F.concat(F.lit("anchor_inst_"), a["id"]), name=a["name"], kind=F.lit("ScheduledActivityInstance"), activity_id=F.when(a["class"] == "Event", activity(a)), encounter_id=F.when(F.coalesce(a["class"] != "Event", F.lit(True)), F.col("_encounter")), epoch_id=F.col("_epoch"), day=a["day"], place=a["place"], source=F.coalesce(a["class"], F.lit("Visit"))))
    df = add(df, "instances", new)
    target = lambda a: (
        F.when(F.array_contains(F.transform("_new", lambda n: n["id"]), a["id"]), F.concat(F.lit("anchor_inst_"), a["id"]))
        .when(F.array_contains("_named", low(a["name"])) | F.array_contains(F.transform("_new", lambda n: low(n["name"])), low(a["name"])) & (a["class"] != "Conceptual"), first(F.col("instances"), lambda x: F.contains(low(x["name"]), low(a["name"])))["id"])
        .otherwise(F.concat(F.lit("timing_ref_"), a["id"]))
    )
    apart = F.filter("_sorted", lambda a: (a["class"] == "Conceptual") & ~F.array_contains("_named", low(a["name"])))
    df = add(df, "conceptual", F.transform(apart, lambda a: made("conceptual", id=F.concat(F.lit("timing_ref_"), a["id"]), name=a["name"], **{"class": a["class"]})))
    return add(df, "mapping", F.transform("_sorted", lambda a: made("mapping", kind=F.lit("anchor"), source_id=a["id"], target_id=target(a)))).drop("_sorted", "_named", "_real", "_new", "_encounter", "_epoch")


def named_activity(name: Column) -> Column:
    """The first activity that has a name as name or label, or of which one name contains the other."""
    return F.when(F.coalesce(name, F.lit("")) != "", first(F.col("activities"), lambda x: (low(name) == low(x["name"])) | (low(name) == low(x["label"])) | either_in(low(name), low(x["name"])))["id"])


def promote_repetitions(df: DataFrame) -> DataFrame:
    """2: repetitions of known activities become an instance at each encounter on one of their days, unless the activity has
    one at that encounter already. Daily is every day, weekly every seven, continuous its first and last."""
    day = lambda e: F.regexp_extract(low(e["name"]), r"day\s*[-]?\s*(\d+)", 1).try_cast("long")
    df = df.withColumn("_days", distinct_by(F.filter(F.transform("encounters", lambda e: told(day=day(e), id=e["id"])), lambda x: x["day"].isNotNull()), lambda x: x["day"]))

    def of(r: Column) -> Column:
        start, end = F.coalesce(r["start_day"], F.lit(1)), F.coalesce(r["end_day"], r["start_day"], F.lit(1))
        every = F.when(r["kind"] == "Daily", F.lit(1)).when(r["kind"] == "Weekly", F.lit(7)).when(r["kind"] == "Continuous", end - start).otherwise(F.coalesce(r["every"], F.lit(1)))
        on = F.filter(F.array_sort("_days"), lambda d: d["day"].between(start, end) & (F.pmod(d["day"] - start, F.greatest(every, F.lit(1))) == 0))
        return F.transform(on, lambda d: told(rep=r["id"], instance=made("instances", id=F.concat(F.lit("rep_"), r["id"], F.lit("_day_"), d["day"]), name=F.concat(r["activity"], F.lit(" @ Day "), d["day"]), kind=F.lit("ScheduledActivityInstance"), activity_id=named_activity(r["activity"]), encounter_id=d["id"], day=d["day"], source=F.lit("execution_model"))))

    key = lambda x: F.struct(x["activity_id"].alias("a"), x["encounter_id"].alias("e"))
    df = df.withColumn("_new", F.flatten(F.transform(F.filter("repetitions", lambda r: named_activity(r["activity"]).isNotNull()), of)))
    df = df.withColumn("_new", F.filter(distinct_by(F.col("_new"), lambda x: key(x["instance"])), lambda x: ~F.array_contains(F.transform("instances", key), key(x["instance"]))))
    df = add(df, "instances", F.transform("_new", lambda x: x["instance"]))
    return add(df, "mapping", F.transform("_new", lambda x: made("mapping", kind=F.lit("repetition"), source_id=x["rep"], target_id=x["instance"]["id"]))).drop("_days", "_new")


def is_prose(text: Column) -> Column:
    """Whether a text is a fragment of prose rather than a treatment's name; null and short texts are."""
    t = low(F.trim(text))
    return (F.length(t) < 3) | t.rlike("^(?:" + "|".join(PROSE_STARTS) + ")") | t.isin(*PROSE_WORDS) | t.rlike(r"^\d+\s*(mg|ml|mcg|g|kg|iu)?\s*(and|or)?$") | t.rlike(r"^(day|week|month)\s*(and|or|$)") | has_any(t, PROSE_INSIDE)


def promote_regimens(df: DataFrame) -> DataFrame:
    """3: dosing regimens with a real treatment's name become administrations, and of the intervention that has that name,
    else of the first of which one name contains the other."""
    known = F.transform("administrations", lambda a: a["id"])
    id_ = lambda r: F.concat(F.lit("admin_"), r["id"])
    df = df.withColumn("_new", distinct_by(F.filter("regimens", lambda r: ~is_prose(r["treatment"]) & ~F.array_contains(known, id_(r))), lambda r: r["id"]))
    dose = r"^(\d+(?:\.\d+)?)\s*(\w+)?"
    routes = F.create_map(*(F.lit(x) for k, v in ROUTES.items() for x in (k, v[0]))), F.create_map(*(F.lit(x) for k, v in ROUTES.items() for x in (k, v[1])))
    blank = lambda c: F.coalesce(c, F.lit(""))
    made_of = lambda r: made(
        "administrations", id=id_(r), name=F.concat(F.lit("Administration of "), r["treatment"]), description=F.trim(F.concat_ws(" ", blank(r["dose"]), blank(r["route"]), blank(r["frequency"]))), dose=F.regexp_extract(r["dose"], dose, 1).try_cast("double"),
        unit=F.nullif(F.regexp_extract(r["dose"], dose, 2), F.lit("")), route_code=F.when(blank(r["route"]) != "", F.coalesce(F.try_element_at(routes[0], low(r["route"])), F.lit("C38288"))), route=F.when(blank(r["route"]) != "", F.coalesce(F.try_element_at(routes[1], low(r["route"])), r["route"])),
    )
    df = add(df, "administrations", F.transform("_new", made_of))
    df = add(df, "mapping", F.transform("_new", lambda r: made("mapping", kind=F.lit("regimen"), source_id=r["id"], target_id=id_(r))))
    i = F.col("interventions")
    owner = lambda r: F.coalesce(first(i, lambda x: low(x["name"]) == low(r["treatment"])), first(i, lambda x: either_in(low(x["name"]), low(r["treatment"]))))["id"]
    df = df.withColumn("_owned", F.transform("_new", lambda r: told(owner=owner(r), id=id_(r))))
    mine = lambda x: F.transform(F.filter("_owned", lambda o: o["owner"] == x["id"]), lambda o: o["id"])
    return df.withColumn("interventions", F.transform("interventions", lambda x: changed(x, "interventions", administration_ids=F.concat(F.coalesce(x["administration_ids"], F.array().cast("array<string>")), mine(x))))).drop("_new", "_owned")


def fix_timings(df: DataFrame, study: str) -> DataFrame:
    """4: timings whose reference is no instance get the one that their anchor became, else the first instance that shares a
    reference word or the day of their name; else a visit's gets an anchor instance of the missing id, an event's the first
    instance of such an activity; what is left is kept as a conceptual anchor."""
    ids = F.transform("instances", lambda x: x["id"])
    blank = lambda t: F.coalesce(t["from_instance_id"], F.lit("")) == ""
    df = df.withColumn("_ids", ids)
    inst = F.col("instances")

    def best(name: Column) -> Column:
        n = low(name)
        by_word = F.coalesce(*(F.when(F.contains(n, F.lit(w)), first(inst, lambda x, w=w: F.contains(low(x["name"]), F.lit(w)))["id"]) for w in REFERENCE_WORDS))
        day = F.regexp_extract(n, r"day\s*(\d+)", 1).try_cast("long")
        return F.coalesce(by_word, first(inst, lambda x: x["day"] == day)["id"])

    def event(name: Column) -> Column:
        n = low(name)
        words = F.array_compact(F.array(*(F.when(F.contains(n, F.lit(k)), F.lit(w)) for k, ws in EVENT_ACTIVITIES.items() for w in ws)))
        return first(inst, lambda x: F.exists(words, lambda w: F.contains(low(x["name"]), w)))["id"]

    def outcome(t: Column) -> Column:
        name = t["name"]
        anchor = first(F.col("mapping"), lambda m: (m["kind"] == "anchor") & (m["source_id"] == t["from_instance_id"]))["target_id"]
        class_ = F.when(has_any(low(name), VISIT_WORDS), "Visit").when(has_any(low(name), EVENT_WORDS), "Event").otherwise("Conceptual")
        missing = ~blank(t) & ~F.array_contains("_ids", t["from_instance_id"])
        how = F.when(~missing, "kept").when(anchor.isNotNull(), "anchor").when(best(name).isNotNull(), "timing_reference_remapped").when(class_ == "Visit", "visit_anchor_created").when((class_ == "Event") & event(name).isNotNull(), "event_anchor_linked").when(class_ == "Event", "event_anchor_unresolved").otherwise("conceptual_anchor_stored")
        to = F.when(how == "anchor", anchor).when(how == "timing_reference_remapped", best(name)).when(how == "event_anchor_linked", event(name)).otherwise(t["from_instance_id"])
        return told(t=t, how=how, to=to)

    df = df.withColumn("_fixed", F.transform("timings", outcome))
    df = with_anchor_encounter(df, study, F.exists("_fixed", lambda x: x["how"] == "visit_anchor_created")).withColumn("_encounter", anchor_encounter())
    new = distinct_by(F.filter("_fixed", lambda x: x["how"] == "visit_anchor_created"), lambda x: x["to"])
    df = add(df, "instances", F.transform(new, lambda x: made("instances", id=x["to"], name=F.concat(F.lit("Anchor: "), x["t"]["name"]), kind=F.lit("ScheduledActivityInstance"), encounter_id=F.col("_encounter"), source=F.lit("execution_model"))))
    df = add(df, "conceptual", F.transform(F.filter("_fixed", lambda x: x["how"].isin("event_anchor_unresolved", "conceptual_anchor_stored")), lambda x: made("conceptual", id=x["to"], name=x["t"]["name"], **{"class": F.when(x["how"] == "event_anchor_unresolved", "Event").otherwise("Conceptual")})))
    df = add(df, "issues", F.transform(F.filter("_fixed", lambda x: ~x["how"].isin("kept", "anchor")), lambda x: made("issues", category=x["how"], about=x["t"]["id"], told=x["to"])))
    return df.withColumn("timings", F.transform("_fixed", lambda x: changed(x["t"], "timings", from_instance_id=x["to"]))).drop("_ids", "_fixed", "_encounter")


def promote_windows(df: DataFrame, study: str) -> DataFrame:
    """5: visit windows set the bounds of their encounter's timing; an encounter without one gets a timing from the study's
    entry. The encounter is the last that has the visit's name as name or label, else the first of which one name contains the
    other. Windows without day are left out; of several for one encounter the last counts."""
    e = F.col("encounters")
    named = lambda x, n: (low(F.trim(x["name"])) == n) | (low(F.trim(x["label"])) == n) & (F.coalesce(x["label"], F.lit("")) != "")
    match = lambda w: F.coalesce(first(F.reverse(e), lambda x: named(x, low(F.trim(w["visit"])))), first(e, lambda x: either_in(low(F.trim(x["name"])), low(F.trim(w["visit"])))))
    fit = F.filter("visit_windows", lambda w: (F.coalesce(w["visit"], F.lit("")) != "") & w["day"].isNotNull())
    df = df.withColumn("_met", F.filter(F.transform(fit, lambda w: told(w=w, e=match(w)["id"])), lambda x: x["e"].isNotNull()))
    df = df.withColumn("_last", F.reverse(distinct_by(F.reverse("_met"), lambda x: x["e"])))
    df = df.withColumn("_ids", F.transform("timings", lambda t: t["id"]))
    df = df.withColumn("_lacking", F.transform(F.filter("_last", lambda x: ~F.coalesce(F.array_contains("_ids", first(e, lambda y: y["id"] == x["e"])["timing_id"]), F.lit(False))), lambda x: x["e"]))
    minted = lambda enc: F.concat(F.lit("timing_"), enc)
    df = df.withColumn("encounters", F.transform("encounters", lambda x: changed(x, "encounters", timing_id=F.when(F.array_contains("_lacking", x["id"]), minted(x["id"])).otherwise(x["timing_id"]))))
    first_day = lambda enc: first(F.col("_met"), lambda m: m["e"] == enc)["w"]
    new = F.transform("_lacking", lambda enc: made("timings", id=minted(enc), name=F.concat(F.lit("Timing for "), first_day(enc)["visit"]), from_instance_id=F.concat(F.lit("entry_"), F.col(study)), value=F.concat(F.lit("P"), first_day(enc)["day"], F.lit("D"))))
    df = add(df, "timings", new)
    df = add(df, "instances", F.when((F.size("_lacking") > 0) & ~F.exists("instances", lambda x: x["id"] == F.concat(F.lit("entry_"), F.col(study))), F.array(made("instances", id=F.concat(F.lit("entry_"), F.col(study)), name=F.lit("Entry"), kind=F.lit("Entry")))))
    window = lambda t: first(F.reverse("_last"), lambda x: first(F.col("encounters"), lambda y: y["id"] == x["e"])["timing_id"] == t["id"])["w"]
    bound = lambda n, sign: F.when(F.coalesce(n, F.lit(0)) > 0, F.concat(F.lit(sign + "P"), n, F.lit("D"))).otherwise(F.lit("P0D"))
    n = lambda c: F.coalesce(c, F.lit(0))
    label = lambda w: F.concat(F.lit("Day "), w["day"], F.lit(" (−"), n(w["before"]), F.lit("/+"), n(w["after"]), F.lit(")"))
    done = lambda t: F.when(window(t).isNull(), t).otherwise(changed(t, "timings", window_lower=bound(window(t)["before"], "-"), window_upper=bound(window(t)["after"], ""), window_label=label(window(t))))
    df = df.withColumn("timings", F.transform("timings", done))
    return add(df, "mapping", F.transform("_last", lambda x: made("mapping", kind=F.lit("visit_window"), source_id=x["w"]["visit"], target_id=first(F.col("encounters"), lambda y: y["id"] == x["e"])["timing_id"]))).drop("_met", "_last", "_ids", "_lacking")


def promote_traversals(df: DataFrame) -> DataFrame:
    """6: required sequences chain the epochs that they name by id or name; a name that is no epoch breaks its chain. Of
    several sequences the last that links an epoch counts. Encounters are chained within their epoch in order of name."""
    e = F.col("epochs")
    found = lambda ref: F.coalesce(first(e, lambda x: x["id"] == ref), first(F.reverse(e), lambda x: low(x["name"]) == low(ref)))["id"]
    ids = F.transform("traversals", lambda s: F.transform(s, found))
    pairs = F.flatten(F.transform(ids, lambda s: F.zip_with(F.slice(s, F.lit(1), F.greatest(F.size(s) - 1, F.lit(0))), F.slice(s, F.lit(2), F.greatest(F.size(s) - 1, F.lit(0))), lambda a, b: told(a=a, b=b))))
    df = df.withColumn("_pairs", F.reverse(F.filter(pairs, lambda p: p["a"].isNotNull() & p["b"].isNotNull())))
    df = df.withColumn("epochs", F.transform("epochs", lambda x: changed(x, "epochs", previous_id=F.coalesce(first(F.col("_pairs"), lambda p: p["b"] == x["id"])["a"], x["previous_id"]), next_id=F.coalesce(first(F.col("_pairs"), lambda p: p["a"] == x["id"])["b"], x["next_id"]))))
    df = df.withColumn("_order", F.array_sort(F.transform(F.filter("encounters", lambda x: F.coalesce(x["epoch_id"], F.lit("")) != ""), lambda x, i: told(epoch=x["epoch_id"], name=F.coalesce(x["name"], F.lit("")), i=i, id=x["id"]))))
    df = df.withColumn("_steps", F.filter(F.zip_with("_order", F.slice("_order", F.lit(2), F.greatest(F.size("_order"), F.lit(1))), lambda a, b: told(a=a, b=b)), lambda p: p["a"]["epoch"] == p["b"]["epoch"]))
    step = F.when(F.size("traversals") > 0, F.col("_steps")).otherwise(F.filter("_steps", lambda _: F.lit(False)))
    df = df.withColumn("_steps", step)
    return df.withColumn("encounters", F.transform("encounters", lambda x: changed(x, "encounters", previous_id=F.coalesce(first(F.col("_steps"), lambda p: p["b"]["id"] == x["id"])["a"]["id"], x["previous_id"]), next_id=F.coalesce(first(F.col("_steps"), lambda p: p["a"]["id"] == x["id"])["b"]["id"], x["next_id"])))).drop("_pairs", "_order", "_steps")


def promote_conditions(df: DataFrame) -> DataFrame:
    """7: footnote conditions become conditions of the activities that they name by id or name; those that decide on an
    activity become decision instances too. Conditions without text, and ids that are there, are left out."""
    a = F.col("activities")
    resolve = lambda ref: F.coalesce(first(a, lambda x: x["id"] == ref), first(F.reverse(a), lambda x: low(x["name"]) == low(ref)))["id"]
    known = F.transform("conditions", lambda c: c["id"])
    df = df.withColumn("_new", distinct_by(F.filter("footnotes", lambda f: (F.coalesce(f["text"], F.lit("")) != "") & ~F.array_contains(known, f["id"])), lambda f: f["id"]))
    df = df.withColumn("_new", F.transform("_new", lambda f: told(f=f, to=F.array_compact(F.transform(F.coalesce(f["applies_to"], F.array().cast("array<string>")), resolve)), name=F.coalesce(F.initcap(F.translate(F.nullif(f["kind"], F.lit("")), "_", " ")), F.lit("Conditional Rule")))))
    df = add(df, "conditions", F.transform("_new", lambda x: made("conditions", id=x["f"]["id"], name=x["name"], text=x["f"]["text"], applies_to=x["to"])))
    df = add(df, "mapping", F.transform("_new", lambda x: made("mapping", kind=F.lit("footnote"), source_id=x["f"]["id"], target_id=x["f"]["id"])))
    decides = F.filter("_new", lambda x: (F.size(x["to"]) > 0) & x["f"]["kind"].isin(*DECISIONS))
    return add(df, "instances", F.transform(decides, lambda x: made("instances", id=F.concat(F.lit("sdi_"), x["f"]["id"]), name=F.concat(F.lit("Decision: "), x["name"]), kind=F.lit("ScheduledDecisionInstance"), source=x["f"]["text"], target_id=x["to"][0]))).drop("_new")


def promote_transitions(df: DataFrame) -> DataFrame:
    """8: transitions with a trigger become the start rule of the encounter that their state names and the end rule of the
    one that they leave; of several the last counts."""
    rule = lambda t: F.concat(t["trigger"], F.when(F.coalesce(t["guard"], F.lit("")) != "", F.concat(F.lit(" [Guard: "), t["guard"], F.lit("]"))).otherwise(F.lit("")))
    df = df.withColumn("_t", F.reverse(F.filter("transitions", lambda t: F.coalesce(t["trigger"], F.lit("")) != "")))
    of = lambda x, side: first(F.col("_t"), lambda t: (low(t[side]) == low(x["name"])) & (low(x["name"]) != ""))
    last = lambda x, i: F.array_position(F.reverse(F.transform("encounters", lambda y: low(y["name"]))), low(x["name"])) == F.size("encounters") - i
    done = lambda x, i: changed(x, "encounters", start_rule=F.coalesce(F.when(last(x, i), rule(of(x, "to_state"))), x["start_rule"]), end_rule=F.coalesce(F.when(last(x, i), rule(of(x, "from_state"))), x["end_rule"]))
    return df.withColumn("encounters", F.transform("encounters", done)).drop("_t")


def promote_estimands(df: DataFrame) -> DataFrame:
    """9: endpoint algorithms go to the estimand of the endpoint of their name, else to the first of which one name contains
    the other; one that has an algorithm keeps it, and of several the first counts. None is made."""
    e, p = F.col("estimands"), F.col("endpoints")
    endpoint = lambda a: first(F.reverse(p), lambda x: (low(x["name"]) == low(a["name"])) & (low(a["name"]) != ""))["id"]
    by_name = lambda a: first(e, lambda x: (low(x["name"]) != "") & (low(a["name"]) != "") & either_in(low(a["name"]), low(x["name"])))
    target = lambda a: F.coalesce(first(F.reverse(e), lambda x: x["endpoint_id"] == endpoint(a)), by_name(a))["id"]
    df = df.withColumn("_to", F.transform(F.filter("algorithms", lambda a: F.coalesce(a["algorithm"], F.lit("")) != ""), lambda a: told(to=target(a), algorithm=a["algorithm"])))
    return df.withColumn("estimands", F.transform("estimands", lambda x: changed(x, "estimands", algorithm=F.coalesce(x["algorithm"], first(F.col("_to"), lambda t: t["to"] == x["id"])["algorithm"])))).drop("_to")


def promote_titrations(df: DataFrame) -> DataFrame:
    """10: the levels of titrations become elements in a chain, each with its criteria as start rule."""
    known = F.transform("elements", lambda x: x["id"])
    id_ = lambda t, i: F.concat(F.lit("elem_"), t["id"], F.lit("_"), i)
    named = lambda t, v, i: F.when(F.coalesce(t["name"], F.lit("")) != "", F.concat(t["name"], F.lit(" - Step "), i + 1, F.lit(": "), F.coalesce(v["dose"], F.lit("")))).otherwise(F.concat(F.lit("Dose Step "), i + 1))

    def levels(t: Column) -> Column:
        fresh = F.filter(F.transform(F.coalesce(t["levels"], F.array().cast("array<struct<dose: string, duration: string, criteria: string>>")), lambda v, i: told(v=v, i=i, id=id_(t, i))), lambda x: ~F.array_contains(known, x["id"]))
        return F.transform(fresh, lambda x, k: made("elements", id=x["id"], name=named(t, x["v"], x["i"]), description=x["v"]["duration"], previous_id=F.when(k > 0, F.try_element_at(fresh, k)["id"]), start_rule=F.nullif(x["v"]["criteria"], F.lit(""))))

    df = df.withColumn("_new", distinct_by(F.flatten(F.transform("titrations", levels)), lambda x: x["id"]))
    df = add(df, "elements", F.col("_new"))
    return add(df, "mapping", F.transform("_new", lambda x: made("mapping", kind=F.lit("titration"), source_id=F.regexp_extract(x["id"], "^elem_(.*)_[0-9]+$", 1), target_id=x["id"]))).drop("_new")


def promote(studies: DataFrame, study: str) -> DataFrame:
    """studies (study, and arrays by the names and types of DESIGN and FINDINGS; those left out or null count as empty) after
    all ten steps: study, the arrays of DESIGN, mapping (kind, source_id, target_id) and issues (category, about, told).
    Other columns are left out. Rows are promoted one by one; a study's arrays are held together, as large as its document.
    The result is cut from its plan: a filter on it, pushed down through ten steps, would multiply their expressions."""
    wanted = DESIGN | FINDINGS | TRACES
    empty = lambda kind: F.array().cast(kind)
    df = studies.select(study, *((F.coalesce(F.col(n).cast(kind), empty(kind)) if n in studies.columns and n not in TRACES else empty(kind)).alias(n) for n, kind in wanted.items()))
    df = promote_anchors(df, study)
    df = promote_repetitions(df)
    df = promote_regimens(df)
    df = fix_timings(df, study)
    df = promote_windows(df, study)
    df = promote_traversals(df)
    df = promote_conditions(df)
    df = promote_transitions(df)
    df = promote_estimands(df)
    df = promote_titrations(df)
    return cut(df.drop(*FINDINGS))


def promotion_issues(designs: DataFrame, study: str) -> DataFrame:
    """(study, category, about, told): what is wrong in designs after promotion. orphan_reference: a condition of no
    activity, or an estimand of no endpoint; dangling_reference: a timing from no instance and no conceptual anchor; invalid_condition_target: a
    decision on neither an instance nor an activity; broken_chain: an epoch or encounter before or after one that is none."""
    ids = {n: F.transform(n, lambda x: x["id"]) for n in ("activities", "encounters", "epochs", "instances", "endpoints")}
    lacks = lambda name, id_: (F.coalesce(id_, F.lit("")) != "") & ~F.array_contains(ids[name], id_)
    issue = lambda category, about, id_: made("issues", category=F.lit(category), about=about, told=id_)
    parts = [
        F.flatten(F.transform("conditions", lambda c: F.transform(F.filter(F.coalesce(c["applies_to"], F.array().cast("array<string>")), lambda a: lacks("activities", a)), lambda a: issue("orphan_reference", c["id"], a)))),
        F.transform(F.filter("timings", lambda t: lacks("instances", t["from_instance_id"]) & ~F.array_contains(F.transform("conceptual", lambda c: c["id"]), t["from_instance_id"])), lambda t: issue("dangling_reference", t["id"], t["from_instance_id"])),
        F.transform(F.filter("instances", lambda x: (x["kind"] == "ScheduledDecisionInstance") & lacks("instances", x["target_id"]) & lacks("activities", x["target_id"])), lambda x: issue("invalid_condition_target", x["id"], x["target_id"])),
        *(F.transform(F.filter(n, lambda x: lacks(n, x[side])), lambda x: issue("broken_chain", x["id"], x[side])) for n in ("encounters", "epochs") for side in ("previous_id", "next_id")),
        F.transform(F.filter("estimands", lambda x: lacks("endpoints", x["endpoint_id"])), lambda x: issue("orphan_reference", x["id"], x["endpoint_id"])),
    ]
    return designs.select(study, F.explode(F.concat(*parts)).alias("_i")).select(study, "_i.*")

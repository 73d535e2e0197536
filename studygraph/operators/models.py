"""Checks of whole execution models: one row for each study, its components as arrays, and rules that run over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL = {
    "anchors": "array<struct<kind: string, definition: string>>",
    "repetitions": "array<struct<id: string, kind: string, interval: string>>",
    "execution_types": "array<struct<activity: string, kind: string>>",
    "traversals": "array<array<string>>",
    "crossover": "struct<is_crossover: boolean, periods: long, sequences: array<string>>",
    "footnotes": "array<struct<structured: string>>",
    "endpoints": "array<struct<name: string, kind: string, algorithm: string>>",
    "variables": "array<struct<name: string, kind: string, baseline: string, derivation: string>>",
    "machine": "struct<states: array<string>, initial: string, terminal: array<string>, transitions: array<struct<from_state: string, to_state: string>>>",
    "sampling": "array<struct<activity: string, least: long, timepoints: array<string>, window: string>>",
}
#: Points that an error and a warning cost.
COSTS = {"error": 0.15, "warning": 0.05}


def _lacks(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) == ""


def _when(condition: Column, severity: str, component: str, message: Column | str, field: str | None = None) -> Column:
    """One issue in an array, or an empty one."""
    told = message if isinstance(message, Column) else F.lit(message)
    issue = F.struct(F.lit(component).alias("component"), F.lit(severity).alias("severity"), told.alias("message"), F.lit(field).cast("string").alias("field"))
    return F.when(F.coalesce(condition, F.lit(False)), F.array(issue)).otherwise(F.filter(F.array(issue), lambda _: F.lit(False)))


def _each(array: Column, condition, severity: str, component: str, message, field: str | None = None) -> Column:
    """An issue for each member for which a condition holds."""
    return F.flatten(F.transform(array, lambda x: _when(condition(x), severity, component, message(x), field)))


def _count(array: Column, condition) -> Column:
    return F.size(F.filter(array, condition))


def _issues(require_machine: bool) -> Column:
    a, r, t, x, n, e, v, m, s = (F.col(c) for c in ("anchors", "repetitions", "traversals", "crossover", "footnotes", "endpoints", "variables", "machine", "sampling"))
    some = lambda c: F.size(c) > 0
    primary = _count(e, lambda y: y["kind"] == "Primary")
    no_algorithm, bare = _count(e, lambda y: _lacks(y["algorithm"])), _count(n, lambda y: _lacks(y["structured"]))
    no_baseline = _count(v, lambda y: F.contains(F.lower(y["kind"]), F.lit("baseline")) & _lacks(y["baseline"]))
    no_rule, no_window = _count(v, lambda y: _lacks(y["derivation"])), _count(s, lambda y: (F.size(y["timepoints"]) > 0) & _lacks(y["window"]))
    definitions = F.transform(a, lambda y: F.lower(y["definition"]))
    empty = F.array().cast("array<string>")
    states, terminal = F.array_distinct(F.coalesce(m["states"], empty)), F.coalesce(m["terminal"], empty)
    moves = F.coalesce(m["transitions"], F.array().cast("array<struct<from_state: string, to_state: string>>"))
    unreached = F.array_sort(F.array_except(states, F.concat(F.transform(moves, lambda y: y["to_state"]), F.array(m["initial"]))))
    dead = F.array_sort(F.array_except(states, F.concat(F.transform(moves, lambda y: y["from_state"]), terminal)))
    has = m.isNotNull()
    listed = lambda head, names: F.concat(F.lit(head), F.array_join(names, ", "))
    periods = F.exists(F.flatten(t), lambda y: F.contains(F.upper(y), F.lit("PERIOD")) | F.contains(F.upper(y), F.lit("WASHOUT")))
    change = F.exists(e, lambda y: F.contains(F.lower(y["name"]), F.lit("change")) & F.contains(F.lower(y["name"]), F.lit("baseline")))
    changes = F.exists(v, lambda y: F.contains(F.lower(y["name"]), F.lit("change")) | (y["kind"] == "ChangeFromBaseline"))
    missing = lambda c, severity, component, message: _when(F.size(c) == 0, severity, component, message)
    return F.concat(
        missing(a, "warning", "TimeAnchors", "No time anchors extracted"),
        _when(some(a) & ~F.exists(a, lambda y: F.coalesce(y["kind"].isin("FirstDose", "Randomization"), F.lit(False))), "info", "TimeAnchors", "No first dose or randomization anchor found"),
        _when(F.size(F.array_distinct(definitions)) < F.size(definitions), "warning", "TimeAnchors", "Duplicate anchor definitions detected"),
        missing(r, "info", "Repetitions", "No repetition patterns extracted"),
        _each(r, lambda y: (y["kind"] == "Interval") & _lacks(y["interval"]), "warning", "Repetitions", lambda y: F.concat(F.lit("Interval repetition '"), F.coalesce(y["id"], F.lit("")), F.lit("' missing interval duration")), "interval"),
        missing(F.col("execution_types"), "warning", "ExecutionTypes", "No execution types classified"),
        missing(t, "info", "TraversalConstraints", "No traversal constraints extracted"),
        _each(t, lambda y: F.coalesce(F.size(y), F.lit(0)) < 2, "warning", "TraversalConstraints", lambda _: "Traversal sequence too short", "required_sequence"),
        _each(t, lambda y: (F.size(y) > 0) & (F.upper(F.try_element_at(y, F.lit(1))) != "SCREENING"), "info", "TraversalConstraints", lambda _: "Sequence doesn't start with SCREENING", "required_sequence"),
        _when(x["is_crossover"] & (F.coalesce(x["periods"], F.lit(0)) < 2), "error", "CrossoverDesign", "Crossover design must have at least 2 periods", "num_periods"),
        _when(x["is_crossover"] & (F.coalesce(F.size(x["sequences"]), F.lit(0)) < 1), "warning", "CrossoverDesign", "Crossover missing treatment sequences", "sequences"),
        _when(F.size(n) > 100, "warning", "FootnoteConditions", F.concat(F.lit("Unusually high number of footnotes ("), F.size(n), F.lit(")"))),
        _when(bare > F.size(n) * 0.5, "info", "FootnoteConditions", F.concat(bare, F.lit(" footnotes lack structured conditions"))),
        missing(e, "info", "EndpointAlgorithms", "No endpoint algorithms extracted"),
        _when(some(e) & (primary == 0), "warning", "EndpointAlgorithms", "No primary endpoint extracted"),
        _when(no_algorithm > 0, "warning", "EndpointAlgorithms", F.concat(no_algorithm, F.lit(" endpoints missing algorithm/calculation logic")), "algorithm"),
        missing(v, "info", "DerivedVariables", "No derived variables extracted"),
        _when(no_baseline > 0, "warning", "DerivedVariables", F.concat(no_baseline, F.lit(" change-from-baseline vars missing baseline definition")), "baseline_definition"),
        _when(no_rule > 0, "warning", "DerivedVariables", F.concat(no_rule, F.lit(" variables missing derivation rule")), "derivation_rule"),
        _when(~has, "error" if require_machine else "info", "StateMachine", "State machine required but not generated" if require_machine else "No state machine generated"),
        _when(has & (F.size(states) < 3), "warning", "StateMachine", "State machine has too few states", "states"),
        _when(has & (F.size(terminal) == 0), "error", "StateMachine", "State machine has no terminal states", "terminal_states"),
        _when(has & (F.size(moves) == 0), "warning", "StateMachine", "State machine has no transitions", "transitions"),
        _when(has & some(unreached), "warning", "StateMachine", listed("Unreachable states: ", unreached), "transitions"),
        _when(has & some(dead), "warning", "StateMachine", listed("Non-terminal dead-end states: ", dead)),
        missing(s, "info", "SamplingConstraints", "No sampling constraints extracted"),
        _each(s, lambda y: y["least"] > 30, "warning", "SamplingConstraints", lambda y: F.concat(F.lit("Unusually high sample count ("), y["least"], F.lit(") for "), F.coalesce(y["activity"], F.lit(""))), "min_per_window"),
        _each(s, lambda y: y["least"] < 2, "warning", "SamplingConstraints", lambda y: F.concat(F.lit("Very low sample count ("), y["least"], F.lit(") for "), F.coalesce(y["activity"], F.lit(""))), "min_per_window"),
        _when(no_window > 0, "info", "SamplingConstraints", F.concat(no_window, F.lit(" constraints have timepoints but no window duration")), "window_duration"),
        _when(x["is_crossover"] & some(t) & ~F.coalesce(periods, F.lit(False)), "info", "Consistency", "Crossover detected but traversal doesn't show period structure"),
        _when(some(e) & some(v) & F.coalesce(change, F.lit(False)) & ~F.coalesce(changes, F.lit(False)), "info", "Consistency", "Change-from-baseline endpoints found but no CFB derived variables"),
    )


def checked(models: DataFrame, study: str, require_machine: bool = False) -> DataFrame:
    """(study, issues) of models (study, components by the names and types of MODEL; those left out or null count as empty,
    for crossover and machine as none)."""
    empty = lambda n, kind: F.coalesce(F.col(n).cast(kind), F.array().cast(kind)) if kind.startswith("array") else F.col(n).cast(kind)
    given = models.select(study, *((empty(n, k) if n in models.columns else F.array().cast(k) if k.startswith("array") else F.lit(None).cast(k)).alias(n) for n, k in MODEL.items()))
    return given.select(study, _issues(require_machine).alias("issues"))


def model_issues(models: DataFrame, study: str, require_machine: bool = False) -> DataFrame:
    """(study, component, severity, message, field): every issue of every model. The ten components and the consistency
    between them are checked, as in checked(). A study without issues gives no row. States are looked at one step far; for any
    distance see reach.state_paths."""
    return checked(models, study, require_machine).select(study, F.explode("issues").alias("_i")).select(study, "_i.*")


def model_scores(models: DataFrame, study: str, require_machine: bool = False) -> DataFrame:
    """(study, errors, warnings, infos, score, valid) of every model: score is 1 less 0.15 for each error and 0.05 for each
    warning, at least 0; valid without errors."""
    n = lambda severity: F.size(F.filter("issues", lambda i: i["severity"] == severity)).cast("long")
    counted = checked(models, study, require_machine).select(study, n("error").alias("errors"), n("warning").alias("warnings"), n("info").alias("infos"))
    score = F.greatest(F.lit(0.0), F.lit(1.0) - F.col("errors") * COSTS["error"] - F.col("warnings") * COSTS["warning"])
    return counted.select("*", score.alias("score"), (F.col("errors") == 0).alias("valid"))


# Words that name arms as sequences, and words of titration.
SEQUENCE_NAMES = ("sequence ab", "sequence ba", "ab sequence", "ba sequence", "sequence 1", "sequence 2", "treatment sequence")
TITRATIONS = ("titration", "titrate", "dose escalation", "dose adjustment")
SWITCHES = (r"(\w+)\s+to\s+(\w+)", r"(\w+)\s*[→➔]\s*(\w+)", r"(\w+)\s+then\s+(\w+)")


def _any(text: Column, words: Sequence[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w))
    return out


def crossover_consistency(designs: DataFrame, study: str) -> DataFrame:
    """(study, keep, issues) of designs (study, arms array<struct<name, description>>, epochs as their number, ratio,
    periods, sequences as their number) in which a crossover was found: whether it stays, and why not or what is odd.

    It goes, at the first of these: one arm or none but several sequences; more than two arms and none named as a sequence;
    arms that switch one way and never back; a ratio of more than two parts; arms that speak of titration. An unequal ratio of
    two and more periods than epochs are told, but it stays. Null arms count as none, a null ratio as not given."""
    arms = F.coalesce(F.col("arms"), F.array().cast("array<struct<name: string, description: string>>"))
    text = lambda c: F.array_join(F.transform(arms, lambda a: F.coalesce(a[c], F.lit(""))), " ")
    low = F.lower(F.concat(text("description"), F.lit(" "), text("name")))
    pair = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    switches = F.concat(*(F.zip_with(F.regexp_extract_all(low, F.lit(p), F.lit(1)), F.regexp_extract_all(low, F.lit(p), F.lit(2)), pair) for p in SWITCHES))
    both_ways = F.exists(switches, lambda s: F.array_contains(switches, pair(s["b"], s["a"])))
    parts = F.filter(F.transform(F.split(F.coalesce("ratio", F.lit("")), ":"), lambda r: F.when(r.rlike("^[0-9]+$"), r.try_cast("long"))), lambda r: r.isNotNull())
    given = F.contains(F.coalesce("ratio", F.lit("")), F.lit(":"))
    issue = lambda condition, category, fatal: F.when(F.coalesce(condition, F.lit(False)), F.struct(F.lit(category).alias("category"), F.lit(fatal).alias("fatal")))
    n = F.size(arms)
    named = F.exists(arms, lambda a: _any(F.lower(F.coalesce(a["name"], F.lit(""))), SEQUENCE_NAMES) | _any(F.lower(F.coalesce(a["description"], F.lit(""))), SEQUENCE_NAMES))
    found = F.array_compact(F.array(
        issue((n <= 1) & (F.col("sequences") > 1), "crossover_design_mismatch", True), issue((n > 2) & ~named, "crossover_parallel_mismatch", True), issue((F.size(switches) > 0) & ~both_ways, "crossover_switch_pattern", True),
        issue(given & (F.size(parts) > 2), "crossover_ratio_mismatch", True), issue(given & (F.size(parts) == 2) & (F.try_element_at(parts, F.lit(1)) != F.try_element_at(parts, F.lit(2))), "crossover_unequal_ratio", False),
        issue(F.col("periods") > F.coalesce("epochs", F.lit(0)), "crossover_period_mismatch", False), issue(_any(low, TITRATIONS), "crossover_titration_conflict", True),
    ))
    rows = designs.select(study, found.alias("_f"))
    end = F.array_position(F.transform("_f", lambda i: i["fatal"]), True)
    until = F.when(end > 0, F.slice("_f", F.lit(1), end.cast("int"))).otherwise(F.col("_f"))
    return rows.select(study, (end == 0).alias("keep"), F.transform(until, lambda i: i["category"]).alias("issues"))

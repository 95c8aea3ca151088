"""Record normalisers: one projection each, and their fixed order."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorekit.functions import vocabulary as V
from lorekit.functions.text import any_in, joined, lowered, strip, string_list, task_tokens, text
from lorekit.schema import FIELDS, barrier

ALIASES = {alias: target for target, aliases in V.CATEGORIES.items() for alias in aliases}


def lookup(values: dict[str, str], key: Column) -> Column:
    """The value of a key in a small fixed table, null if it has none."""
    return F.try_element_at(F.create_map(*map(F.lit, chain.from_iterable(values.items()))), key)


def category() -> Column:
    low = lowered("category")
    spaced = F.translate(low, "_-", "  ")
    out = F.when(low == "", "Functional Logic").when(low.isin(*ALIASES), lookup(ALIASES, low))
    for cues, target in V.CATEGORY_CASCADE:
        out = out.when(any_in(spaced, cues), target)
    return out.otherwise(strip(text("category")))


def record_id() -> Column:
    clean = F.regexp_replace(F.regexp_replace(lowered("id"), "[^a-z0-9_]", "_"), "_+", "_")
    return F.coalesce(F.nullif(F.btrim(clean, F.lit("_")), F.lit("")), F.lit("unknown"))


def importance() -> Column:
    low = lowered("importance")
    return F.when(low.isin("high", "medium", "low"), low).otherwise("medium")


def _given(column: str, aliases: dict[str, str], low: Column) -> Column:
    return F.nullif(F.coalesce(lookup(aliases, low), low), F.lit(""))


def experience_type() -> Column:
    low, kind = lowered("experience_type"), lowered("category")
    every = F.lower(joined(F.col("problem"), F.col("solution"), F.col("id"), kind))
    inferred = (
        F.when(any_in(kind, ["interface", "spec"]), "spec_compliance")
        .when(any_in(every, V.PATTERN_CUES), "implementation_pattern")
        .when(any_in(every, V.STYLE_CUES), "style_or_portability")
        .when(any_in(every, V.PROCESS_CUES), "meta_process")
        .otherwise("functional_bug_fix")
    )
    return F.coalesce(_given("experience_type", V.TYPE_ALIASES, low), inferred)


def _root_hint(hints: list[tuple[str, str]]) -> Column:
    every = F.lower(joined(F.col("problem"), F.col("solution"), F.col("id")))
    first = F.when(F.lit(False), "")
    for cue, root in hints:
        first = first.when(every.contains(cue), root)
    return first.otherwise("general_logic")


def root_cause() -> Column:
    low = F.translate(lowered("root_cause_type"), " ", "_")
    return F.coalesce(_given("root_cause_type", V.ROOT_ALIASES, low), _root_hint(V.ROOT_HINTS))


def task_scope() -> Column:
    task = lowered("task_id")
    every = F.lower(joined(F.col("problem"), F.col("solution"), F.col("evidence")))
    wide = (lowered("task_scope") == "cross_task") & F.coalesce(F.col("root_cause_type").isin(*V.WIDE_ROOTS), F.lit(False)) & any_in(every, V.DECLARATION_CUES)
    return F.when((task == "") | task.rlike("[,;/ ]") | wide, "cross_task").otherwise("task_specific")


def clamped(c: Column) -> Column:
    return F.when(F.isnan(c) | (c < 0), 0.0).when(c > 1, 1.0).otherwise(c)


def confidence() -> Column:
    c = F.col("confidence").cast("double")
    return F.when(c.isNull(), F.when(text("evidence") != "", 0.8).otherwise(0.55)).otherwise(clamped(c))


def task_bucket() -> Column:
    own = F.array_join(F.array_sort(task_tokens(F.lower(text("task_id")))), ",")
    return F.when((text("task_scope") == "cross_task") | (text("task_id") == ""), "").otherwise(own)


def higher_importance(a: Column, b: Column) -> Column:
    rank = lambda c: F.when(c == "high", 3).when(c == "medium", 2).otherwise(1)
    return F.when(rank(a) >= rank(b), a).otherwise(b)


#: What a normaliser reads of the others' results.
NEEDS = {"importance": ["evidence"], "experience_type": ["category", "id"], "root_cause_type": ["id"], "task_scope": ["root_cause_type", "id"], "evidence_list": ["evidence"]}


def normalize(df: DataFrame, only: tuple[str, ...] | None = None) -> DataFrame:
    """Every normaliser in the order in which later ones read earlier results; only: for these fields, without the others.

    Not idempotent for records without evidence: each pass lowers their importance by one step.
    """
    lower_step = F.when(F.col("importance") == "high", "medium").when(F.col("importance") == "medium", "low").otherwise(F.col("importance"))
    none = F.array().cast("array<string>")
    steps = [
        ("category", category()), ("id", record_id()), ("importance", importance()), ("experience_type", experience_type()), ("root_cause_type", root_cause()), ("task_scope", task_scope()), ("confidence", confidence()),
        ("canonical", F.coalesce("canonical", F.lit(True))), ("evidence", F.nullif(strip(text("evidence")), F.lit(""))), ("evidence_list", F.nullif(string_list(F.col("evidence_list"), F.col("evidence")), none)),
        ("merged_from", F.nullif(string_list(F.col("merged_from")), none)), ("importance", F.when(F.col("evidence").isNull(), lower_step).otherwise(F.col("importance"))),
    ]
    wanted = set(FIELDS if only is None else only)
    for name in ("task_scope", *NEEDS):
        if name in wanted:
            wanted |= set(NEEDS[name])
    rows = df
    for name, column in steps:
        if name in wanted:
            rows = rows.withColumn(name, column)
    if only is not None:
        rows = rows.select(*(c for c in df.columns if c not in FIELDS or c in only))
    return barrier(rows)


def extracted_type() -> Column:
    """The extractor's own reading of a type."""
    low, kind = lowered("experience_type"), lowered("category")
    every = F.lower(joined(F.col("problem"), F.col("solution"), F.col("id"), kind))
    aliases = {k: v for k, v in V.TYPE_ALIASES.items() if k != "interface compliance"}
    inferred = (
        F.when(any_in(kind, ["interface", "spec"]), "spec_compliance")
        .when(any_in(every, V.PATTERN_CUES), "implementation_pattern")
        .when(any_in(kind, ["language compliance", "verification", "process"]), "style_or_portability")
        .otherwise("functional_bug_fix")
    )
    return F.coalesce(_given("experience_type", aliases, low), inferred)


def extracted_root() -> Column:
    low = F.nullif(F.translate(lowered("root_cause_type"), " ", "_"), F.lit(""))
    return F.coalesce(low, _root_hint([h for h in V.ROOT_HINTS if h[0] != "underflow"]))


def extracted_scope() -> Column:
    low, task = lowered("task_scope"), lowered("task_id")
    by_task = F.when((task == "") | task.rlike("[,;/ ]"), "cross_task").otherwise("task_specific")
    return F.when(low.isin("task_specific", "cross_task"), low).otherwise(by_task)

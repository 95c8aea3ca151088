"""Quality gate, quality score and filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lorekit.functions import vocabulary as V
from lorekit.functions.text import any_in, has, hits, joined, lowered, text
from lorekit.operators.normalize import normalize
from lorekit.schema import MAIN_TYPES

PASS = "pass"


def gate() -> Column:
    """The first rule of the quality gate that a normalised record breaks, or `pass`."""
    problem, solution, evidence = text("problem"), text("solution"), text("evidence")
    every = F.lower(joined(F.col("category"), problem, solution, evidence))
    either = lambda family: has(problem, family) | has(solution, family)
    return (
        F.when(~F.coalesce(F.col("experience_type").isin(*MAIN_TYPES), F.lit(False)), "type")
        .when(F.length(problem) < 24, "problem_length")
        .when(F.length(solution) < 36, "solution_length")
        .when(F.coalesce("confidence", F.lit(0.0)) < 0.45, "confidence")
        .when(F.length(evidence) < 8, "evidence_length")
        .when(either(V.GATE_VAGUE), "vague")
        .when(has(every, V.GATE_META), "meta")
        .when(has(every, V.SPECULATIVE), "speculative")
        .when(either(V.WORKAROUND), "workaround")
        .when(hits(solution, V.ACTION) == 0, "action")
        .when((hits(evidence, V.EVIDENCE) == 0) & (F.length(evidence) < 20), "evidence_words")
        .when(F.coalesce(F.col("root_cause_type").isin("process", "style"), F.lit(False)), "root")
        .when(any_in(every, ["always verify", "clarify spec"]), "empty_advice")
        .otherwise(PASS)
    )


def quality_score() -> Column:
    """Higher is better; terms are added in a fixed order, as sums of doubles depend on it."""
    problem, solution, evidence = text("problem"), text("solution"), text("evidence")
    kind, root = lowered("experience_type"), lowered("root_cause_type")
    listed = F.greatest(F.size(F.coalesce("evidence_list", F.array().cast("array<string>"))), F.lit(0)).cast("double")
    actions = hits(solution, V.ACTION)
    conflicts = hits(F.concat(problem, F.lit(" "), solution), V.CONFLICT).cast("double")
    sure = F.col("confidence").cast("double")
    sure = F.when(F.isnan(sure) | (sure < 0), 0.0).when(sure > 1, 1.0).otherwise(sure)
    rank = F.lower(F.coalesce(F.nullif(F.col("importance"), F.lit("")), F.lit("medium")))
    either = lambda family: has(problem, family) | has(solution, family)
    zero = F.lit(0.0)
    return (
        F.when(evidence != "", 2.0).otherwise(0.0)
        + F.least(F.lit(1.0), 0.25 * listed)
        + F.when(text("task_id") != "", 1.0).otherwise(0.0)
        + F.when(text("task_scope") == "cross_task", 0.5).otherwise(0.0)
        + F.when((F.length(solution) >= 60) & (actions >= 2), 2.0).when(actions >= 1, 1.0).otherwise(0.0)
        + F.when(root.isin(*V.SPECIFIC_ROOTS), 1.5).when((root != "") & (root != "general_logic"), 0.75).otherwise(0.0)
        + F.when(kind == "spec_compliance", 2.0).when(kind == "functional_bug_fix", 1.8).when(kind == "implementation_pattern", 1.3).when(kind.isin("meta_process", "style_or_portability"), -3.0).otherwise(0.0)
        + F.coalesce(sure * 2.0, zero)
        - F.when((F.length(problem) < 35) | either(V.SCORE_VAGUE), 1.5).otherwise(0.0)
        - F.when(either(V.SCORE_META), 2.0).otherwise(0.0)
        - F.least(F.lit(1.5), 0.3 * conflicts)
        + F.when(rank == "high", 2.0).when(rank == "low", 0.0).otherwise(1.0)
    )


def passing(normalized: DataFrame) -> DataFrame:
    return normalized.where(gate() == PASS)


def prepare(df: DataFrame) -> DataFrame:
    """Normalised records that pass the gate."""
    return passing(normalize(df))


def main_types_or_all(df: DataFrame) -> DataFrame:
    """Records of the main types; all of them if there is none."""
    main = F.trim(text("experience_type")).isin(*MAIN_TYPES)
    any_main = df.agg(F.coalesce(F.max(main), F.lit(False)).alias("_any"))
    return df.crossJoin(F.broadcast(any_main)).where(main | ~F.col("_any")).drop("_any")  # one row


def top_by_quality(df: DataFrame, n: int, *ties: str) -> DataFrame:
    """The n best records, ties in the order of the given columns; only n rows of each partition travel."""
    return df.withColumn("quality", quality_score()).orderBy(F.desc("quality"), *ties).limit(n)


def cap(pool: DataFrame, most: int = 450, order: str = "pos") -> DataFrame:
    """At most that many records of a pool, in their old order."""
    return top_by_quality(pool, most, order).drop("quality").orderBy(order)


def export_lines(pool: DataFrame, n: int = 20, order: str = "pos") -> DataFrame:
    """rank, block: the text of the best records, for use in a prompt."""
    best = top_by_quality(main_types_or_all(normalize(pool)), n, order)
    rank = F.row_number().over(W.orderBy(F.desc("quality"), order))  # n rows
    best = best.withColumn("rank", rank)
    body = F.concat(F.col("rank").cast("string"), F.lit(". ["), text("category"), F.lit("] "), text("problem"), F.lit("\n   Solution: "), text("solution"), F.when(text("code_pattern") != "", F.concat(F.lit("\n   Pattern: "), F.substring("code_pattern", 1, 200))).otherwise(""), F.lit("\n"))
    return best.select("rank", "id", "quality", body.alias("block"))


def export_text(pool: DataFrame, n: int = 20, order: str = "pos") -> str:
    return "\n".join(r.block for r in export_lines(pool, n, order).orderBy("rank").collect())  # n rows

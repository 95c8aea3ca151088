"""Similarities of records and the predicates built on them.

Token sets are computed once for each record (with_tokens); pairs then cost array operations only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorekit.functions.text import jaccard as set_jaccard
from lorekit.functions.text import strip, task_tokens, text, tokens
from lorekit.operators.blocks import Block, jaccard, meet, pack, same
from lorekit.operators.normalize import task_bucket
from lorekit.schema import barrier

SETS = ("problem", "solution", "evidence")


def with_tokens(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("t_problem", tokens("problem"))
        .withColumn("t_solution", tokens("solution"))
        .withColumn("t_evidence", tokens("evidence"))
        .withColumn("t_tasks", F.array_distinct(task_tokens(F.lower(text("task_id")))))
        .withColumn("bucket", task_bucket())
    )


def _jaccards(a: str, b: str) -> list[Column]:
    return [set_jaccard(F.col(f"{a}.t_{f}"), F.col(f"{b}.t_{f}")) for f in SETS]


def _same(a: str, b: str, column: str) -> Column:
    return F.col(f"{a}.{column}").eqNullSafe(F.col(f"{b}.{column}"))


def _bonus(test: Column, value: float) -> Column:
    return F.when(test, value).otherwise(0.0)


def dedup_similarity(a: str, b: str) -> Column:
    p, s, e = _jaccards(a, b)
    total = p * 0.55 + s * 0.35 + e * 0.10
    for column, value in (("root_cause_type", 0.05), ("experience_type", 0.03), ("bucket", 0.05)):
        total = total + _bonus(_same(a, b, column), value)
    return F.least(F.lit(1.0), total)


def dedup_threshold(a: str, b: str, base: float = 0.52) -> Column:
    root = _same(a, b, "root_cause_type")
    return F.when(_same(a, b, "bucket") & root, max(0.42, base - 0.10)).when(_same(a, b, "experience_type") & root, max(0.48, base - 0.04)).otherwise(base)


def is_duplicate(a: str, b: str) -> Column:
    return dedup_similarity(a, b) >= dedup_threshold(a, b)


def consolidation_score(a: str, b: str) -> Column:
    p, s, e = _jaccards(a, b)
    total = p * 0.5 + s * 0.4 + e * 0.1
    total = total + _bonus(_same(a, b, "root_cause_type"), 0.05) + _bonus(_same(a, b, "experience_type"), 0.05)
    task = lambda x: F.lower(strip(text(f"{x}.task_id")))
    return total + _bonus(task(a) == task(b), 0.05)


def same_task(a: str, b: str) -> Column:
    return F.arrays_overlap(F.col(f"{a}.t_tasks"), F.col(f"{b}.t_tasks"))


def _alike(a: str, b: str, column: str) -> Column:
    return strip(text(f"{a}.{column}")) == strip(text(f"{b}.{column}"))


def merge_similarity(a: str, b: str) -> Column:
    p, s, e = _jaccards(a, b)
    both = (text(f"{a}.evidence") != "") & (text(f"{b}.evidence") != "")
    total = p * 0.52 + s * 0.33 + F.when(both, e).otherwise(0.0) * 0.15
    total = total + _bonus(same_task(a, b), 0.12)
    for column, value in (("root_cause_type", 0.10), ("experience_type", 0.06), ("category", 0.08)):
        total = total + _bonus(_alike(a, b, column), value)
    return F.least(F.lit(1.0), total)


def same_cluster(a: str, b: str) -> Column:
    return _alike(a, b, "root_cause_type") & (same_task(a, b) | _alike(a, b, "experience_type") | (merge_similarity(a, b) >= 0.40))


def group_pairs(df: DataFrame, order: str, group: list[str], weights: tuple[float, float, float], bonuses: list[float], least: float) -> DataFrame:
    """a, b (places, a < b), score of the records of one group whose score is at least so much: the weighted similarities of
    their texts, plus the bonuses of a common group, in this order.

    Rows are dealt by group and only blocks that may share one meet, a block of records with a block."""
    key = F.to_json(F.struct(*group))
    rows = barrier(df.select(F.col(order).alias("place"), key.alias("group"), *(F.col(f"t_{f}").alias(f) for f in SETS)).withColumn("g", F.xxhash64("group")))
    rows = rows.repartition("g").sortWithinPartitions("g", "group", "place")
    # Sorted as the signed hash is; the partition comes first, as groups of two partitions never meet.
    at = F.spark_partition_id().cast("long") * (1 << 48) + F.shiftright("g", 17) + (1 << 46)
    blocks = pack(rows, list(SETS), at, at)

    def fold(a: Block, others: Iterator[Block]) -> Iterator[dict]:
        for b in others:
            met = same(a, b, "group")
            if a.number == b.number:
                met = np.triu(met, 1)
            if not met.any():
                continue
            p, s, e = (jaccard(a, b, f) for f in SETS)
            score = p * weights[0] + s * weights[1] + e * weights[2]
            for value in bonuses:
                score = score + value
            i, j = np.nonzero(met & (score >= least))
            yield {"x": a.numbers("place")[i], "y": b.numbers("place")[j], "score": score[i, j]}

    meets = (F.col("a.block") <= F.col("b.block")) & (F.col("a.low") <= F.col("b.high")) & (F.col("b.low") <= F.col("a.high"))
    met = meet(blocks, blocks, meets, fold, "x long, y long, score double").where("x <> y")
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "score")

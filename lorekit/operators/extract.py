"""Records from segments or whole logs by a model whose answers are a table."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lorekit.functions.text import text
from lorekit.operators import parse
from lorekit.operators.normalize import clamped, extracted_root, extracted_scope, extracted_type
from lorekit.schema import FIELDS, RECORD

SEGMENT_PROMPT = (
    "Read this record of one task and write down at most {budget} lessons that would help with later tasks. Answer with one JSON object "
    '{{"experiences": [...]}}; each entry has id, category, problem, solution, code_pattern, importance, evidence, task_id, experience_type, '
    "root_cause_type, task_scope and confidence. Quote evidence from the record; leave out what it does not show.\n\n"
)
LOG_PROMPT = SEGMENT_PROMPT.replace("this record of one task", "this log").replace("{budget}", "{most}")


class CompletionProvider(Protocol):
    """Anything that answers a prompt; made once in each worker."""

    def complete(self, prompt: str) -> str: ...


def _files(df: DataFrame) -> list[str]:
    return ["source_file", "path"] if "path" in df.columns else ["source_file"]


def segment_prompts(segments: DataFrame) -> DataFrame:
    """source_file (and path), task_id, segment_rank, budget, prompt of the segments that may yield records."""
    head, tail = SEGMENT_PROMPT.replace("{{", "{").replace("}}", "}").split("{budget}")
    prompt = F.concat(F.lit(head), F.col("budget").cast("string"), F.lit(tail), parse.render())
    return segments.where("budget > 0").select(*_files(segments), "task_id", "segment_rank", "budget", prompt.alias("prompt"))


def log_prompts(logs: DataFrame, most: int = 10) -> DataFrame:
    """source_file (and path) and prompt for whole logs: their beginning and what was parsed from them."""
    parsed = parse.legacy(logs)
    digest = F.substring(F.to_json(F.struct("initial_code", "iterations", "final_code", "errors")), 1, 3000)
    head = LOG_PROMPT.replace("{{", "{").replace("}}", "}").replace("{most}", str(most))
    return parsed.select(*_files(logs), F.concat(F.lit(head), F.substring("content", 1, 12000), F.lit("\n\n"), digest).alias("prompt"))


def complete(prompts: DataFrame, factory, partitions: int = 8) -> DataFrame:
    """prompts with response, by a provider made by factory in each of so many tasks; a failed call gives null."""
    schema = T.StructType([*prompts.schema.fields, T.StructField("response", T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = factory()

        def ask(prompt: str) -> str | None:
            try:
                return provider.complete(prompt)
            except Exception:  # noqa: BLE001  one failed call must not end the job; the segment yields nothing
                return None

        for frame in frames:
            yield frame.assign(response=[ask(p) for p in frame["prompt"]])

    return prompts.repartition(partitions).mapInPandas(run, schema)


def hydrate(df: DataFrame) -> DataFrame:
    """Extracted records completed from their segment (column segment_task)."""
    none = F.array().cast("array<string>")
    sure = F.col("confidence").cast("double")
    return (
        df.withColumn("task_id", F.coalesce(F.nullif(F.col("task_id"), F.lit("")), F.col("segment_task")))
        .withColumn("evidence_list", F.when((text("evidence") != "") & (F.size(F.coalesce("evidence_list", none)) == 0), F.array("evidence")).otherwise(F.col("evidence_list")))
        .withColumn("experience_type", extracted_type())
        .withColumn("root_cause_type", extracted_root())
        .withColumn("task_scope", extracted_scope())
        .withColumn("confidence", F.coalesce(clamped(sure), F.when(text("evidence") != "", 0.8).otherwise(0.5)))
        .withColumn("canonical", F.coalesce("canonical", F.lit(True)))
        .drop("segment_task")
    )


def _records(answered: DataFrame, keys: list[str], most: str | None) -> DataFrame:
    rows = answered.select(*_files(answered), "segment_task", *keys, *([most] if most else []), F.posexplode(parse.payload_records(F.col("response"))).alias("item", "r"))
    rows = rows.where(F.col("item") < F.col(most)) if most else rows
    fields = [F.col(f"r.{f}").alias(f) if f != "source_file" else F.col("source_file") for f in FIELDS]
    made = F.coalesce(F.nullif(F.col("r.id"), F.lit("")), F.concat(F.lit("exp_"), F.substring(F.sha2(F.to_json("r"), 256), 1, 8)))
    return hydrate(rows.select(*fields, *_files(rows)[1:], "segment_task", *keys, "item", made.alias("_id"))).withColumn("id", F.col("_id")).drop("_id")


def _answers(rows: DataFrame, responses: DataFrame, by: list[str]) -> DataFrame:
    """rows with the response of each: by file (path, where both have it) and by the given keys; none comes twice."""
    file = "path" if "path" in rows.columns and "path" in responses.columns else "source_file"
    keys = [file, *by]
    answers = responses.where(F.col(file).isNotNull()).groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.min("response").alias("response"))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_{k}"))
    return rows.join(answers, same).drop(*(f"_{k}" for k in keys))


def from_segments(segments: DataFrame, responses: DataFrame) -> DataFrame:
    """Up to budget records of each segment whose answer is in responses (source_file or path, task_id, ord, response).

    ord is the rank of the segment within its log. Answers without one go to the segments of their task in turn: a
    log may name a task twice.
    """
    rows = segments.where("budget > 0").withColumn("task_id", text("task_id"))
    turn = lambda df, order: F.row_number().over(W.partitionBy(*_files(df)[-1:], "task_id").orderBy(order))
    ranked = _answers(rows, responses.where("ord is not null").withColumn("segment_rank", F.col("ord").cast("int")), ["segment_rank"])
    loose = responses.where("ord is null").withColumn("task_id", text("task_id"))
    in_turn = _answers(rows.withColumn("_turn", turn(rows, "segment_rank")), loose.withColumn("_turn", turn(loose, "response")), ["task_id", "_turn"]).drop("_turn")
    both = ranked.unionByName(in_turn.join(ranked.select(*_files(rows)[-1:], "segment_rank"), [*_files(rows)[-1:], "segment_rank"], "left_anti").select(ranked.columns))
    return _records(both.withColumn("segment_task", F.nullif(F.col("task_id"), F.lit(""))), ["segment_rank"], "budget")


def from_logs(logs: DataFrame, responses: DataFrame) -> DataFrame:
    """All records of whole-log answers (source_file or path, response)."""
    rows = _answers(logs, responses, []).withColumn("segment_task", F.lit(None).cast("string")).withColumn("segment_rank", F.lit(0))
    return _records(rows, ["segment_rank"], None)


def extract(logs: DataFrame, responses: DataFrame, by_segment: bool = True) -> DataFrame:
    """Records of all logs in one order (ord): by file, segment and item. Logs without any segment go whole."""
    whole, file = responses.where("prompt_kind = 'log'"), parse.file_key(logs)
    if by_segment:
        parts = parse.segments(logs)
        lone = logs.join(parts.select(file).distinct(), file, "left_anti").select(logs.columns)
        found = from_segments(parts, responses.where("prompt_kind = 'segment'")).unionByName(from_logs(lone, whole))
    else:
        found = from_logs(logs, whole)
    names = _files(logs)
    files = logs.select(*names).distinct().withColumn("file_idx", F.row_number().over(W.orderBy(*names)) - 1)  # a row for each file of a batch
    place = F.col("file_idx").cast("long") * (1 << 40) + F.col("segment_rank").cast("long") * (1 << 20) + F.col("item")
    return found.join(files.select(file, "file_idx"), file).withColumn("ord", place).select(*RECORD.names, "ord")

"""Command line: python -m lorekit.plans.cli --help. Of several jobs named, the first of split, export, merge-spool,
extract-only and full run is done."""

from __future__ import annotations

import argparse
import json
from dataclasses import replace

from pyspark.sql import SparkSession

from lorekit.operators.providers import provider_of
from lorekit.plans.config import EngineConfig, ModelConfig
from lorekit.plans.pipeline import LessonPipeline
from lorekit.schema import RESPONSES
from lorekit.sources import readers


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lorekit")
    p.add_argument("--pool", help="one pool file; without it, --pool-target names which of the two below is used")
    p.add_argument("--core-pool", default="pool_core.json")
    p.add_argument("--extended-pool", default="pool_extended.json")
    p.add_argument("--pool-target", choices=["core", "extended"], default="extended")
    p.add_argument("--logs", help="folder of text logs")
    p.add_argument("--runs", help="folder of run logs")
    p.add_argument("--files", nargs="*", default=[])
    p.add_argument("--responses", help="JSON lines of a model's answers")
    p.add_argument("--whole-logs", action="store_true", help="one prompt for each log instead of one for each segment")
    p.add_argument("--batch-size", type=int, default=5)
    p.add_argument("--max-pool-size", type=int, default=450)
    p.add_argument("--report-folder")
    p.add_argument("--spool", default="spool")
    p.add_argument("--extract-only", action="store_true")
    p.add_argument("--merge-spool", action="store_true")
    p.add_argument("--export", action="store_true")
    p.add_argument("--export-count", type=int, default=20)
    p.add_argument("--split-pool", action="store_true")
    p.add_argument("--output", help="file for the export")
    p.add_argument("--no-intermediate", action="store_true", help="no report files")
    p.add_argument("--max-experiences", type=int, default=10, help="lessons asked for of a whole log")
    p.add_argument("--api-key")
    p.add_argument("--api-base", help="chat endpoint that is asked where --responses isn't given")
    p.add_argument("--model")
    p.add_argument("--verbose", action="store_true")
    return p


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> object:
    a = parser().parse_args(args)
    spark = spark or SparkSession.builder.appName("lorekit").getOrCreate()
    answers = spark.read.schema(RESPONSES).json(a.responses) if a.responses else None
    pool = a.pool or (a.core_pool if a.pool_target == "core" else a.extended_pool)
    config = EngineConfig(
        pool_path=pool, max_pool_size=a.max_pool_size, max_per_log=a.max_experiences, file_batch=a.batch_size, by_segment=not a.whole_logs,
        report_folder=None if a.no_intermediate else a.report_folder, verbose=a.verbose,
    )
    engine = LessonPipeline(spark, config, answers)
    if a.split_pool:
        return engine.split(a.core_pool, a.extended_pool)
    if a.export:
        return engine.export(a.export_count, a.output)
    if a.merge_spool:
        return engine.merge_spool(a.spool)
    files = [*a.files, *(readers.run_files(a.runs) if a.runs else []), *(readers.log_files(a.logs) if a.logs else [])]
    if answers is None:
        given = {k: v for k, v in (("api_key", a.api_key), ("api_base", a.api_base), ("model", a.model)) if v}
        engine = engine.ask(files, provider_of(replace(ModelConfig.from_env(), **given)))
    return engine.extract_to_spool(files, a.spool) if a.extract_only else engine.process(files)


if __name__ == "__main__":
    out = main()
    print(out if isinstance(out, str) else json.dumps(out, ensure_ascii=False, indent=2))

"""The engine's jobs: extract, spool, merge, export, split."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lorekit.operators import cluster, extract, merge, parse, quality
from lorekit.operators.normalize import normalize
from lorekit.plans.config import EngineConfig
from lorekit.schema import FIELDS
from lorekit.sources import readers, sinks


@dataclass
class LessonPipeline:
    """A pool file and the jobs that change it. responses: the model's answers (see lorekit.schema.RESPONSES)."""

    spark: SparkSession
    config: EngineConfig = field(default_factory=EngineConfig)
    responses: DataFrame | None = None

    def pool(self) -> DataFrame:
        return readers.read_pool(self.spark, self.config.pool_path)

    def prompts(self, files: list[str]) -> DataFrame:
        """prompt_kind, source_file, path, task_id, ord, prompt: what a model is asked about a batch of files."""
        logs = readers.whole_files(self.spark, files)
        parts = parse.segments(logs)
        none = F.lit(None)
        whole = logs if not self.config.by_segment else logs.join(parts.select("path").distinct(), "path", "left_anti").select(logs.columns)
        asked = extract.log_prompts(whole, self.config.max_per_log).select(F.lit("log").alias("prompt_kind"), "source_file", "path", none.cast("string").alias("task_id"), none.cast("long").alias("ord"), "prompt")
        if self.config.by_segment:
            own = extract.segment_prompts(parts).select(F.lit("segment").alias("prompt_kind"), "source_file", "path", "task_id", F.col("segment_rank").cast("long").alias("ord"), "prompt")
            asked = own.unionByName(asked)
        return asked

    def merge_prompts(self, new: DataFrame) -> DataFrame:
        """ord, prompt for the records of new that no rule decides against the pool as it is."""
        return merge.prompts(new, normalize(self.pool()))

    def ask(self, files: list[str], provider) -> LessonPipeline:
        """This pipeline with a model's answers about the files; provider: a factory, see extract.complete()."""
        return replace(self, responses=extract.complete(self.prompts(files), provider).drop("prompt").persist())

    def extract_batch(self, files: list[str]) -> tuple[DataFrame, DataFrame]:
        """Candidates of a batch of files, consolidated and deduplicated, and the audit of the steps."""
        if self.responses is None:
            raise ValueError("answers of a model are needed: a table, or extract.complete() on the prompts")
        raw = extract.extract(readers.whole_files(self.spark, files), self.responses, self.config.by_segment)
        prepared = quality.prepare(raw)
        consolidated = cluster.consolidate(prepared).drop("n_members", "leader_rank")
        final = cluster.dedup(consolidated).drop("n_members", "leader_rank")
        return final, cluster.audit(raw=raw, prepared=prepared, consolidated=consolidated, final=final)

    def merge(self, new: DataFrame) -> dict:
        """Merge records (with ord) into the pool file, under a lock that also covers reading it."""
        with sinks.exclusive(sinks.lock_of(self.config.pool_path)):
            pool = normalize(self.pool())
            if not pool.take(1):
                # An empty pool takes every record, without gate or cap.
                last = W.partitionBy("id").orderBy(F.desc("ord"))
                rows = new.withColumn("_n", F.row_number().over(last)).where("_n = 1").select(*FIELDS, F.col("ord").alias("pos"))
                return {"inserted": sinks.save_pool(rows, self.config.pool_path)}
            answers = None if self.responses is None else self.responses.where("prompt_kind = 'merge'").select("ord", "response")
            decisions = merge.decide(new, pool, answers).persist()
            try:
                counts = {r["action"].lower(): r["n"] for r in decisions.groupBy("op.action").agg(F.count(F.lit(1)).alias("n")).collect()}
                after = quality.cap(merge.apply_operations(pool, decisions), self.config.max_pool_size)
                return counts | {"pool": sinks.save_pool(after, self.config.pool_path)}
            finally:
                decisions.unpersist()

    def process(self, files: list[str]) -> list[dict]:
        """Each batch of files extracted and merged before the next one."""
        out = []
        for i, batch in enumerate(readers.batches(files, self.config.file_batch)):
            new, audit = self.extract_batch(batch)
            audit = [r.asDict() for r in audit.collect()]
            self._report(f"extracted_{i}.json", {"files": batch, "audit": audit}, new)
            merged = self.merge(new)
            self._report(f"merge_{i}.json", merged)
            out.append({"batch": i, "files": batch, "audit": audit, "merge": merged})
            self._report(f"batch_{i}.json", out[-1])
        self._report("final_report.json", {"batches": out})
        return out

    def _report(self, name: str, value: dict, records: DataFrame | None = None) -> None:
        """A report in the folder for them, if there is one; with the records of a batch of files."""
        if self.config.verbose:
            print(name, value)
        if self.config.report_folder:
            rows = [] if records is None else records.select("ord", F.to_json(F.struct(*FIELDS)).alias("j")).orderBy("ord").toLocalIterator()
            extra = {} if records is None else {"experiences": [json.loads(r.j) for r in rows]}
            sinks.save_json(f"{self.config.report_folder}/{name}", value | extra | {"timestamp": datetime.now(timezone.utc).isoformat()})

    def extract_to_spool(self, files: list[str], folder: str) -> list[str]:
        made = [sinks.write_spool(self.extract_batch(b)[0], folder, sinks.run_id(b[0])) for b in readers.batches(files, self.config.file_batch)]
        return [m for m in made if m]

    def merge_spool(self, folder: str) -> dict:
        """Merge all waiting spool files; they are moved only after the pool is written, and stay if none has a record."""
        files = readers.spool_files(folder)
        if not files:
            return {"files": 0}
        rows, bad = readers.read_spool(self.spark, files)
        invalid = bad.first()["invalid_lines"]
        if not rows.take(1):
            return {"files": len(files), "invalid_lines": invalid, "merged": False}
        result = self.merge(rows)
        sinks.archive(files)
        return {"files": len(files), "invalid_lines": invalid, "merged": True} | result

    def export(self, n: int = 20, path: str | None = None) -> str:
        out = quality.export_text(self.pool(), n)
        if path:
            sinks.publish(path, out)
        return out

    def split(self, core: str, extended: str) -> dict:
        return sinks.save_split(readers.read_any_pool(self.spark, self.config.pool_path), core, extended, self.config.pool_path)

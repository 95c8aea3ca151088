"""A query for each operator of the engine, over whole tables."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lorekit.functions import text as X
from lorekit.operators import cluster, extract, merge, parse, quality, tier
from lorekit.operators import similarity as S
from lorekit.operators.blocks import written
from lorekit.operators.jaccard_join import similar_pairs
from lorekit.operators.normalize import normalize, task_bucket
from lorekit.operators.pool import Pool
from lorekit.plans import oracle
from lorekit.plans.fixtures import ANSWERS, CANDIDATES, RUN_LOGS, SEGMENTS
from lorekit.schema import FIELDS, as_records, barrier
from lorekit.sources import readers, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = CANDIDATES.replace("FROM documents d", "FROM {documents} d")
    return as_records(spark.sql(sql, documents=table(spark, sf_dir, "documents")))


def segment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = SEGMENTS.replace("FROM conversations c", "FROM {conversations} c")
    rows = spark.sql(sql, conversations=table(spark, sf_dir, "conversations"))
    severities = F.when(F.col("severity").isNull(), F.array().cast("array<string>")).otherwise(F.array(F.lower("severity")))
    return rows.withColumn("severities", severities).withColumn("n_sc_errors", F.size("severities"))


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(candidates(spark, sf_dir))


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.prepare(candidates(spark, sf_dir))


def _column(name: str, column: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: normalize(candidates(spark, sf_dir), (column,)).select("ord", column)


for _name, _c in {
    "category_normalize": "category", "id_normalize": "id", "importance_normalize": "importance", "type_infer": "experience_type", "root_cause_infer": "root_cause_type",
    "scope_infer": "task_scope", "confidence_normalize": "confidence",
}.items():
    _column(_name, _c)


@query
def evidence_list_normalize(spark, sf_dir):
    return normalize(candidates(spark, sf_dir), ("evidence_list",)).select("ord", F.array_join("evidence_list", "|").alias("evidence_list"))


QUERIES["task_bucket"] = lambda spark, sf_dir: normalize(candidates(spark, sf_dir), ("task_scope", "task_id")).select("ord", task_bucket().alias("bucket"))
QUERIES["quality_gate"] = lambda spark, sf_dir: normalized(spark, sf_dir).select("ord", (quality.gate() == quality.PASS).alias("passes"))
QUERIES["quality_gate_reasons"] = lambda spark, sf_dir: cluster.gate_reasons(candidates(spark, sf_dir))
QUERIES["quality_score"] = lambda spark, sf_dir: normalized(spark, sf_dir).select("ord", F.round(quality.quality_score(), 9).alias("quality"))


@query
def quality_topn(spark, sf_dir):
    return quality.export_lines(candidates(spark, sf_dir), 20, "ord").withColumn("quality", F.round("quality", 9))


@query
def pool_cap(spark, sf_dir):
    return quality.cap(normalized(spark, sf_dir), 450, "ord").select("ord", "id")


@query
def tier_classify(spark, sf_dir):
    return normalized(spark, sf_dir).select("ord", tier.tier().alias("t")).select("ord", "t.tier", "t.reason")


@query
def tier_reasons(spark, sf_dir):
    return normalized(spark, sf_dir).groupBy(tier.tier().getField("reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query
def type_counts(spark, sf_dir):
    return cluster.count_by_type(normalize(candidates(spark, sf_dir), ("experience_type",)))


@query
def candidate_audit(spark, sf_dir):
    return cluster.audit(normalized=normalized(spark, sf_dir), prepared=prepared(spark, sf_dir))


@query
def jaccard_pairs(spark, sf_dir):
    return similar_pairs(table(spark, sf_dir, "documents"), "doc_id", "text", 0.42).withColumn("jaccard", F.round("jaccard", 9))


def _group_pairs(spark, sf_dir, keys: list[str], *rule) -> DataFrame:
    rows = S.with_tokens(prepared(spark, sf_dir)).withColumn("task", X.lowered("task_id"))
    return S.group_pairs(rows, "ord", [*keys, "experience_type", "root_cause_type"], *rule)


@query
def dup_pairs(spark, sf_dir):
    pairs = _group_pairs(spark, sf_dir, ["bucket"], (0.55, 0.35, 0.10), [0.05, 0.03, 0.05], max(0.42, 0.52 - 0.10))
    return pairs.select("a", "b", F.round(F.least(F.lit(1.0), "score"), 9).alias("similarity"))


@query
def consolidate_pairs(spark, sf_dir):
    return _group_pairs(spark, sf_dir, ["task"], (0.5, 0.4, 0.1), [0.05, 0.05, 0.05], 0.46).withColumn("score", F.round("score", 9))


def _leaders(df: DataFrame) -> DataFrame:
    return df.select("ord", "id", "n_members", "leader_rank", F.array_join("merged_from", ",").alias("merged_from"), F.size("evidence_list").alias("n_evidence"))


@query
def consolidate(spark, sf_dir):
    return _leaders(cluster.consolidate(prepared(spark, sf_dir)))


@query
def dedup(spark, sf_dir):
    return _leaders(cluster.dedup(prepared(spark, sf_dir)))


def _halves(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rows = candidates(spark, sf_dir)
    return quality.prepare(rows.where("ord % 2 = 0")), quality.prepare(rows.where("ord % 2 = 1")).withColumn("pos", F.col("ord"))


@query
def candidate_recall(spark, sf_dir):
    found = merge.candidates(*_halves(spark, sf_dir))
    return found.select(F.col("n").alias("new_ord"), F.col("o").alias("old_ord"), "rank", F.round("sim", 9).alias("sim"), "same_task", "same_cluster")


@query
def merge_decide(spark, sf_dir):
    rows = merge.decide(*_halves(spark, sf_dir))
    return rows.select("ord", "new_id", "best_id", F.round("sim", 9).alias("sim"), "op.action", F.array_join("op.target_ids", ",").alias("targets"), "op.record.id", "op.reason")


@query
def apply_ops(spark, sf_dir):
    new, pool = _halves(spark, sf_dir)
    return merge.apply_operations(pool, merge.decide(new, pool)).select("key", "pos", "experience_type", F.array_join("merged_from", ",").alias("merged_from"))


@query
def segment_priority(spark, sf_dir):
    return segment_rows(spark, sf_dir).select("ord", parse.priority().cast("long").alias("priority_score"))


@query
def segment_budget(spark, sf_dir):
    return segment_rows(spark, sf_dir).select("ord", parse.budget().alias("budget"))


@query
def clean_pass(spark, sf_dir):
    return segment_rows(spark, sf_dir).select("ord", parse.clean_pass().alias("clean_pass"))


@query
def status_counts(spark, sf_dir):
    return parse.status_counts(segment_rows(spark, sf_dir).withColumn("status", F.when(F.col("passornot"), "pass").otherwise("failed")))


@query
def code_excerpt(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.excerpt("text").alias("excerpt"))


@query
def truncate_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.truncate("text").alias("short"))


@query
def json_props(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_type", F.from_json("props", "k long")["k"].alias("k"))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("total"))


@query
def code_blocks(spark, sf_dir):
    """Three blocks around each text, two of one language."""
    fenced = F.concat(F.lit("before\n```python\n"), "text", F.lit("\n```\nbetween ```c\nint x;\n``` and ```python\n"), F.col("role"), F.lit("\n``` after"))
    every, own = X.code_blocks(fenced), X.code_blocks(fenced, "python")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.size(every).alias("n_blocks"), F.posexplode(own).alias("k", "block"))


@query
def responses(spark, sf_dir):
    """A legacy log for each conversation: first and last answer, and how many there are."""
    logs = legacy_logs(spark, sf_dir)
    return logs.select("conv_id", F.size(parse.responses()).alias("n"), F.get(parse.responses(), F.lit(0)).alias("first"), F.get(parse.responses(), F.size(parse.responses()) - 1).alias("last"))


def legacy_logs(spark, sf_dir) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    said = F.transform("t", lambda x: F.concat(F.lit('<analysis title="第'), (x["turn"] + 1).cast("string"), F.lit('次优化"> plan ```\n<log>@@response</log>'), x["text"], F.lit("<log>@@endresponse</log>\nerror: bad "), x["turn"].cast("string"), F.lit("\n\nCN_INVOKE_ERROR 7\n")))
    return turns.select("conv_id", F.concat(F.lit("run_"), "conv_id", F.lit(".log")).alias("source_file"), F.array_join(said, "").alias("content"))


@query
def legacy_parse(spark, sf_dir):
    rows = parse.legacy(legacy_logs(spark, sf_dir))
    each = F.transform("iterations", lambda i: F.concat(i["iteration"].cast("string"), F.lit(":"), i["has_code"].cast("string")))
    found = F.transform("errors", lambda e: F.concat(e["type"], F.lit(":"), e["message"]))
    return rows.select("conv_id", "initial_code", "final_code", F.array_join(each, ",").alias("iterations"), F.array_join(found, ",").alias("errors"))


def _from_conversations(spark, sf_dir, sql: str) -> DataFrame:
    sql = sql.replace("{", "{{").replace("}", "}}").replace("FROM conversations", "FROM {conversations}")
    return spark.sql(sql, conversations=table(spark, sf_dir, "conversations"))


def run_logs(spark, sf_dir) -> DataFrame:
    return _from_conversations(spark, sf_dir, RUN_LOGS)


def answers(spark, sf_dir) -> DataFrame:
    rows = _from_conversations(spark, sf_dir, ANSWERS)
    return rows.select(F.lit("segment").alias("prompt_kind"), "source_file", F.lit(None).cast("string").alias("task_id"), "ord", "response")


@query
def log_segments(spark, sf_dir):
    rows = parse.segments(run_logs(spark, sf_dir))
    return rows.select(
        "source_file", "task_idx", "task_id", "question", "status", "passornot", "iterations", "error_count", "n_sc_errors", "n_suggestions", "feedback", "verification_detail", "code_unchanged", "has_task_error", "task_time_seconds",
        "final_code", "priority_score", "budget", "segment_rank", F.get("severities", F.lit(0)).alias("severity"),
    )


@query
def segment_prompts(spark, sf_dir):
    rows = extract.segment_prompts(parse.segments(run_logs(spark, sf_dir)))
    return rows.select("source_file", "segment_rank", F.substring_index("prompt", "=== Task: ", -1).alias("shown"))


@query
def log_summary(spark, sf_dir):
    rows = parse.summary(run_logs(spark, sf_dir))
    kinds = F.array_join(F.transform("errors", lambda e: F.concat(e["type"], F.lit("/"), e["message"])), ",")
    return rows.select("source_file", "task_count", "iterations", "status", "task_id", "feedback", "final_code", kinds.alias("errors"))


@query
def payload_ladder(spark, sf_dir):
    rows = answers(spark, sf_dir).select("source_file", "ord", F.posexplode(parse.payload_records(F.col("response"))).alias("item", "r"))
    return rows.select("source_file", "ord", "item", "r.id", "r.category", "r.problem", "r.evidence", "r.confidence", "r.importance")


@query
def extract_records(spark, sf_dir):
    rows = extract.extract(run_logs(spark, sf_dir).select("source_file", "content"), answers(spark, sf_dir))
    place = F.col("ord").bitwiseAND(F.lit((1 << 40) - 1))
    return rows.select("source_file", place.alias("place"), "id", "task_id", "experience_type", "root_cause_type", "task_scope", "confidence", F.size("evidence_list").alias("n_evidence"), "canonical")


def _shared(spark, name: str) -> str:
    """A new folder that executors reach too: under spark.checkpoint.dir, or a temporary one on a single machine."""
    root = spark.conf.get("spark.checkpoint.dir", None) or f"file://{tempfile.mkdtemp(prefix='lorekit-')}"
    return f"{root.rstrip('/')}/lorekit-{name}-{uuid.uuid4().hex}"


@query
def spool_roundtrip(spark, sf_dir):
    """Prepared records written as spool files and read back, with lines that are no JSON."""
    folder = _shared(spark, "spool")
    lines = prepared(spark, sf_dir).select("ord", F.to_json(F.struct(*FIELDS)).alias("value"))
    broken = F.when(F.col("ord") % 10 == 0, F.concat(F.lit("{broken "), "value"))
    lines = written(lines.select("ord", F.explode(F.array_compact(F.array("value", broken))).alias("value")), "lines")  # computed once, whoever samples it
    files = max(5, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lines.repartitionByRange(files, "ord").sortWithinPartitions("ord", "value").select("value").write.text(folder)
    rows, bad = readers.read_spool(spark, [folder])
    # Lines are numbered file by file, after those of the files before: no task sees the lines of all.
    rows = rows.withColumn("file", F.shiftright("ord", 40))
    sizes = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("file", (F.sum("n").over(W.orderBy("file")) - F.col("n")).alias("before"))  # a row for each file
    line = F.row_number().over(W.partitionBy("file").orderBy("ord")) + F.col("before")
    rows = rows.join(F.broadcast(before), "file").select(line.cast("int").alias("line"), "id", "category", "problem", "solution", "evidence", "confidence")
    return rows.crossJoin(F.broadcast(bad))  # one row


@query
def pool_roundtrip(spark, sf_dir):
    """The best records as a pool file, written and read back with the places of their entry."""
    best = quality.cap(normalized(spark, sf_dir), 450, "ord")
    folder = tempfile.mkdtemp(prefix="lorekit-")  # the driver's own: a pool file is one small file
    sinks.save_pool(best, f"{folder}/pool.json", False, None, "ord")
    rows = [json.loads(x) for x in Pool.of(readers.read_pool(spark, f"{folder}/pool.json")).get_all().toJSON().collect()]  # 450 at most
    return spark.createDataFrame([(r["pos"], r["id"], r["importance"], r.get("confidence")) for r in rows], "pos long, id string, importance string, confidence double")


@query
def merge_prompts(spark, sf_dir):
    """How many candidates each undecided record is shown with."""
    rows = merge.prompts(*_halves(spark, sf_dir))
    return rows.select("ord", (F.size(F.split("prompt", '"solution":')) - 2).alias("n_candidates"))


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best lessons, as they enter a prompt."""
    return quality_topn(spark, sf_dir)


ORACLE_SQL: dict[str, str] = {k: v for k, v in oracle.SQL.items() if v and k in QUERIES}

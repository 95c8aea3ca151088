"""Run logs and model answers to structs and rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lorekit.functions.text import any_in, code_blocks, excerpt, module_code, safe_double, strip, text, unfence
from lorekit.schema import LOOSE, RECORD, RUN_LOG, TASK, typed

SEVERE, NOTABLE = ["high", "critical"], ["medium", "high", "critical"]
FAILURES = ["compile error", "simulation error", "function error", "mismatch", "timeout", "failed"]
FEEDBACK_CUES = ["logic", "compile", "simulation", "mismatch", "warning"]


#: Marks and patterns of the logs.
RESPONSE = "(?s)<log>@@response</log>(.*?)<log>@@endresponse</log>"
SECTION = '(?s)<analysis title="第(\\d+)次优化">(.*?)(?=<analysis title="|### 编译错误|\\z)'
ERROR_KINDS = (
    ("compile_error", r"(?s)error:(.*?)(?=\n\n|\n[a-zA-Z])", 1),
    ("runtime_error", r"(?s)EXCEPTION_ERROR.*?(?=\n\n|\n[a-zA-Z])", 0),
    ("runtime_error", r"(?s)CN_INVOKE_ERROR.*?(?=\n|\z)", 0),
)
STRING_OR_NOT = r'(?s)"(?:\\.|[^"\\])*"?|[^"]+'
LOOSE_OBJECT = r'(?s)\{\s*"id"\s*:\s*".*?"\s*\}'


def responses(c: str = "content") -> Column:
    return F.regexp_extract_all(text(c), F.lit(RESPONSE), F.lit(1))


def iterations(c: str = "content") -> Column:
    """Of each optimisation section its number, stripped text, and whether it holds a code fence."""
    both = F.arrays_zip(*(F.regexp_extract_all(text(c), F.lit(SECTION), F.lit(g)).alias(n) for g, n in ((1, "iteration"), (2, "body"))))
    return F.transform(both, lambda x: F.struct(x["iteration"].cast("int").alias("iteration"), strip(x["body"]).alias("content"), x["body"].contains("```").alias("has_code")))


def errors(c: str = "content") -> Column:
    """Errors by kind of pattern, not by place."""

    def found(kind: str, regex: str, group: int) -> Column:
        return F.transform(F.regexp_extract_all(text(c), F.lit(regex), F.lit(group)), lambda m: F.struct(F.lit(kind).alias("type"), strip(m).alias("message")))

    return F.concat(*(found(*k) for k in ERROR_KINDS))


def legacy(logs: DataFrame, c: str = "content") -> DataFrame:
    """Text logs with initial_code, iterations, final_code, errors."""
    logs = logs.withColumn("_r", responses(c))
    ends = {"initial_code": F.coalesce(F.get("_r", F.lit(0)), F.lit("")), "final_code": F.coalesce(F.get("_r", F.size("_r") - 1), F.lit(""))}
    return logs.withColumns(ends | {"iterations": iterations(c), "errors": errors(c)}).drop("_r")


def _log(c: str) -> Column:
    return F.from_json(text(c), RUN_LOG)


def _valid(c: str) -> Column:
    return F.try_parse_json(text(c)).isNotNull()


def tasks(logs: DataFrame, c: str = "content", bare: bool = True) -> DataFrame:
    """A row for each task: the log's columns, task_idx and task. bare: a lone task object counts as a list of one."""
    logs = logs.withColumn("_log", _log(c))
    one = F.array(F.struct(*(F.col(f"_log.{f}").alias(f) for f in TASK.names)))
    listed = F.coalesce("_log.tasks", F.array().cast(RUN_LOG["tasks"].dataType))
    many = F.when((F.size(listed) == 0) & F.lit(bare) & F.col("_log.task_id").isNotNull(), one.cast(RUN_LOG["tasks"].dataType)).otherwise(listed)
    return logs.select(*[x for x in logs.columns if x != "_log"], F.posexplode(many).alias("task_idx", "task"))


def _items(c: Column, kind: str) -> Column:
    return F.coalesce(c, F.array().cast(kind))


ERRORS = "array<struct<type:string,description:string,message:string,severity:string>>"


def detail_lines(verification: Column) -> Column:
    lines = F.transform(F.map_entries(verification), lambda e: F.concat(F.lit("["), e["key"], F.lit("] type="), text(e["value"]["result"]["type"]), F.lit(", detail="), text(e["value"]["result"]["detail"])))
    return F.coalesce(F.array_join(lines, "\n"), F.lit(""))


def segments(logs: DataFrame, c: str = "content") -> DataFrame:
    """Tasks as segments, with priority_score, budget and segment_rank within their log (best first, stable)."""
    fr, check = F.col("task.final_result"), F.col("task.final_result.check_result")
    said = F.from_json("task.error", "struct<type:string,message:string>")
    objected = F.coalesce(F.col("task.error").startswith("{") & (F.col("task.error") != "{}"), F.lit(False))
    agent = F.struct(F.coalesce(F.nullif(said["type"], F.lit("")), F.lit("agent_error")).alias("type"), F.coalesce(F.nullif(said["message"], F.lit("")), F.col("task.error")).alias("description"), F.lit(None).cast("string").alias("message"), F.lit(None).cast("string").alias("severity"))
    audits = F.filter(F.coalesce(F.col("task.phases"), F.array().cast(TASK["phases"].dataType)), lambda p: p["phase"] == "self_correction_audit")
    rows = tasks(logs, c).withColumn("_audit", F.get(audits, F.size(audits) - 1))
    listed = _items(check["errors"], ERRORS)
    rows = rows.withColumns({
        "task_id": text("task.task_id"), "question": text("task.question"),
        "status": F.when(objected & fr.isNull(), "error").otherwise(F.coalesce(fr["status"], F.lit("unknown"))),
        "passornot": F.coalesce(check["passornot"], F.lit(False)),
        "iterations": F.coalesce(F.nullif(fr["iterations"], F.lit(0)), F.nullif(F.col("task.metrics.iterations"), F.lit(0)), F.lit(0)),
        "errors": F.when(objected, F.concat(listed, F.array(agent).cast(ERRORS))).otherwise(listed),
        "feedback": text(check["feedback"]), "suggestions": _items(check["suggestions"], "array<string>"),
        "verification_detail": detail_lines(check["verification"]), "final_output": text(fr["final_output"]),
        "sc_errors": _items(F.col("_audit.data.errors_found"), ERRORS), "code_unchanged": F.col("_audit.data.code_unchanged"),
        "has_task_error": objected, "task_time_seconds": F.coalesce("task.metrics.total_time_seconds", F.lit(0.0)),
    })
    rows = rows.drop("_audit", "task").withColumn("n_errors", F.size("errors")).withColumn("n_sc_errors", F.size("sc_errors")).withColumn("n_suggestions", F.size("suggestions"))
    rows = rows.withColumn("severities", F.transform("sc_errors", lambda e: F.lower(strip(text(e["severity"])))))
    rows = rows.withColumn("error_count", F.col("n_errors") + F.col("n_sc_errors")).withColumn("priority_score", priority()).withColumn("budget", budget())
    rows = rows.withColumn("final_code", module_code("final_output")).withColumn("agent_error", F.when(F.col("has_task_error"), F.element_at("errors", -1)))
    order = W.partitionBy(file_key(logs)).orderBy(F.desc("priority_score"), "task_idx")
    return rows.withColumn("segment_rank", F.row_number().over(order) - 1)


def file_key(df: DataFrame) -> str:
    """What tells files apart: the path, or where there is none the name, which may repeat in other folders."""
    return "path" if "path" in df.columns else "source_file"


def _points(test: Column, value: int | Column) -> Column:
    return F.when(test, value).otherwise(0)


def priority() -> Column:
    detail, feedback = F.lower(text("verification_detail")), F.lower(text("feedback"))
    n, k, i, t = F.col("n_errors"), F.col("n_sc_errors"), F.col("iterations"), F.col("task_time_seconds")
    return (
        _points(F.col("has_task_error"), 80)
        + _points(~F.col("passornot"), 100)
        + _points(any_in(detail, FAILURES[:2]), 60)
        + _points(n > 0, 40 + 10 * n)
        + _points(k > 0, 25 + 5 * k)
        + _points(i >= 2, 15)
        + _points(i >= 4, 15)
        + _points(t > 180, 10)
        + _points(t > 300, 10)
        + _points(F.col("code_unchanged") == F.lit(False), 10)
        + _points(F.col("n_suggestions") > 0, 5)
        + _points(any_in(feedback, FEEDBACK_CUES), 10)
    )


def failure_signal() -> Column:
    return any_in(F.lower(text("verification_detail")), FAILURES)


def has_severity(levels: list[str]) -> Column:
    return F.exists("severities", lambda s: s.isin(*levels))


def clean_pass() -> Column:
    return F.col("passornot") & (F.col("n_errors") == 0) & (F.col("n_sc_errors") == 0) & ~F.col("has_task_error") & ~failure_signal()


def budget() -> Column:
    """How many records a segment may yield."""
    failed = F.when(has_severity(SEVERE) | failure_signal(), 2).otherwise(1)
    passed = F.when((F.col("n_errors") > 0) | has_severity(NOTABLE) | failure_signal(), 1).otherwise(0)
    return F.when(clean_pass(), 0).when(F.col("has_task_error"), 2).when(~F.col("passornot"), failed).otherwise(passed)


def summary(logs: DataFrame, file: str | None = None, c: str = "content") -> DataFrame:
    """A row for each run log: counts, first outputs, all errors, and the status that takes precedence."""
    file = file or file_key(logs)
    rows = tasks(logs, c, bare=False)
    check, ver = F.col("task.final_result.check_result"), F.map_entries("task.final_result.check_result.verification")
    own, none = F.col("task.task_id"), F.lit(None).cast("string")
    entry = lambda t, m, tool: F.struct(text(own).alias("task_id"), t.alias("type"), m.alias("message"), tool.alias("tool"))
    listed = F.transform(_items(check["errors"], ERRORS), lambda e: entry(F.coalesce(e["type"], F.lit("unknown")), text(e["description"]), none))
    tools = F.filter(F.coalesce(ver, F.array().cast("array<struct<key:string,value:struct<result:struct<type:string,detail:string>>>>")), lambda e: e["value"]["result"]["type"].isin("compile error", "simulation error"))
    checked = F.transform(tools, lambda e: entry(F.translate(e["value"]["result"]["type"], " ", "_"), text(e["value"]["result"]["detail"]), e["key"]))
    passed = F.coalesce(F.exists(ver, lambda e: e["value"]["result"]["type"] == "pass"), F.lit(False))
    rows = rows.select(file, "task_idx", text(own).alias("task_id"), F.coalesce("task.final_result.iterations", F.lit(0)).alias("iterations"), F.concat(listed, checked).alias("errors"), F.when(passed, "pass").otherwise(F.coalesce("task.final_result.status", F.lit("unknown"))).alias("status"), text("task.final_result.final_output").alias("code"), text(check["feedback"]).alias("feedback"))
    first = lambda x: F.coalesce(F.min_by(x, F.when(F.col(x) != "", F.col("task_idx"))), F.lit(""))
    in_order = F.array_sort(F.collect_list(F.struct("task_idx", "task_id", "iterations", "status", "errors")))
    got = rows.groupBy(file).agg(F.count(F.lit(1)).alias("task_count"), F.max("iterations").alias("iterations"), first("code").alias("final_code"), first("feedback").alias("feedback"), first("task_id").alias("task_id"), in_order.alias("tasks"), F.collect_set("status").alias("_states"))
    out = logs.select(file, _valid(c).alias("_valid")).join(got, file, "left")
    states = F.coalesce("_states", F.array().cast("array<string>"))
    status = F.lit("unknown")
    for s in ("pass", "completed", "failed"):
        status = F.when(F.array_contains(states, s), s).otherwise(status)
    errors_of = F.flatten(F.transform("tasks", lambda t: t["errors"]))
    bad = F.array(F.struct(F.lit("").alias("task_id"), F.lit("parse_error").alias("type"), F.lit("not JSON").alias("message"), none.alias("tool")))
    return out.select(file, *(F.coalesce(x, F.lit("")).alias(x) for x in ("task_id", "final_code", "feedback")), *(F.coalesce(x, F.lit(0)).alias(x) for x in ("task_count", "iterations")), status.alias("status"), F.when(~F.col("_valid"), bad).otherwise(F.coalesce(errors_of, F.array().cast(bad_type()))).alias("errors"), "tasks")


def bad_type() -> str:
    return "array<struct<task_id:string,type:string,message:string,tool:string>>"


def status_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def repair_newlines(c: Column) -> Column:
    """Raw line breaks inside JSON strings escaped, carriage returns there dropped; quotes and escapes are honoured."""
    parts = F.regexp_extract_all(c, F.lit(STRING_OR_NOT), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.when(p.startswith('"'), F.replace(F.replace(p, F.lit("\r"), F.lit("")), F.lit("\n"), F.lit("\\n"))).otherwise(p)), "")


PAYLOAD = f"experiences array<{LOOSE.simpleString()}>"


def loose_records(c: Column) -> Column:
    """Records scraped from text that is no JSON: objects that begin with an id and end with a string."""
    blocks = F.regexp_extract_all(c, F.lit(LOOSE_OBJECT), F.lit(0))
    grab = lambda b, k: F.nullif(strip(F.regexp_extract(b, rf'(?s)"{k}"\s*:\s*"(.*?)"', 1)), F.lit(""))
    default = {"id": "unknown", "category": "unknown", "importance": "medium"}

    def record(b: Column) -> Column:
        out = []
        for f in RECORD.fields:
            if f.name == "confidence":
                value = safe_double(grab(b, f.name))
            elif f.name in ("source_file", "canonical", "evidence_list", "merged_from"):
                value = F.lit(None).cast(f.dataType)
            else:
                value = grab(b, f.name)
                value = F.coalesce(value, F.lit(default[f.name])) if f.name in default else value
            out.append(value.alias(f.name))
        return F.struct(*out)

    return F.filter(F.transform(blocks, record), lambda r: r["problem"].isNotNull() & r["solution"].isNotNull())


def payload_records(response: Column) -> Column:
    """Records of an answer: as it stands, with line breaks repaired, or scraped."""
    s = unfence(response)
    strictly = lambda x: F.when(F.try_parse_json(x).isNotNull(), F.transform(F.coalesce(F.from_json(x, PAYLOAD)["experiences"], F.array().cast(f"array<{LOOSE.simpleString()}>")), typed))
    return F.coalesce(strictly(s), strictly(repair_newlines(s)), loose_records(s))


def render(full: bool = False) -> Column:
    """A segment as text for a prompt: with an excerpt of the code found in its output, else of the output; full: with all
    of it, the agent's error and the suggestions."""
    lines = lambda a, f: F.array_join(F.transform(a, f), "\n")
    part = lambda title, body: F.when(body != "", F.concat(F.lit(f"\n--- {title} ---\n"), body))
    kind = lambda e: F.concat(F.lit("  ["), F.coalesce(e["type"], F.lit("?")), F.lit("] "))
    head = F.concat(F.lit("=== Task: "), text("task_id"), F.lit(" ===\nStatus: "), text("status"), F.lit(" | Pass: "), F.initcap(F.col("passornot").cast("string")), F.lit(" | Iterations: "), F.col("iterations").cast("string"), F.lit(" | Priority: "), F.col("priority_score").cast("string"))
    audit = lines("sc_errors", lambda e: F.concat(kind(e), F.lit("(severity="), F.coalesce(e["severity"], F.lit("?")), F.lit(") "), text(e["description"])))
    found = F.nullif(text("final_code"), F.lit(""))
    failed = part("Agent Error", F.when(F.col("agent_error").isNotNull(), F.concat(F.lit("  Type: "), F.coalesce("agent_error.type", F.lit("?")), F.lit("\n  Message: "), F.coalesce("agent_error.description", F.lit("?")))).otherwise(""))
    if full:
        code = F.coalesce(part("Final Code", F.coalesce(found, F.lit(""))), part("Final Output", text("final_output")))
    else:
        code = part("Relevant Code Excerpt", excerpt(F.coalesce(found, text("final_output"))))
    return F.concat_ws("\n", head, failed if full else F.lit(None), part("Question", text("question")), part("Checker Errors", lines("errors", lambda e: F.concat(kind(e), F.coalesce(e["description"], e["message"], F.lit(""))))), part("Self-Correction Audit Errors", audit), part("Checker Feedback", text("feedback")), part("Suggestions", F.array_join("suggestions", "\n")) if full else F.lit(None), part("Verification", text("verification_detail")), code)


__all__ = ["code_blocks", "legacy", "payload_records", "render", "segments", "status_counts", "summary", "tasks"]

"""The record engine against small hand-made cases, and its queries against their SQL."""

import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from lorekit.functions import text as X
from lorekit.operators import cluster, extract, parse, quality
from lorekit.operators.normalize import normalize
from lorekit.plans import queries
from lorekit.plans.cli import main
from lorekit.plans.config import EngineConfig, ModelConfig
from lorekit.plans.pipeline import LessonPipeline
from lorekit.schema import RESPONSES, as_records
from lorekit.sources import readers, sinks
from lorekit.streaming import spool

SF = "/root/testdata/sf0.001"
SPACES = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
GOOD = {
    "id": "Fifo Pointer!", "category": "functional_logic", "problem": "The full flag rises one entry too early when the write pointer wraps around",
    "solution": "Extend both pointers by one bit and compare the extra bit to tell full from empty", "importance": "high",
    "evidence": "simulation mismatch at t=120 in the checker", "task_id": "fifo_1", "experience_type": "functional", "root_cause_type": "reset", "confidence": 0.9,
}


def records(spark, *rows):
    text = [json.dumps(r) for r in rows]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(text)], "ord long, j string")
    from lorekit.schema import RECORD

    return as_records(df.select("ord", F.from_json("j", RECORD).alias("r")).select("ord", "r.*"))


def test_strip_and_tokens_know_all_white_space(spark):
    assert len(SPACES) == 29 and all(c.isspace() for c in SPACES)
    rows = [(f"{c}a{c}B{c}",) for c in SPACES] + [("",), (None,)]
    got = spark.createDataFrame(rows, "t string").select(X.strip("t").alias("s"), X.tokens("t").alias("k")).collect()
    for (t,), r in zip(rows, got, strict=True):
        assert r.s == (t.strip() if t is not None else None)
        assert r.k == (list(dict.fromkeys(t.lower().split())) if t else [])


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "events"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    mine = sorted(repr(tuple(r)) for r in df.select(*cols).collect())
    result = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == cols
    place = [names.index(c) for c in cols]
    assert mine == sorted(repr(tuple(r[i] for i in place)) for r in result.fetchall())


def test_importance_falls_with_each_pass_without_evidence(spark):
    df = records(spark, {**GOOD, "evidence": None})
    once = normalize(df)
    assert once.first().importance == "medium" and normalize(once).first().importance == "low"


def test_gate_and_score(spark):
    bad = {**GOOD, "solution": "Consider looking at the code again and again until it works"}
    rows = normalize(records(spark, GOOD, bad)).orderBy("ord").select(quality.gate().alias("g"), quality.quality_score().alias("q")).collect()
    assert [r.g for r in rows] == ["pass", "action"]
    assert rows[0].q == pytest.approx(2 + 0.25 + 1 + 2 + 1.5 + 1.8 + 1.8 + 2)


def brute_dedup(rows):
    groups, out = {}, []
    for r in rows:
        groups.setdefault((r["bucket"], r["experience_type"], r["root_cause_type"]), []).append(r)

    def jac(a, b):
        a, b = set((a or "").lower().split()), set((b or "").lower().split())
        return len(a & b) / len(a | b) if a and b else 0.0

    for g in groups.values():
        kept = []
        for r in sorted(g, key=lambda r: (-r["q"], -len(r["evidence_list"] or []), -len(r["solution"]), -len(r["problem"]), r["ord"])):
            for lead in kept:
                if 0.55 * jac(lead["problem"], r["problem"]) + 0.35 * jac(lead["solution"], r["solution"]) + 0.1 * jac(lead["evidence"], r["evidence"]) + 0.13 >= 0.42 - 1e-12:
                    lead["n"] += 1
                    break
            else:
                kept.append({**r, "n": 1})
        out += kept
    return sorted((r["ord"], r["n"]) for r in out)


def test_dedup_equals_sequential_leaders(spark):
    from lorekit.operators.normalize import task_bucket

    rows = queries.prepared(spark, "/root/testdata/sf0.01")
    got = sorted((r.ord, r.n_members) for r in cluster.dedup(rows).collect())
    flat = rows.withColumn("q", quality.quality_score()).withColumn("bucket", task_bucket()).collect()
    assert got == brute_dedup([r.asDict() for r in flat])


RUN = {"tasks": [
    {"task_id": "clean", "final_result": {"status": "completed", "iterations": 1, "check_result": {"passornot": True, "verification": {"sim": {"result": {"type": "pass", "detail": "ok"}}}}}},
    {"task_id": "bad", "question": "Why?", "final_result": {"status": "failed", "iterations": 3, "final_output": "module m; endmodule", "check_result": {"passornot": False, "errors": [{"type": "logic", "description": "wrong"}], "verification": {"sim": {"result": {"type": "simulation error", "detail": "differs"}}}}},
     "phases": [{"phase": "self_correction_audit", "data": {"errors_found": [{"type": "x", "severity": "HIGH "}], "code_unchanged": False}}]},
    {"task_id": "agent", "error": {"type": "crash", "message": "no answer"}},
]}


def logs(spark, *contents):
    return spark.createDataFrame([(f"run_{i}.json", c) for i, c in enumerate(contents)], "source_file string, content string")


def test_segments(spark):
    rows = parse.segments(logs(spark, json.dumps(RUN), "not json", json.dumps({"task_id": "lone", "error": "text"}))).collect()
    by = {r.task_id: r for r in rows}
    assert set(by) == {"clean", "bad", "agent", "lone"}
    assert (by["clean"].budget, by["bad"].budget, by["agent"].budget) == (0, 2, 2)
    assert by["bad"].priority_score == 100 + 60 + 50 + 30 + 15 + 10
    assert by["agent"].status == "error" and by["agent"].priority_score == 80 + 100 + 50
    assert [r.task_id for r in sorted((r for r in rows if r.source_file == "run_0.json"), key=lambda r: r.segment_rank)] == ["bad", "agent", "clean"]


def test_summary(spark):
    rows = {r.source_file: r for r in parse.summary(logs(spark, json.dumps(RUN), "{oops")).collect()}
    assert rows["run_0.json"].status == "failed" and rows["run_0.json"].iterations == 3 and rows["run_0.json"].final_code == "module m; endmodule"
    assert [e.type for e in rows["run_0.json"].errors] == ["logic", "simulation_error"]
    assert [e.type for e in rows["run_1.json"].errors] == ["parse_error"]


def test_legacy_log(spark):
    text = 'x<log>@@response</log>one<log>@@endresponse</log>\nerror: bad thing\n\n<analysis title="第2次优化"> ```a``` ### 编译错误 CN_INVOKE_ERROR 7\n<log>@@response</log>two<log>@@endresponse</log>'
    r = parse.legacy(logs(spark, text)).first()
    assert (r.initial_code, r.final_code) == ("one", "two")
    assert [tuple(i) for i in r.iterations] == [(2, "```a```", True)]
    assert [tuple(e) for e in r.errors] == [("compile_error", "bad thing"), ("runtime_error", "CN_INVOKE_ERROR 7")]


def test_payload_ladder(spark):
    one = json.dumps({"experiences": [GOOD]})
    cases = [f"```json\n{one}\n```", one.replace("too early", "too\nearly"), '{"experiences": [{ "id": "a", "problem": "p", "solution": "s" }, oops', "", "[]"]
    rows = spark.createDataFrame([(c,) for c in cases], "r string").select(parse.payload_records(F.col("r")).alias("x")).collect()
    assert [len(r.x) for r in rows] == [1, 1, 1, 0, 0]
    assert "too\nearly" in rows[1].x[0].problem and rows[2].x[0].importance == "medium"


@pytest.fixture
def engine(spark, tmp_path):
    run = tmp_path / "run_a.json"
    run.write_text(json.dumps(RUN, indent=1))
    answers = spark.createDataFrame([("segment", "run_a.json", "bad", 0, json.dumps({"experiences": [GOOD, {**GOOD, "id": "other", "problem": GOOD["problem"] + " again"}, GOOD]}))], RESPONSES)
    return LessonPipeline(spark, EngineConfig(pool_path=str(tmp_path / "pool.json")), answers), str(run), tmp_path


def test_extract_spool_merge_export_split(engine):
    e, run, folder = engine
    new, audit = e.extract_batch([run])
    assert {(r.stage, r.n) for r in audit.collect()} == {("raw", 2), ("prepared", 2), ("consolidated", 1), ("final", 1)}
    (made,) = e.extract_to_spool([run], str(folder / "spool"))
    with open(made, "a") as f:
        f.write("\n{broken\n")
    result = e.merge_spool(str(folder / "spool"))
    assert result["merged"] and result["invalid_lines"] == 1 and os.path.exists(folder / "spool/merged" / os.path.basename(made))
    assert readers.valid_pool(e.config.pool_path) and list(readers.load_json(e.config.pool_path)["experiences"]) == ["fifo_pointer"]
    assert e.export().startswith("1. [Functional Logic] The full flag")
    sizes = e.split(str(folder / "core.json"), str(folder / "ext.json"))
    assert sizes["core"] + sizes["extended"] == 1
    again = e.process([run])
    assert again[0]["merge"]["pool"] == 1 and e.merge_spool(str(folder / "spool")) == {"files": 0}


def test_stream_of_spools(engine):
    e, run, folder = engine
    e.extract_to_spool([run], str(folder / "in"))
    q = spool.start(e, str(folder / "in"), str(folder / "cp"))
    q.awaitTermination()
    assert len(readers.load_json(e.config.pool_path)["experiences"]) == 1 and readers.spool_files(str(folder / "in")) == []


def test_complete_uses_a_provider(spark):
    class Echo:
        def complete(self, prompt):
            if "agent" in prompt:
                raise RuntimeError("down")
            return json.dumps({"experiences": []})

    prompts = extract.segment_prompts(parse.segments(logs(spark, json.dumps(RUN))))
    got = {r.task_id: r.response for r in extract.complete(prompts, Echo, 2).collect()}
    assert got["bad"] == '{"experiences": []}' and got["agent"] is None


def test_cli_and_config(spark, tmp_path, monkeypatch):
    sinks.write_sample_pool(str(tmp_path / "p.json"))
    assert main(["--pool", str(tmp_path / "p.json"), "--export", "--export-count", "1"], spark).count("Solution:") == 1
    monkeypatch.setenv("LLM_MAX_TOKENS", "99999")
    assert ModelConfig.from_env().max_tokens == 32768 and ModelConfig(max_tokens=0).max_tokens == 16384

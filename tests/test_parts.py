"""Smaller parts of the engine: answers, spools, pools, clients, prompts, options."""

import http.server
import json
import threading
from functools import partial

import pytest
from pyspark.sql import functions as F

import lorekit
from lorekit.operators import extract, merge, parse
from lorekit.operators.normalize import NEEDS, normalize
from lorekit.operators.pool import Pool
from lorekit.operators.providers import ChatEndpoint, FixedAnswers
from lorekit.plans import cli, queries
from lorekit.plans.config import EngineConfig, ModelConfig
from lorekit.plans.pipeline import LessonPipeline
from lorekit.schema import FIELDS
from lorekit.sources import readers, sinks

RECORD = {
    "id": "a", "category": "logic", "problem": "the reset value of the state register is lost", "solution": "assign the idle state in the reset branch of the register", "evidence": "simulation mismatch at 12",
    "task_id": "t1", "experience_type": "functional_bug_fix", "root_cause_type": "reset", "importance": "high", "confidence": 0.9,
}
FAILED = {"final_result": {"status": "failed", "iterations": 2, "check_result": {"passornot": False, "errors": [{"type": "x", "description": "y"}]}}}


def run_log(*ids):
    return json.dumps({"tasks": [{"task_id": i, **FAILED} for i in ids]})


def answer(*ids):
    return json.dumps({"experiences": [{**RECORD, "id": i} for i in ids]})


def test_repeated_tasks_and_files_get_their_own_answers(spark):
    logs = spark.createDataFrame([("run_a.json", "/x/run_a.json", run_log("t", "t")), ("run_a.json", "/y/run_a.json", run_log("t"))], "source_file string, path string, content string")
    by_rank = [("segment", "run_a.json", "/x/run_a.json", "t", 0, answer("first")), ("segment", "run_a.json", "/x/run_a.json", "t", 1, answer("second")), ("segment", "run_a.json", "/y/run_a.json", "t", 0, answer("other"))]
    schema = "prompt_kind string, source_file string, path string, task_id string, ord long, response string"
    got = extract.extract(logs, spark.createDataFrame(by_rank, schema)).orderBy("ord").collect()
    assert [r.id for r in got] == ["first", "second", "other"] and len({r.ord for r in got}) == 3
    in_turn = spark.createDataFrame([(*r[:4], None, r[5]) for r in by_rank], schema)
    got = extract.extract(logs, in_turn).orderBy("ord").collect()
    assert sorted(r.id for r in got) == ["first", "other", "second"] and len({r.ord for r in got}) == 3
    assert parse.summary(logs).count() == 2 and {r.task_count for r in parse.summary(logs).collect()} == {1, 2}


def test_spool_lines_come_in_file_order_with_quoted_numbers(spark, tmp_path):
    rows = lambda *ids: "\n".join(json.dumps({**RECORD, "id": i, "confidence": "0.7"}) for i in ids)
    (tmp_path / "b.jsonl").write_text(rows("b0", "b1", "b2") + "\n" + " " * 5000)
    (tmp_path / "a.jsonl").write_text(rows("a1") + "\n\nno json\n" + rows("a2"))
    got, bad = readers.read_spool(spark, readers.spool_files(str(tmp_path)))
    got = got.orderBy("ord").collect()
    assert [r.id for r in got] == ["a1", "a2", "b0", "b1", "b2"] and {r.confidence for r in got} == {0.7} and bad.first().invalid_lines == 1
    x = spark.createDataFrame([(json.dumps({"experiences": [{**RECORD, "confidence": c} for c in ("0.9", 0.4, "high", None)]}),)], "r string").select(parse.payload_records(F.col("r")).alias("x")).first().x
    assert [r.confidence for r in x] == [0.9, 0.4, None, None]


def test_code_of_a_segment_is_shown(spark):
    out = "said ```verilog\nmodule a(); endmodule\n``` and ```verilog module b(); endmodule```"
    task = {"task_id": "t", **FAILED, "final_result": {**FAILED["final_result"], "final_output": out}}
    logs = spark.createDataFrame([("r.json", json.dumps({"tasks": [task, {"task_id": "u", "error": {"type": "crash", "message": "gone"}}]}))], "source_file string, content string")
    rows = {r.task_id: r for r in parse.segments(logs).select("task_id", "final_code", parse.render().alias("short"), parse.render(True).alias("full")).collect()}
    assert rows["t"].final_code == "module a(); endmodule\n\nmodule b(); endmodule" and rows["t"].short.endswith("--- Relevant Code Excerpt ---\n" + rows["t"].final_code)
    assert "Agent Error ---\n  Type: crash\n  Message: gone" in rows["u"].full and "Agent Error" not in rows["t"].full


def test_pool_values(spark):
    empty = Pool.of(spark.createDataFrame([], readers.POOL))
    pool = empty.insert(RECORD).insert({**RECORD, "id": "b"}).insert({**RECORD, "id": "c"})
    changed = pool.insert({**RECORD, "id": "a", "problem": "new"}).delete("b").replace("c", {**RECORD, "id": "d"})
    assert len(pool) == 3 and [r["id"] for r in json.loads(pool.to_json())] == ["a", "b", "c"] and pool.get("x") is None
    assert [(r["id"], r["problem"]) for r in json.loads(changed.to_json())] == [("a", "new"), ("d", RECORD["problem"])] and changed.get("a")["confidence"] == 0.9
    assert [r.id for r in changed.get_all().collect()] == ["a", "d"] and set(lorekit.__all__) >= {"Pool", "LessonPipeline"} and lorekit.Pool is Pool


def test_merge_prompts_show_candidates(spark):
    pool = normalize(queries.candidates(spark, "/root/testdata/sf0.001").where("ord % 2 = 1")).withColumn("pos", F.col("ord"))
    new = queries.prepared(spark, "/root/testdata/sf0.001").where("ord % 2 = 0")
    rows = merge.prompts(new, pool).collect()
    open_ = {r.ord for r in merge.decide(new, pool).where("op.reason like 'NoAnswer%'").collect()}
    assert rows and {r.ord for r in rows} == open_ and all('"operations"' in r.prompt and 1 <= r.prompt.count('"solution":') - 1 <= 12 for r in rows)
    best = {r.n: r.o for r in merge.candidates(new, pool).where("rank = 1").collect()}
    assert best == {r.n.place: r.o.place for r in merge.recall(new, pool, 1).collect()}


def test_normalizing_some_fields_gives_the_same(spark):
    rows = queries.candidates(spark, "/root/testdata/sf0.001")
    every = {r.ord: r for r in normalize(rows).collect()}
    for name in ("importance", "task_scope", "evidence_list", "experience_type", "merged_from"):
        some = normalize(rows, (name,))
        assert some.columns == [c for c in rows.columns if c not in FIELDS or c == name] and name in FIELDS
        assert all(r[name] == every[r.ord][name] for r in some.collect())
    assert set(NEEDS) <= set(FIELDS)


def test_chat_endpoint_and_pipeline_with_a_model(spark, tmp_path):
    asked = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            asked.append((self.path, self.headers["Authorization"], json.loads(self.rfile.read(int(self.headers["Content-Length"])))))
            body = json.dumps({"choices": [{"message": {"content": answer("made")}}]}).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    config = ModelConfig(api_key="k", api_base=f"http://127.0.0.1:{server.server_port}/v1", model="m")
    assert json.loads(ChatEndpoint(config).complete("hello"))["experiences"][0]["id"] == "made"
    (path, key, body), *_ = asked
    assert path == "/v1/chat/completions" and key == "Bearer k" and body["messages"][0]["content"] == "hello" and body["max_tokens"] == 16384
    with pytest.raises(ValueError):
        ChatEndpoint(ModelConfig()).complete("x")
    (tmp_path / "run_1.json").write_text(run_log("t1"))
    pool, reports = tmp_path / "pool.json", tmp_path / "reports"
    args = ["--pool", str(pool), "--runs", str(tmp_path), "--api-base", config.api_base, "--api-key", "k", "--model", "m", "--report-folder", str(reports), "--max-experiences", "3"]
    (done,) = cli.main(args, spark)
    server.shutdown()
    assert done["merge"] == {"inserted": 1} and readers.valid_pool(str(pool)) and (tmp_path / "pool.lock").exists()
    assert json.loads((reports / "extracted_0.json").read_text())["experiences"][0]["id"] == "made" and json.loads((reports / "final_report.json").read_text())["batches"]
    text = cli.main(["--pool", str(pool), "--export", "--output", str(tmp_path / "out.txt")], spark)
    assert (tmp_path / "out.txt").read_text() == text and text.startswith("1. [")
    assert cli.parser().parse_args(["--pool-target", "core"]).core_pool == "pool_core.json"


def test_whole_logs_are_asked_for_so_many_lessons(spark, tmp_path):
    (tmp_path / "old.log").write_text("error: bad\n\n<log>@@response</log>x<log>@@endresponse</log>")
    (tmp_path / "run_2.json").write_text(run_log("t1"))
    engine = LessonPipeline(spark, EngineConfig(pool_path=str(tmp_path / "p.json"), max_per_log=4))
    asked = {r.prompt_kind: r for r in engine.prompts([str(tmp_path / "old.log"), str(tmp_path / "run_2.json")]).collect()}
    assert set(asked) == {"log", "segment"} and "at most 4 lessons" in asked["log"].prompt and asked["segment"].ord == 0
    told = engine.ask([str(tmp_path / "old.log")], partial(FixedAnswers, {"error: bad": answer("from_log")}))
    assert [r.id for r in told.extract_batch([str(tmp_path / "old.log")])[0].collect()] == ["from_log"]


def test_history_and_small_files(tmp_path):
    sinks.save_json(tmp_path / "p.json", {"experiences": {}, "history": list(range(7))})
    assert sinks.trim_history(str(tmp_path / "p.json"), -1) == 0 and sinks.trim_history(str(tmp_path / "p.json"), 3) == 4
    assert readers.load_json(str(tmp_path / "p.json"))["history"] == [4, 5, 6] and (tmp_path / "p.json.history.jsonl").read_text() == "0\n1\n2\n3\n"
    assert sinks.trim_history(str(tmp_path / "p.json"), 0) == 3 and readers.load_json(str(tmp_path / "p.json"))["history"] == []
    assert readers.batches(["a", "b"], 0) == [["a"], ["b"]] and sinks.run_id("x/y.log").startswith("run_") and sinks.run_id("/r/run9/tasks/t.json") == "run9"
    assert sinks.lock_of("/x/pool.json") == "/x/pool.lock"

"""Merging new records into a pool: recall, decide on a snapshot, apply in order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lorekit.functions.text import strip, text, unfence
from lorekit.operators import similarity as S
from lorekit.operators.blocks import Block, common, jaccard, meet, pack, same, written
from lorekit.operators.normalize import higher_importance, normalize
from lorekit.operators.quality import PASS, gate, quality_score
from lorekit.schema import FIELDS, LOOSE, MAIN_TYPES, RECORD, barrier, typed

MERGE_PROMPT = (
    "Decide how the new lesson enters the pool beside these candidates. Answer with one JSON object "
    '{"operations": [{"action": "INSERT|REPLACE|MERGE|SKIP", "target_ids": [...], "new_experience": {...}, "reason": "..."}]} that holds one '
    "operation. Prefer MERGE where both have one root cause and task, REPLACE where the new lesson is the better one of the same kind, and "
    "INSERT only for what no candidate covers.\n\n"
)

TOP = 12
KINDS = {"root_cause_type": 0.10, "experience_type": 0.06, "category": 0.08}
SETS = ("problem", "solution", "evidence", "tasks")


def _side(df: DataFrame, order: str, name: str) -> DataFrame:
    rows = S.with_tokens(df).withColumn("q", quality_score()).withColumn("place", F.col(order))
    return barrier(rows).select(F.struct(*FIELDS, "t_problem", "t_solution", "t_evidence", "t_tasks", "bucket", "q", "place").alias(name))


def _packed(side: DataFrame, name: str) -> DataFrame:
    """What the similarity of a pair needs of each record, in blocks."""
    alike = [strip(text(f"{name}.{c}")).alias(c) for c in KINDS]
    sets = [F.col(f"{name}.t_{f}").alias(f) for f in SETS]
    rows = side.select(F.col(f"{name}.place").alias("place"), text(f"{name}.id").alias("id"), (text(f"{name}.evidence") != "").alias("said"), F.coalesce(f"{name}.q", F.lit(float("-inf"))).alias("q"), *alike, *sets)
    return pack(rows, list(SETS), F.lit(0), F.lit(0))


def _similar(n: Block, o: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """sim, same_task and same_cluster of each record of n with each of o; terms are added in a fixed order."""
    same_task = common(n, o, "tasks") > 0
    said = n.numbers("said")[:, None] & o.numbers("said")
    total = jaccard(n, o, "problem") * 0.52 + jaccard(n, o, "solution") * 0.33 + np.where(said, jaccard(n, o, "evidence"), 0.0) * 0.15 + np.where(same_task, 0.12, 0.0)
    alike = {c: same(n, o, c) for c in KINDS}
    for c, value in KINDS.items():
        total += np.where(alike[c], value, 0.0)
    sim = np.minimum(1.0, total)
    return sim, same_task, alike["root_cause_type"] & (same_task | alike["experience_type"] | (sim >= 0.40))


def near(n: DataFrame, o: DataFrame, top: int) -> DataFrame:
    """n, o (places), o_q, sim, same_task, same_cluster: for each new record the top pool records of another id above the
    thresholds of recall in each of some parts of the pool, so all of the top ones. Every pair is compared, a block of
    records with a block; only the best so far are held."""

    def fold(a: Block, others: Iterator[Block]) -> Iterator[dict]:
        best = None
        for b in others:
            sim, task, cluster = _similar(a, b)
            keep = (task | cluster | (sim >= 0.20)) & ~same(a, b, "id")
            key = np.where(keep, task * 4.0 + cluster * 2.0 + sim, -1.0)  # may round, but never turns two round
            if b.n > top:
                keep &= key >= np.partition(key, b.n - top, axis=1)[:, b.n - top, None]
            i, j = np.nonzero(keep)
            found = [i, b.numbers("place")[j], b.numbers("q")[j], sim[i, j], task[i, j], cluster[i, j]]
            best = found if best is None else [np.concatenate(x) for x in zip(best, found, strict=True)]
            row, place, q, sim, task, cluster = best
            order = np.lexsort((place, -q, -sim, ~cluster, ~task, row))
            row = row[order]
            order = order[np.arange(len(row)) - np.searchsorted(row, row) < top]
            best = [x[order] for x in best]
        row, place, q, sim, task, cluster = best
        yield {"n": a.numbers("place")[row], "o": place, "o_q": q, "sim": sim, "same_task": task, "same_cluster": cluster}

    return meet(_packed(n, "n"), _packed(o, "o"), F.lit(True), fold, "n long, o long, o_q double, sim double, same_task boolean, same_cluster boolean")


def candidates(new: DataFrame, pool: DataFrame, top: int = TOP, new_order: str = "ord", pool_order: str = "pos") -> DataFrame:
    """n, o (places), sim, same_task, same_cluster, rank: up to top candidates of each new record, best first."""
    return _best(near(_side(new, new_order, "n"), _side(pool, pool_order, "o"), top), top).drop("o_q")


def recall(new: DataFrame, pool: DataFrame, top: int = TOP, new_order: str = "ord", pool_order: str = "pos") -> DataFrame:
    """candidates() with the records themselves in n and o."""
    return _recalled(*_sides(new, pool, new_order, pool_order), top)


def _sides(new: DataFrame, pool: DataFrame, new_order: str, pool_order: str) -> tuple[DataFrame, DataFrame]:
    """Both sides, written: they are computed once, whatever reads them."""
    return written(_side(new, new_order, "n"), "new"), written(_side(pool, pool_order, "o"), "pool")


def _recalled(n: DataFrame, o: DataFrame, top: int) -> DataFrame:
    best = _best(near(n, o, top), top).withColumnsRenamed({"n": "_n", "o": "_o"})
    return best.join(n, F.col("_n") == F.col("n.place")).join(o, F.col("_o") == F.col("o.place")).select("n", "o", "sim", "same_task", "same_cluster", "rank")


def _best(met: DataFrame, top: int) -> DataFrame:
    p = met.where(F.col("same_task") | F.col("same_cluster") | (F.col("sim") >= 0.20))
    each = W.partitionBy("n")
    p = p.withColumn("strong", F.col("same_task") | F.col("same_cluster") | (F.col("sim") >= 0.26))
    p = p.withColumn("_any", F.max("strong").over(each)).where(F.col("strong") | ~F.col("_any"))
    order = each.orderBy(F.desc("same_task"), F.desc("same_cluster"), F.desc("sim"), F.desc("o_q"), "o")
    return p.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).drop("strong", "_any")


def _given(c: Column) -> Column:
    return F.when(c != "", c)


def _union(*parts: Column) -> Column:
    none = F.array().cast("array<string>")
    return F.array_distinct(F.filter(F.concat(*(F.coalesce(p, none) for p in parts)), lambda x: x.isNotNull() & (x != "")))


def _listed(name: str) -> Column:
    return F.concat(F.coalesce(F.col(f"{name}.evidence_list"), F.array().cast("array<string>")), F.array(f"{name}.evidence"))


def merged_pair(df: DataFrame, name: str = "m") -> DataFrame:
    """df (n, o) with the record that merging both gives: the better one, with what the other adds."""
    first = F.col("n.q") > F.col("o.q")
    own = {f: F.when(first, F.col(f"n.{f}")).otherwise(F.col(f"o.{f}")) for f in FIELDS}
    far = {f: F.when(first, F.col(f"o.{f}")).otherwise(F.col(f"n.{f}")) for f in FIELDS}
    zero = F.lit(0.0)
    fields = dict(own)
    fields["evidence_list"] = F.when(first, _union(_listed("n"), _listed("o"))).otherwise(_union(_listed("o"), _listed("n")))
    fields["merged_from"] = F.array_remove(_union(own["merged_from"], F.array(far["id"]), far["merged_from"]), own["id"])
    fields["confidence"] = F.greatest(F.coalesce(own["confidence"], zero), F.coalesce(far["confidence"], zero))
    fields["importance"] = higher_importance(own["importance"], far["importance"])
    fields["evidence"] = F.coalesce(_given(own["evidence"]), _given(far["evidence"]))
    for f in ("task_id", "experience_type", "root_cause_type", "task_scope"):
        fields[f] = F.coalesce(_given(own[f]), _given(F.col(f"o.{f}")), _given(F.col(f"n.{f}")))
    return repair(barrier(df.withColumn(name, F.struct(*(fields[f].alias(f) for f in FIELDS)))), name)


def repair(df: DataFrame, name: str) -> DataFrame:
    """The proposed record in column name, its gaps filled from n and o, then normalised."""
    p = lambda f: F.col(f"{name}.{f}")
    fields = {f: p(f) for f in FIELDS}
    for f in ("task_id", "experience_type", "root_cause_type", "evidence"):
        fields[f] = F.coalesce(_given(p(f)), _given(F.col(f"n.{f}")), _given(F.col(f"o.{f}")))
    zero = F.lit(0.0)
    fields["confidence"] = F.coalesce(p("confidence"), F.greatest(F.coalesce("n.confidence", zero), F.coalesce("o.confidence", zero)))
    fields["evidence_list"] = _union(p("evidence_list"), F.array(fields["evidence"]), _listed("n"), _listed("o"))
    fields["merged_from"] = F.array_remove(_union(p("merged_from"), F.array("n.id"), F.col("o.merged_from"), F.array("o.id")), F.coalesce(p("id"), F.lit("")))
    keep = [c for c in df.columns if c != name]
    blank = p("id").isNull() & p("problem").isNull()
    flat = df.select(F.struct(*keep).alias("_keep"), blank.alias("_blank"), *(fields[f].alias(f) for f in FIELDS))
    flat = normalize(barrier(flat))
    single = (text("task_id") != "") & ~text("task_id").rlike("[,;/ ]")
    flat = flat.withColumn("task_scope", F.when(single, "task_specific").otherwise(F.col("task_scope"))).withColumn("_ok", gate() == PASS)
    record = F.when(~F.col("_blank"), F.struct(*FIELDS)).alias(name)
    return barrier(flat.select("_keep.*", record, F.col("_ok").alias(f"{name}_ok")))


def _operation(action: str, target: bool, record: Column | None, reason: str) -> Column:
    targets = F.array(F.col("o.id")) if target else F.array().cast("array<string>")
    none = F.lit(None).cast(RECORD)
    return F.struct(F.lit(action).alias("action"), targets.alias("target_ids"), (none if record is None else record).cast(RECORD).alias("record"), F.lit(reason).alias("reason"))


def _new() -> Column:
    return F.struct(*(F.col(f"n.{f}").alias(f) for f in FIELDS))


def strict(prefix: str, new: Column | None = None, kind: Column | None = None, task: Column | None = None) -> Column:
    """The decision by rules alone, for one best candidate in o (null if there is none)."""
    new, kind, task = new if new is not None else _new(), kind if kind is not None else F.col("n.experience_type"), task if task is not None else F.col("n.task_id")
    main, tasked, none = strip(text(kind)).isin(*MAIN_TYPES), strip(text(task)) != "", F.col("o").isNull()
    skip = lambda why: _operation("SKIP", False, None, f"{prefix}: {why}")
    merging = F.coalesce(F.col("same_cluster"), F.lit(False)) & (F.col("sim") >= 0.34)
    return (
        F.when(~main, skip("not a main type"))
        .when(none & (F.col("q_new") <= 2) & ~tasked, skip("low signal without a task"))
        .when(none, _operation("INSERT", False, new, f"{prefix}: no candidate"))
        .when(merging & ~F.col("m_ok"), skip("merged record fails the gate"))
        .when(merging, _operation("MERGE", True, F.col("m"), f"{prefix}: same cluster"))
        .when((F.col("sim") >= 0.45) & (F.col("q_new") >= F.col("q_old") + 2), _operation("REPLACE", True, new, f"{prefix}: better than an overlapping one"))
        .when(F.col("sim") >= 0.45, skip("overlapping candidate"))
        .when((F.col("q_new") <= 1) & ~tasked, skip("very low quality without a task"))
        .otherwise(_operation("INSERT", False, new, f"{prefix}: low overlap"))
    )


def _ruled(n: DataFrame, o: DataFrame) -> DataFrame:
    """n with its best candidate o, merged record m, and op where a rule decides."""
    best = _best(near(n, o, 1), 1).select(F.col("n").alias("_n"), F.col("o").alias("_o"), "sim", "same_task", "same_cluster")
    rows = n.join(best, F.col("n.place") == F.col("_n"), "left").join(o, F.col("_o") == F.col("o.place"), "left").drop("_n", "_o")
    rows = rows.withColumn("q_new", F.col("n.q")).withColumn("q_old", F.coalesce("o.q", F.lit(0.0))).withColumn("sim", F.coalesce("sim", F.lit(0.0)))
    rows = merged_pair(rows)
    q_new, q_old, sim = F.col("q_new"), F.col("q_old"), F.col("sim")
    close = F.coalesce(F.col("same_cluster"), F.lit(False)) & (sim >= 0.48)
    tasked = F.coalesce(F.col("same_task"), F.lit(False))
    rule = (
        F.when(F.col("o").isNull(), strict("NoCandidate"))
        .when(close & ~F.col("m_ok"), _operation("SKIP", False, None, "Rule: merged record fails the gate"))
        .when(close & (q_new >= q_old + 2), _operation("REPLACE", True, F.col("m"), "Rule: stronger record of the same cluster"))
        .when(close, _operation("MERGE", True, F.col("m"), "Rule: same cluster"))
        .when((sim >= 0.82) & (q_new <= q_old + 1), _operation("SKIP", False, None, "Rule: near copy"))
        .when(((sim >= 0.68) | (tasked & (sim >= 0.55))) & (q_new >= q_old + 2), _operation("REPLACE", True, _new(), "Rule: stronger overlapping record"))
        .when((sim >= 0.60) & (q_new <= q_old), _operation("SKIP", False, None, "Rule: overlapping and no better"))
    )
    return barrier(rows.withColumn("op", rule))


def prompts(new: DataFrame, pool: DataFrame, top: int = TOP, new_order: str = "ord", pool_order: str = "pos") -> DataFrame:
    """ord, prompt for the records that no rule decides: with their candidates, best first."""
    n, o = _sides(new, pool, new_order, pool_order)
    open_ = _ruled(n, o).where("op is null").select(F.col("n.place").alias("ord"), F.to_json(_new()).alias("record"))
    shown = F.struct(*(F.col(f"o.{f}").alias(f) for f in FIELDS))
    found = _recalled(n, o, top).select(F.col("n.place").alias("ord"), F.struct("rank", F.to_json(shown).alias("text")).alias("c"))
    listed = found.groupBy("ord").agg(F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda c: c["text"]), ",\n").alias("candidates"))  # top for each
    prompt = F.concat(F.lit(MERGE_PROMPT + "Candidates:\n["), text("candidates"), F.lit("]\n\nNew lesson:\n"), F.col("record"))
    return open_.join(listed, "ord", "left").select("ord", prompt.alias("prompt"))


def decide(new: DataFrame, pool: DataFrame, responses: DataFrame | None = None, new_order: str = "ord", pool_order: str = "pos") -> DataFrame:
    """ord, new_id, best_id, sim, q_new, q_old, op: one operation for each new record, on a snapshot of the pool.

    responses (ord, response) are answers of a model for records that no rule decides; without one, rules decide.
    """
    rows = _ruled(*_sides(new, pool, new_order, pool_order))
    if responses is None:
        rows = rows.withColumn("op", F.coalesce("op", strict("NoAnswer")))
    else:
        rows = _answered(rows.join(responses.select(F.col("ord").alias("_a"), "response"), F.col("n.place") == F.col("_a"), "left").drop("_a"))
    return rows.select(F.col("n.place").alias("ord"), F.col("n.id").alias("new_id"), F.col("o.id").alias("best_id"), "sim", "q_new", "q_old", "op")


def parse_operations(response: Column) -> Column:
    """operations[] of a model's answer, null if it is no such JSON."""
    one = f"action string, target_ids array<string>, new_experience {LOOSE.simpleString()}, reason string"
    return F.from_json(unfence(response), f"operations array<struct<{one.replace(' string', ':string').replace('target_ids array', 'target_ids:array').replace('new_experience struct', 'new_experience:struct')}>>")


def _answered(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("_ops", parse_operations(F.col("response")).getField("operations")).withColumn("_op", F.get("_ops", F.lit(0)))
    rows = rows.withColumn("p", typed(F.col("_op.new_experience")))
    action = F.coalesce("_op.action", F.lit("SKIP"))
    rows = rows.withColumn("_action", action).withColumn("_targets", F.coalesce("_op.target_ids", F.array().cast("array<string>"))).withColumn("_why", F.coalesce("_op.reason", F.lit("")))
    rows = repair(rows, "p")
    valid = F.forall(F.transform("_ops", lambda x: F.coalesce(x["action"], F.lit("SKIP"))), lambda a: a.isin("INSERT", "DELETE", "REPLACE", "MERGE", "SKIP"))
    lacking = F.col("_action").isin("MERGE", "REPLACE") & (F.col("p").isNull() | (F.size("_targets") == 0))
    as_said = F.struct(F.col("_action").alias("action"), F.col("_targets").alias("target_ids"), F.col("p").cast(RECORD).alias("record"), F.col("_why").alias("reason"))
    chosen = F.coalesce(F.col("p"), _new())
    answer = (
        F.when(F.col("_ops").isNull() | ~F.coalesce(valid, F.lit(False)), strict("AnswerError"))
        .when(F.size("_ops") == 0, strict("AnswerEmpty"))
        .when(lacking, strict("InvalidAnswer"))
        .when(F.col("p").isNotNull() & ~F.col("p_ok"), _operation("SKIP", False, None, "Answer: record fails the gate"))
        .when(F.col("_action") != "INSERT", as_said)
        .otherwise(strict("InsertGuard", chosen, F.coalesce("p.experience_type", "n.experience_type"), F.coalesce("p.task_id", "n.task_id")))
    )
    return rows.withColumn("op", F.coalesce("op", answer))


def apply_operations(pool: DataFrame, decisions: DataFrame, pool_order: str = "pos") -> DataFrame:
    """The pool (key, record fields, pos) after all operations in the order of ord.

    An operation of which any target is gone by then is skipped; an upsert keeps the place of its id, delete and insert
    moves it to the end. The fold sees ids alone, streamed in order: a pool is bounded by its cap, a batch by its
    files. Payloads are joined afterwards.
    """
    spark = pool.sparkSession
    key = F.col("key") if "key" in pool.columns else F.col("id")
    # Both are read three times; their own plans run once.
    pool = written(pool.select(key.alias("key"), *FIELDS, pool_order), "pool")
    decisions = written(decisions.select("ord", "op"), "operations")
    alive: dict[str, tuple[int, int | None]] = {}
    end = 0
    for r in pool.select("key", pool_order).orderBy(pool_order).toLocalIterator():
        alive[r["key"]] = (end, None)
        end += 1
    for r in decisions.select("ord", "op.action", "op.target_ids", F.col("op.record.id").alias("id")).orderBy("ord").toLocalIterator():
        if r["action"] == "SKIP" or (r["action"] != "INSERT" and any(t not in alive for t in r["target_ids"])):
            continue
        if r["action"] != "INSERT":
            for t in r["target_ids"]:
                alive.pop(t, None)
        if r["action"] != "DELETE" and r["id"] is not None:
            alive[r["id"]] = (alive[r["id"]][0] if r["id"] in alive else end, r["ord"])
            end += 1
    rows = [(k, p, src) for k, (p, src) in alive.items()]
    kept = spark.createDataFrame(rows, "key string, pos long, src long")
    old = kept.where("src is null").join(pool.select("key", *FIELDS), "key").select("key", *FIELDS, "pos")
    got = decisions.select(F.col("ord").alias("src"), "op.record.*")
    return old.unionByName(kept.where("src is not null").join(got, "src").select("key", *FIELDS, "pos"))

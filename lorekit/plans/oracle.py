"""DuckDB SQL that must give the rows of the queries."""

from __future__ import annotations

from lorekit.functions import vocabulary as V
from lorekit.operators.normalize import ALIASES
from lorekit.plans.fixtures import ANSWERS, CANDIDATES, RUN_LOGS, SEGMENTS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def inlist(values) -> str:
    return "(" + ", ".join(map(q, values)) + ")"


def cases(table: dict[str, str], key: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in table.items()) + " END"


def contains(x: str, cues) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(c)})" for c in cues) + ")"


def pattern(family) -> str:
    return q(r"\b(?:" + "|".join(family) + r")\b")


def has(x: str, family) -> str:
    return f"regexp_matches(lower({x}), {pattern(family)})"


def hits(x: str, family) -> str:
    return f"len(regexp_extract_all(lower({x}), {pattern(family)}))"


def either(family) -> str:
    return f"({has('problem', family)} OR {has('solution', family)})"


STRIP = r"'^\s+|\s+$', '', 'g'"
LOW = lambda c: f"lower(regexp_replace(coalesce({c}, ''), {STRIP}))"
_cascade = " ".join(f"WHEN {contains('spaced', cues)} THEN {q(to)}" for cues, to in V.CATEGORY_CASCADE)
_hints = " ".join(f"WHEN contains(root_text, {q(cue)}) THEN {q(root)}" for cue, root in V.ROOT_HINTS)

#: raw: the fixture's rows; norm: normalised; scored: with quality and the gate's first broken rule.
BASE = f"""WITH raw AS ({CANDIDATES}),
low AS (SELECT *, {LOW("category")} AS lc, translate({LOW("category")}, '_-', '  ') AS spaced, {LOW("importance")} AS li, {LOW("experience_type")} AS lt,
  replace({LOW("root_cause_type")}, ' ', '_') AS lr, {LOW("task_id")} AS ltask, {LOW("task_scope")} AS ls, regexp_replace(regexp_replace({LOW("id")}, '[^a-z0-9_]', '_', 'g'), '_+', '_', 'g') AS lid,
  nullif(regexp_replace(coalesce(evidence, ''), {STRIP}), '') AS ev FROM raw),
step AS (SELECT * EXCLUDE (category, id, experience_type, root_cause_type, confidence, importance, evidence, task_scope),
  CASE WHEN lc = '' THEN 'Functional Logic' WHEN lc IN {inlist(ALIASES)} THEN {cases(ALIASES, "lc")} {_cascade} ELSE regexp_replace(category, {STRIP}) END AS category,
  coalesce(nullif(trim(lid, '_'), ''), 'unknown') AS id,
  CASE WHEN li IN ('high', 'medium', 'low') THEN li ELSE 'medium' END AS imp,
  coalesce({cases(V.TYPE_ALIASES, "lt")}, nullif(lt, '')) AS given_type, coalesce({cases(V.ROOT_ALIASES, "lr")}, nullif(lr, '')) AS given_root,
  CASE WHEN confidence IS NULL THEN CASE WHEN coalesce(evidence, '') <> '' THEN CAST(0.8 AS DOUBLE) ELSE CAST(0.55 AS DOUBLE) END ELSE greatest(CAST(0 AS DOUBLE), least(confidence, CAST(1 AS DOUBLE))) END AS confidence,
  ev AS evidence, lower(concat_ws(' ', nullif(coalesce(problem, ''), ''), nullif(coalesce(solution, ''), ''), nullif(coalesce(evidence, ''), ''))) AS scope_text FROM low),
named AS (SELECT *, {LOW("category")} AS nc, lower(concat_ws(' ', nullif(problem, ''), nullif(solution, ''), id)) AS root_text FROM step),
typed AS (SELECT *, lower(concat_ws(' ', root_text, nullif(nc, ''))) AS type_text FROM named),
kinds AS (SELECT *,
  CASE WHEN given_type IS NOT NULL THEN given_type WHEN {contains("nc", ["interface", "spec"])} THEN 'spec_compliance' WHEN {contains("type_text", V.PATTERN_CUES)} THEN 'implementation_pattern'
    WHEN {contains("type_text", V.STYLE_CUES)} THEN 'style_or_portability' WHEN {contains("type_text", V.PROCESS_CUES)} THEN 'meta_process' ELSE 'functional_bug_fix' END AS experience_type,
  CASE WHEN given_root IS NOT NULL THEN given_root {_hints} ELSE 'general_logic' END AS root_cause_type FROM typed),
norm AS (SELECT ord, id, category, problem, solution, evidence, task_id, experience_type, root_cause_type, confidence,
  CASE WHEN ltask = '' OR regexp_matches(ltask, '[,;/ ]') OR (ls = 'cross_task' AND root_cause_type IN {inlist(V.WIDE_ROOTS)} AND {contains("scope_text", V.DECLARATION_CUES)}) THEN 'cross_task' ELSE 'task_specific' END AS task_scope,
  CASE WHEN evidence IS NULL THEN CASE imp WHEN 'high' THEN 'medium' ELSE 'low' END ELSE imp END AS importance,
  CASE WHEN evidence IS NULL THEN NULL ELSE [evidence] END AS evidence_list FROM kinds),
bucketed AS (SELECT *, CASE WHEN task_scope = 'cross_task' OR coalesce(task_id, '') = '' THEN '' ELSE array_to_string(list_sort(list_filter(string_split_regex(lower(task_id), '[,;/\\s]+'), lambda x: x <> '')), ',') END AS bucket,
  lower(concat_ws(' ', nullif(category, ''), nullif(problem, ''), nullif(solution, ''), nullif(evidence, ''))) AS every FROM norm),
scored AS (SELECT *, coalesce(evidence, '') AS e0,
  CASE WHEN experience_type NOT IN ('spec_compliance', 'functional_bug_fix', 'implementation_pattern') THEN 'type' WHEN length(problem) < 24 THEN 'problem_length' WHEN length(solution) < 36 THEN 'solution_length'
    WHEN confidence < CAST(0.45 AS DOUBLE) THEN 'confidence' WHEN length(coalesce(evidence, '')) < 8 THEN 'evidence_length' WHEN {either(V.GATE_VAGUE)} THEN 'vague' WHEN {has("every", V.GATE_META)} THEN 'meta'
    WHEN {has("every", V.SPECULATIVE)} THEN 'speculative' WHEN {either(V.WORKAROUND)} THEN 'workaround' WHEN {hits("solution", V.ACTION)} = 0 THEN 'action'
    WHEN {hits("coalesce(evidence, '')", V.EVIDENCE)} = 0 AND length(evidence) < 20 THEN 'evidence_words' WHEN root_cause_type IN ('process', 'style') THEN 'root' WHEN {contains("every", ["always verify", "clarify spec"])} THEN 'empty_advice' ELSE 'pass' END AS reason,
  CAST(CASE WHEN evidence IS NOT NULL THEN 2 ELSE 0 END AS DOUBLE) + least(CAST(1 AS DOUBLE), CAST(0.25 AS DOUBLE) * coalesce(len(evidence_list), 0)) + CASE WHEN coalesce(task_id, '') <> '' THEN 1 ELSE 0 END
  + CAST(CASE WHEN task_scope = 'cross_task' THEN 0.5 ELSE 0 END AS DOUBLE) + CASE WHEN length(solution) >= 60 AND {hits("solution", V.ACTION)} >= 2 THEN 2 WHEN {hits("solution", V.ACTION)} >= 1 THEN 1 ELSE 0 END
  + CAST(CASE WHEN root_cause_type IN {inlist(V.SPECIFIC_ROOTS)} THEN 1.5 WHEN root_cause_type NOT IN ('', 'general_logic') THEN 0.75 ELSE 0 END AS DOUBLE)
  + CAST(CASE experience_type WHEN 'spec_compliance' THEN 2.0 WHEN 'functional_bug_fix' THEN 1.8 WHEN 'implementation_pattern' THEN 1.3 WHEN 'meta_process' THEN -3.0 WHEN 'style_or_portability' THEN -3.0 ELSE 0 END AS DOUBLE)
  + confidence * 2 - CAST(CASE WHEN length(problem) < 35 OR {either(V.SCORE_VAGUE)} THEN 1.5 ELSE 0 END AS DOUBLE) - CASE WHEN {either(V.SCORE_META)} THEN 2 ELSE 0 END
  - least(CAST(1.5 AS DOUBLE), CAST(0.3 AS DOUBLE) * {hits("problem || ' ' || solution", V.CONFLICT)}) + CASE importance WHEN 'high' THEN 2 WHEN 'low' THEN 0 ELSE 1 END AS quality FROM bucketed),
tok AS (SELECT *, list_distinct(list_filter(string_split_regex(lower(problem), '\\s+'), lambda x: x <> '')) AS tp, list_distinct(list_filter(string_split_regex(lower(solution), '\\s+'), lambda x: x <> '')) AS ts,
  list_distinct(list_filter(string_split_regex(lower(e0), '\\s+'), lambda x: x <> '')) AS te, list_distinct(list_filter(string_split_regex(lower(coalesce(task_id, '')), '[,;/\\s]+'), lambda x: x <> '')) AS tt FROM scored WHERE reason = 'pass')
"""


def jac(x: str) -> str:
    both = f"len(list_intersect(a.{x}, b.{x}))"
    return f"CASE WHEN len(a.{x}) = 0 OR len(b.{x}) = 0 THEN CAST(0 AS DOUBLE) ELSE CAST({both} AS DOUBLE) / (len(a.{x}) + len(b.{x}) - {both}) END"


def d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def weighted(p: float, s: float, e: float) -> str:
    return f"({jac('tp')}) * {d(p)} + ({jac('ts')}) * {d(s)} + ({jac('te')}) * {d(e)}"


GROUPED = "tok a JOIN tok b ON a.ord < b.ord AND a.bucket = b.bucket AND a.experience_type = b.experience_type AND a.root_cause_type = b.root_cause_type"
TASKED = "tok a JOIN tok b ON a.ord < b.ord AND lower(coalesce(a.task_id, '')) = lower(coalesce(b.task_id, '')) AND a.experience_type = b.experience_type AND a.root_cause_type = b.root_cause_type"
_same_task = "len(list_intersect(a.tt, b.tt)) > 0"
_sim = f"least({d(1.0)}, {weighted(0.52, 0.33, 0.15)} + CASE WHEN {_same_task} THEN {d(0.12)} ELSE 0 END + CASE WHEN a.root_cause_type = b.root_cause_type THEN {d(0.10)} ELSE 0 END + CASE WHEN a.experience_type = b.experience_type THEN {d(0.06)} ELSE 0 END + CASE WHEN a.category = b.category THEN {d(0.08)} ELSE 0 END)"
RECALL = f""", met AS (SELECT a.ord AS new_ord, b.ord AS old_ord, b.quality AS qo, {_same_task} AS st, a.root_cause_type = b.root_cause_type AS sr, a.experience_type = b.experience_type AS sy, {_sim} AS sim
  FROM tok a JOIN tok b ON a.ord % 2 = 0 AND b.ord % 2 = 1 AND a.id <> b.id),
marked AS (SELECT *, sr AND (st OR sy OR sim >= {d(0.40)}) AS sc FROM met),
strong AS (SELECT *, (st OR sc OR sim >= {d(0.26)}) AS good, max(CASE WHEN st OR sc OR sim >= {d(0.26)} THEN 1 ELSE 0 END) OVER (PARTITION BY new_ord) AS any_good FROM marked)
"""
SEG = f"""WITH seg AS ({SEGMENTS}), s AS (SELECT *, CASE WHEN severity IS NULL THEN 0 ELSE 1 END AS k, lower(coalesce(severity, '')) AS sev, lower(verification_detail) AS vd, lower(feedback) AS fb FROM seg),
t AS (SELECT *, {contains("vd", ["compile error", "simulation error", "function error", "mismatch", "timeout", "failed"])} AS sig FROM s),
u AS (SELECT *, passornot AND n_errors = 0 AND k = 0 AND NOT has_task_error AND NOT sig AS clean FROM t)
"""
SQL = {
    **{name: f"{BASE} SELECT ord, {column} FROM {table}" for name, column, table in (
        ("category_normalize", "category", "norm"), ("id_normalize", "id", "norm"), ("importance_normalize", "importance", "norm"), ("type_infer", "experience_type", "norm"),
        ("root_cause_infer", "root_cause_type", "norm"), ("scope_infer", "task_scope", "norm"), ("confidence_normalize", "confidence", "norm"),
        ("evidence_list_normalize", "array_to_string(evidence_list, '|') AS evidence_list", "norm"), ("task_bucket", "bucket", "bucketed"),
        ("quality_gate", "reason = 'pass' AS passes", "scored"), ("quality_score", "round(quality, 9) AS quality", "scored"))},
    "quality_gate_reasons": f"{BASE} SELECT reason, count(*) AS n FROM scored GROUP BY reason",
    "quality_topn": f"""{BASE}, best AS (SELECT *, row_number() OVER (ORDER BY quality DESC, ord) AS rank FROM scored WHERE experience_type IN ('spec_compliance', 'functional_bug_fix', 'implementation_pattern'))
SELECT CAST(rank AS INTEGER) AS rank, id, round(quality, 9) AS quality, rank || '. [' || category || '] ' || problem || chr(10) || '   Solution: ' || solution || chr(10) AS block FROM best WHERE rank <= 20""",
    "pool_cap": f"{BASE} SELECT ord, id FROM (SELECT *, row_number() OVER (ORDER BY quality DESC, ord) AS rn FROM scored) WHERE rn <= 450",
    "type_counts": f"{BASE} SELECT experience_type, count(*) AS n FROM norm GROUP BY experience_type",
    "candidate_audit": f"{BASE} SELECT 'normalized' AS stage, experience_type, count(*) AS n FROM norm GROUP BY experience_type UNION ALL SELECT 'prepared', experience_type, count(*) FROM scored WHERE reason = 'pass' GROUP BY experience_type",
    "dup_pairs": f"{BASE} SELECT a.ord AS a, b.ord AS b, round(least({d(1.0)}, {weighted(0.55, 0.35, 0.10)} + {d(0.05)} + {d(0.03)} + {d(0.05)}), 9) AS similarity FROM {GROUPED} WHERE {weighted(0.55, 0.35, 0.10)} + {d(0.05)} + {d(0.03)} + {d(0.05)} >= {d(0.52)} - {d(0.10)}",
    "consolidate_pairs": f"{BASE} SELECT a.ord AS a, b.ord AS b, round({weighted(0.5, 0.4, 0.1)} + {d(0.05)} + {d(0.05)} + {d(0.05)}, 9) AS score FROM {TASKED} WHERE {weighted(0.5, 0.4, 0.1)} + {d(0.05)} + {d(0.05)} + {d(0.05)} >= {d(0.46)}",
    "candidate_recall": f"{BASE}{RECALL} SELECT new_ord, old_ord, CAST(rank AS INTEGER) AS rank, round(sim, 9) AS sim, st AS same_task, sc AS same_cluster FROM (SELECT *, row_number() OVER (PARTITION BY new_ord ORDER BY st DESC, sc DESC, sim DESC, qo DESC, old_ord) AS rank FROM strong WHERE good OR (any_good = 0 AND sim >= {d(0.20)})) WHERE rank <= 12",
    "tier_classify": None,
    "segment_priority": f"""{SEG} SELECT ord, CAST(CASE WHEN has_task_error THEN 80 ELSE 0 END + CASE WHEN passornot THEN 0 ELSE 100 END + CASE WHEN {contains("vd", ["compile error", "simulation error"])} THEN 60 ELSE 0 END + CASE WHEN n_errors > 0 THEN 40 + 10 * n_errors ELSE 0 END + CASE WHEN k > 0 THEN 25 + 5 * k ELSE 0 END
+ CASE WHEN iterations >= 2 THEN 15 ELSE 0 END + CASE WHEN iterations >= 4 THEN 15 ELSE 0 END + CASE WHEN task_time_seconds > 180 THEN 10 ELSE 0 END + CASE WHEN task_time_seconds > 300 THEN 10 ELSE 0 END + CASE WHEN code_unchanged = false THEN 10 ELSE 0 END + CASE WHEN n_suggestions > 0 THEN 5 ELSE 0 END
+ CASE WHEN {contains("fb", ["logic", "compile", "simulation", "mismatch", "warning"])} THEN 10 ELSE 0 END AS BIGINT) AS priority_score FROM u""",
    "segment_budget": f"{SEG} SELECT ord, CASE WHEN clean THEN 0 WHEN has_task_error THEN 2 WHEN NOT passornot THEN CASE WHEN sev IN ('high', 'critical') OR sig THEN 2 ELSE 1 END WHEN n_errors > 0 OR sev IN ('medium', 'high', 'critical') OR sig THEN 1 ELSE 0 END AS budget FROM u",
    "clean_pass": f"{SEG} SELECT ord, clean AS clean_pass FROM u",
    "status_counts": f"{SEG} SELECT CASE WHEN passornot THEN 'pass' ELSE 'failed' END AS status, count(*) AS n FROM u GROUP BY 1",
    "code_excerpt": r"SELECT doc_id, CASE WHEN length(t) <= 1800 THEN t ELSE left(t, 1400) || chr(10) || '...' || chr(10) || right(t, 400) END AS excerpt FROM (SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS t FROM documents)",
    "truncate_text": "SELECT doc_id, CASE WHEN length(text) <= 500 THEN text ELSE left(text, 497) || '...' END AS short FROM documents",
    "json_props": "SELECT event_type, count(*) AS n, sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS total FROM events GROUP BY event_type",
    "jaccard_pairs": r"""WITH t AS (SELECT doc_id, unnest(list_distinct(list_filter(string_split_regex(lower(text), '[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'), lambda x: x <> ''))) AS w FROM documents), n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM t a JOIN t b ON a.w = b.w AND a.doc_id < b.doc_id GROUP BY 1, 2)
SELECT a, b, round(CAST(k AS DOUBLE) / (x.n + y.n - k), 9) AS jaccard FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE CAST(k AS DOUBLE) / (x.n + y.n - k) >= CAST(0.42 AS DOUBLE)""",
}
_tasks = r"list_filter(string_split_regex(regexp_replace(coalesce(task_id, ''), '^\s+|\s+$', '', 'g'), '[,;/\s]+'), lambda x: x <> '')"
_every = "lower(concat_ws(' ', id, problem, solution, ''))"
TIER = f"""{BASE}, f AS (SELECT *, len({_tasks}) AS nt, len(list_filter({_tasks}, lambda t: contains({_every}, lower(t)))) AS hit, len(regexp_extract_all(problem, '\\b\\d+\\b')) AS nums,
  len(list_intersect(list_distinct(regexp_extract_all(lower(problem || ' ' || solution), '[a-z0-9_]+')), [{", ".join(map(q, V.GENERIC_TERMS))}])) AS terms FROM scored),
g AS (SELECT *, CASE WHEN nt = 1 THEN 1 ELSE 0 END + CASE WHEN hit > 0 THEN 2 ELSE 0 END + CASE WHEN nums >= 3 THEN 1 ELSE 0 END AS spec,
  CASE importance WHEN 'high' THEN 3 WHEN 'medium' THEN 1 ELSE 0 END + CASE WHEN category IN {inlist(V.CORE_CATEGORIES)} THEN 2 ELSE 0 END + CASE WHEN length(trim(e0)) >= 50 THEN 1 ELSE 0 END + CASE WHEN terms >= 2 THEN 1 ELSE 0 END
  + CASE WHEN length(trim(problem)) >= 45 AND length(trim(solution)) >= 60 THEN 1 ELSE 0 END AS gen FROM f),
h AS (SELECT ord, CASE WHEN importance = 'low' THEN 'low_importance' WHEN category NOT IN {inlist(V.CORE_CATEGORIES)} THEN 'category_not_in_core_allowlist' WHEN spec >= 3 THEN 'task_specific_signal_high' WHEN gen >= 6 THEN 'general_high_signal' ELSE 'general_signal_insufficient' END AS reason FROM g)
"""
SQL["tier_classify"] = f"{TIER} SELECT ord, CASE WHEN reason = 'general_high_signal' THEN 'core' ELSE 'extended' END AS tier, reason FROM h"
SQL["tier_reasons"] = f"{TIER} SELECT reason, count(*) AS n FROM h GROUP BY reason"


def leaders(group: str, rank: str, test: str) -> str:
    """Greedy leaders: rows of a group in rank order, each joining the first leader that it resembles."""
    recursive = BASE.replace("WITH raw AS", "WITH RECURSIVE raw AS", 1)
    return f"""{recursive}, ranked AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY {rank}, ord) AS rk, dense_rank() OVER (ORDER BY {group}) AS g FROM tok),
hit AS (SELECT b.g, b.rk, list(a.rk) AS early FROM ranked a JOIN ranked b ON a.g = b.g AND a.rk < b.rk WHERE {test} GROUP BY b.g, b.rk),
turn AS (SELECT r.g, r.rk, h.early FROM ranked r LEFT JOIN hit h ON h.g = r.g AND h.rk = r.rk),
fold AS (SELECT g, rk, [rk] AS leaders, rk AS lead FROM turn WHERE rk = 1 UNION ALL
  SELECT t.g, t.rk, CASE WHEN len(list_intersect(f.leaders, coalesce(t.early, []))) = 0 THEN list_append(f.leaders, t.rk) ELSE f.leaders END,
    coalesce(list_min(list_intersect(f.leaders, coalesce(t.early, []))), t.rk) FROM fold f JOIN turn t ON t.g = f.g AND t.rk = f.rk + 1),
made AS (SELECT f.g, f.lead, count(*) AS n_members, string_agg(r.id, ',' ORDER BY f.rk) FILTER (f.rk <> f.lead) AS merged_from, CAST(count(DISTINCT r.evidence) AS INTEGER) AS n_evidence
  FROM fold f JOIN ranked r ON r.g = f.g AND r.rk = f.rk GROUP BY f.g, f.lead)
SELECT r.ord, r.id, m.n_members, row_number() OVER (PARTITION BY m.g ORDER BY m.lead) - 1 AS leader_rank, m.merged_from, m.n_evidence FROM made m JOIN ranked r ON r.g = m.g AND r.rk = m.lead"""


_dup = f"least({d(1.0)}, {weighted(0.55, 0.35, 0.10)} + {d(0.05)} + {d(0.03)} + {d(0.05)}) >= {d(0.52)} - {d(0.10)}"
_con = f"{weighted(0.5, 0.4, 0.1)} + {d(0.05)} + {d(0.05)} + {d(0.05)} >= {d(0.46)}"
SQL["dedup"] = leaders("bucket, experience_type, root_cause_type", "quality DESC, length(solution) DESC, length(problem) DESC", _dup)
SQL["consolidate"] = leaders("lower(coalesce(task_id, '')), experience_type, root_cause_type", "quality DESC", _con)

#: decided: one operation for each new record; near: the best candidate is of its cluster and alike.
DECIDED = f"""{RECALL}, best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY new_ord ORDER BY st DESC, sc DESC, sim DESC, qo DESC, old_ord) AS rank FROM strong WHERE good OR (any_good = 0 AND sim >= {d(0.20)})) WHERE rank = 1),
sides AS (SELECT n.ord, n.id AS new_id, o.id AS best_id, coalesce(b.sim, {d(0.0)}) AS sim, n.quality AS q_new, coalesce(o.quality, {d(0.0)}) AS q_old, coalesce(b.sc, false) AS sc, coalesce(b.st, false) AS st,
  trim(coalesce(n.task_id, '')) <> '' AS tasked, CASE WHEN n.quality > o.quality THEN n.id ELSE o.id END AS own, CASE WHEN n.quality > o.quality THEN o.id ELSE n.id END AS far,
  CASE WHEN n.quality > o.quality THEN n.experience_type ELSE o.experience_type END AS own_type, n.experience_type AS new_type
  FROM (SELECT * FROM tok WHERE ord % 2 = 0) n LEFT JOIN best b ON b.new_ord = n.ord LEFT JOIN tok o ON o.ord = b.old_ord),
ruled AS (SELECT *, CASE WHEN best_id IS NULL AND q_new <= 2 AND NOT tasked THEN 'SKIP,,NoCandidate: low signal without a task' WHEN best_id IS NULL THEN 'INSERT,new,NoCandidate: no candidate'
  WHEN sc AND sim >= {d(0.48)} AND q_new >= q_old + 2 THEN 'REPLACE,own,Rule: stronger record of the same cluster' WHEN sc AND sim >= {d(0.48)} THEN 'MERGE,own,Rule: same cluster' WHEN sim >= {d(0.82)} AND q_new <= q_old + 1 THEN 'SKIP,,Rule: near copy'
  WHEN (sim >= {d(0.68)} OR (st AND sim >= {d(0.55)})) AND q_new >= q_old + 2 THEN 'REPLACE,new,Rule: stronger overlapping record' WHEN sim >= {d(0.60)} AND q_new <= q_old THEN 'SKIP,,Rule: overlapping and no better'
  WHEN sc AND sim >= {d(0.34)} THEN 'MERGE,own,NoAnswer: same cluster' WHEN sim >= {d(0.45)} AND q_new >= q_old + 2 THEN 'REPLACE,new,NoAnswer: better than an overlapping one' WHEN sim >= {d(0.45)} THEN 'SKIP,,NoAnswer: overlapping candidate'
  WHEN q_new <= 1 AND NOT tasked THEN 'SKIP,,NoAnswer: very low quality without a task' ELSE 'INSERT,new,NoAnswer: low overlap' END AS said FROM sides),
decided AS (SELECT *, split_part(said, ',', 1) AS action, split_part(said, ',', 3) AS reason, CASE split_part(said, ',', 2) WHEN 'own' THEN own WHEN 'new' THEN new_id END AS id, split_part(said, ',', 2) AS kind FROM ruled)
"""
SQL["merge_decide"] = f"{BASE}{DECIDED} SELECT ord, new_id, best_id, round(sim, 9) AS sim, action, CASE WHEN action IN ('MERGE', 'REPLACE') THEN best_id ELSE '' END AS targets, id, reason FROM decided"
SQL["apply_ops"] = f"""{BASE.replace("WITH raw AS", "WITH RECURSIVE raw AS", 1)}{DECIDED}, pool AS (SELECT id, ord, experience_type, row_number() OVER (ORDER BY ord) - 1 AS place FROM tok WHERE ord % 2 = 1),
ops AS (SELECT *, row_number() OVER (ORDER BY ord) AS k FROM decided WHERE action <> 'SKIP'),
fold AS (SELECT CAST(0 AS BIGINT) AS k, list({{'key': id, 'pos': place, 'src': CAST(NULL AS BIGINT)}} ORDER BY place) AS state, count(*) AS nxt FROM pool UNION ALL
  SELECT k, CASE WHEN live THEN list_append(list_filter(state, lambda x: x.key <> id AND (action = 'INSERT' OR x.key <> best_id)), {{'key': id, 'pos': coalesce(kept, nxt), 'src': ord}}) ELSE state END, nxt + CASE WHEN live THEN 1 ELSE 0 END
  FROM (SELECT o.k, o.ord, o.id, o.action, o.best_id, f.state, f.nxt, o.action = 'INSERT' OR len(list_filter(f.state, lambda x: x.key = o.best_id)) > 0 AS live,
    list_extract(list_filter(f.state, lambda x: x.key = o.id AND (o.action = 'INSERT' OR x.key <> o.best_id)), 1).pos AS kept FROM fold f JOIN ops o ON o.k = f.k + 1)),
final AS (SELECT unnest(state, recursive := true) FROM (SELECT state FROM fold ORDER BY k DESC LIMIT 1))
SELECT final.key, final.pos, CASE WHEN final.src IS NULL THEN pool.experience_type WHEN decided.kind = 'own' THEN decided.own_type ELSE decided.new_type END AS experience_type, CASE WHEN decided.kind = 'own' THEN decided.far END AS merged_from
FROM final LEFT JOIN pool ON final.src IS NULL AND pool.id = final.key LEFT JOIN decided ON decided.ord = final.src"""

SQL["code_blocks"] = r"SELECT conv_id, turn, CAST(3 AS INTEGER) AS n_blocks, unnest([0, 1]) AS k, unnest([regexp_replace(text, '^\s+|\s+$', '', 'g'), role]) AS block FROM conversations"
SQL["responses"] = "SELECT conv_id, CAST(count(*) AS INTEGER) AS n, min_by(text, turn) AS first, max_by(text, turn) AS last FROM conversations GROUP BY conv_id"
SQL["legacy_parse"] = """SELECT conv_id, min_by(text, turn) AS initial_code, max_by(text, turn) AS final_code, string_agg((turn + 1) || ':true', ',' ORDER BY turn) AS iterations,
  string_agg('compile_error:bad ' || turn, ',' ORDER BY turn) || ',' || string_agg('runtime_error:CN_INVOKE_ERROR 7', ',') AS errors FROM conversations GROUP BY conv_id"""

LOGS = f"""WITH logs AS ({RUN_LOGS}), held AS (SELECT *, CASE WHEN json_valid(content) THEN json_extract(content, '$.tasks[*]') ELSE [] END AS tasks FROM logs),
task AS (SELECT source_file, conv_id, unnest(range(len(tasks))) AS task_idx, unnest(tasks) AS t FROM held),
part AS (SELECT source_file, conv_id, CAST(task_idx AS INTEGER) AS task_idx, t, t->>'$.task_id' AS task_id, coalesce(t->>'$.question', '') AS question, (t->'$.error') IS NOT NULL AS has_task_error, t->'$.final_result.check_result' AS c,
  coalesce(t->>'$.final_result.status', 'error') AS status, coalesce(CAST(t->>'$.final_result.check_result.passornot' AS BOOLEAN), false) AS passornot, coalesce(CAST(t->>'$.final_result.iterations' AS INTEGER), 0) AS iterations,
  coalesce(CAST(json_array_length(t, '$.final_result.check_result.errors') AS INTEGER), 0) + CASE WHEN (t->'$.error') IS NOT NULL THEN 1 ELSE 0 END AS n_errors, coalesce(t->>'$.final_result.check_result.feedback', '') AS feedback,
  coalesce(CAST(json_array_length(t, '$.final_result.check_result.suggestions') AS INTEGER), 0) AS n_suggestions, coalesce('[sim] type=' || (t->>'$.final_result.check_result.verification.sim.result.type') || ', detail=' || (t->>'$.final_result.check_result.verification.sim.result.detail'), '') AS verification_detail,
  lower(trim(t->>'$.phases[1].data.errors_found[0].severity')) AS severity, CASE WHEN (t->'$.phases[1]') IS NULL THEN 0 ELSE 1 END AS n_sc_errors, CAST(t->>'$.phases[1].data.code_unchanged' AS BOOLEAN) AS code_unchanged,
  coalesce(CAST(t->>'$.metrics.total_time_seconds' AS DOUBLE), CAST(0 AS DOUBLE)) AS task_time_seconds, coalesce(t->>'$.final_result.final_output', '') AS final_output FROM task),
seen AS (SELECT *, array_to_string(list_transform(regexp_extract_all(final_output, '(?s)```verilog(.*?)```', 1), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), chr(10) || chr(10)) AS final_code, {contains("lower(verification_detail)", ["compile error", "simulation error", "function error", "mismatch", "timeout", "failed"])} AS sig FROM part),
scored AS (SELECT *, CASE WHEN has_task_error THEN 80 ELSE 0 END + CASE WHEN passornot THEN 0 ELSE 100 END + CASE WHEN {contains("lower(verification_detail)", ["compile error", "simulation error"])} THEN 60 ELSE 0 END + CASE WHEN n_errors > 0 THEN 40 + 10 * n_errors ELSE 0 END + CASE WHEN n_sc_errors > 0 THEN 30 ELSE 0 END
  + CASE WHEN iterations >= 2 THEN 15 ELSE 0 END + CASE WHEN iterations >= 4 THEN 15 ELSE 0 END + CASE WHEN task_time_seconds > 180 THEN 10 ELSE 0 END + CASE WHEN task_time_seconds > 300 THEN 10 ELSE 0 END + CASE WHEN code_unchanged = false THEN 10 ELSE 0 END + CASE WHEN n_suggestions > 0 THEN 5 ELSE 0 END + CASE WHEN feedback <> '' THEN 10 ELSE 0 END AS priority_score,
  CASE WHEN passornot AND n_errors = 0 AND n_sc_errors = 0 AND NOT has_task_error AND NOT sig THEN 0 WHEN has_task_error THEN 2 WHEN NOT passornot THEN CASE WHEN severity IN ('high', 'critical') OR sig THEN 2 ELSE 1 END WHEN n_errors > 0 OR severity IN ('medium', 'high', 'critical') OR sig THEN 1 ELSE 0 END AS budget FROM seen),
seg AS (SELECT *, CAST(row_number() OVER (PARTITION BY source_file ORDER BY priority_score DESC, task_idx) - 1 AS INTEGER) AS segment_rank FROM scored)
"""
SQL["log_segments"] = f"""{LOGS} SELECT source_file, task_idx, task_id, question, status, passornot, iterations, n_errors + n_sc_errors AS error_count, n_sc_errors, n_suggestions, feedback, verification_detail, code_unchanged, has_task_error, task_time_seconds, final_code, priority_score, budget, segment_rank, severity FROM seg"""
SQL["segment_prompts"] = f"""{LOGS} SELECT source_file, segment_rank, task_id || ' ===' || chr(10) || 'Status: ' || status || ' | Pass: ' || CASE WHEN passornot THEN 'True' ELSE 'False' END || ' | Iterations: ' || iterations || ' | Priority: ' || priority_score
  || CASE WHEN question = '' THEN '' ELSE chr(10) || chr(10) || '--- Question ---' || chr(10) || question END
  || CASE WHEN n_errors = 0 THEN '' WHEN has_task_error THEN chr(10) || chr(10) || '--- Checker Errors ---' || chr(10) || '  [crash] no answer' ELSE chr(10) || chr(10) || '--- Checker Errors ---' || chr(10) || '  [logic] wrong' || CASE WHEN n_errors = 2 THEN chr(10) || '  [style] late' ELSE '' END END
  || CASE WHEN n_sc_errors = 0 THEN '' ELSE chr(10) || chr(10) || '--- Self-Correction Audit Errors ---' || chr(10) || '  [x] (severity=' || (t->>'$.phases[1].data.errors_found[0].severity') || ') ' END
  || CASE WHEN feedback = '' THEN '' ELSE chr(10) || chr(10) || '--- Checker Feedback ---' || chr(10) || feedback END || CASE WHEN verification_detail = '' THEN '' ELSE chr(10) || chr(10) || '--- Verification ---' || chr(10) || verification_detail END
  || CASE WHEN final_code <> '' THEN chr(10) || chr(10) || '--- Relevant Code Excerpt ---' || chr(10) || final_code WHEN final_output <> '' THEN chr(10) || chr(10) || '--- Relevant Code Excerpt ---' || chr(10) || trim(final_output) ELSE '' END AS shown FROM seg WHERE budget > 0"""
SQL["log_summary"] = f"""{LOGS}, own AS (SELECT *, CASE WHEN contains(verification_detail, 'type=pass') THEN 'pass' WHEN has_task_error THEN 'unknown' ELSE status END AS st,
  array_to_string(list_filter([CASE WHEN conv_id % 3 > 0 AND NOT has_task_error THEN 'logic/wrong' END, CASE WHEN conv_id % 3 = 2 AND NOT has_task_error THEN 'style/' END, CASE WHEN contains(verification_detail, ' error,') THEN replace(t->>'$.final_result.check_result.verification.sim.result.type', ' ', '_') || '/' || (t->>'$.final_result.check_result.verification.sim.result.detail') END], lambda x: x IS NOT NULL), ',') AS said FROM seg)
SELECT l.source_file, CAST(count(o.task_idx) AS INTEGER) AS task_count, coalesce(max(o.iterations), 0) AS iterations, CASE WHEN bool_or(o.st = 'pass') THEN 'pass' WHEN bool_or(o.st = 'completed') THEN 'completed' WHEN bool_or(o.st = 'failed') THEN 'failed' ELSE 'unknown' END AS status, coalesce(min_by(o.task_id, o.task_idx), '') AS task_id,
  coalesce(min_by(o.feedback, o.task_idx) FILTER (o.feedback <> ''), '') AS feedback, coalesce(min_by(o.final_output, o.task_idx) FILTER (o.final_output <> ''), '') AS final_code,
  CASE WHEN l.conv_id % 13 = 5 THEN 'parse_error/not JSON' ELSE coalesce(string_agg(o.said, ',' ORDER BY o.task_idx) FILTER (o.said <> ''), '') END AS errors FROM logs l LEFT JOIN own o ON o.source_file = l.source_file GROUP BY l.source_file, l.conv_id"""

ITEMS = f"""answers AS ({ANSWERS}), items AS (SELECT a.*, i.item, CASE WHEN i.item = 0 THEN concat('lesson_', conv_id, '_', ord) WHEN i.item = 1 THEN 'second' ELSE 'third' END AS id, CASE WHEN i.item > 0 THEN 'p' WHEN conv_id % 4 = 2 THEN concat('the reset', chr(10), 'value is lost') ELSE 'the reset value is lost' END AS problem,
  CASE WHEN i.item = 0 THEN concat('seen at ', conv_id) END AS evidence, CASE WHEN i.item = 0 AND conv_id % 3 = 0 THEN CAST(0.9 AS DOUBLE) WHEN i.item = 0 AND conv_id % 3 = 1 AND conv_id % 4 <> 3 THEN CAST(1.7 AS DOUBLE) END AS confidence,
  CASE WHEN i.item > 0 THEN NULL WHEN conv_id % 3 = 0 THEN 'Interface' WHEN conv_id % 3 = 1 THEN 'verification' ELSE 'logic' END AS category, CASE WHEN i.item = 0 THEN 'high' END AS importance
  FROM answers a CROSS JOIN (SELECT CAST(unnest([0, 1, 2]) AS INTEGER) AS item) i WHERE i.item = 0 OR conv_id % 4 <> 3)"""
SQL["payload_ladder"] = f"WITH {ITEMS} SELECT source_file, ord, item, id, category, problem, evidence, confidence, importance FROM items"
SQL["extract_records"] = f"""{LOGS}, {ITEMS} SELECT i.source_file, CAST(s.segment_rank AS BIGINT) * 1048576 + i.item AS place, i.id, s.task_id,
  CASE WHEN i.item = 0 AND i.conv_id % 2 = 0 THEN 'functional_bug_fix' WHEN i.item = 0 AND i.category = 'Interface' THEN 'spec_compliance' WHEN i.item = 0 THEN 'implementation_pattern' ELSE 'functional_bug_fix' END AS experience_type,
  CASE WHEN i.item = 0 THEN 'reset' ELSE 'general_logic' END AS root_cause_type, CASE WHEN i.item = 1 THEN 'cross_task' ELSE 'task_specific' END AS task_scope,
  CASE WHEN i.confidence IS NOT NULL THEN least(i.confidence, CAST(1 AS DOUBLE)) WHEN i.item = 0 THEN CAST(0.8 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END AS confidence, CASE WHEN i.item = 0 THEN CAST(1 AS INTEGER) END AS n_evidence, true AS canonical
  FROM items i JOIN seg s ON s.source_file = i.source_file AND s.segment_rank = i.ord WHERE i.item < s.budget"""
SQL["spool_roundtrip"] = f"{BASE} SELECT CAST(row_number() OVER (ORDER BY ord) AS INTEGER) AS line, id, category, problem, solution, evidence, confidence, count(*) FILTER (ord % 10 = 0) OVER () AS invalid_lines FROM scored WHERE reason = 'pass'"
SQL["pool_roundtrip"] = f"{BASE}, best AS (SELECT *, row_number() OVER (ORDER BY quality DESC, ord) AS rn FROM scored) SELECT row_number() OVER (ORDER BY ord) - 1 AS pos, id, importance, confidence FROM best WHERE rn <= 450"
SQL["merge_prompts"] = f"""{BASE}{DECIDED}, shown AS (SELECT new_ord, least(count(*), 12) AS n FROM strong WHERE good OR (any_good = 0 AND sim >= {d(0.20)}) GROUP BY new_ord) SELECT ord, CAST(n AS INTEGER) AS n_candidates FROM decided JOIN shown ON new_ord = ord WHERE reason LIKE 'NoAnswer%'"""

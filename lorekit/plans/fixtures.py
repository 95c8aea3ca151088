"""Projections of the driver's tables that put rule vocabulary into them (see FIXTURES.md).

A document's whole text is shared out in thirds among problem, solution and evidence.
"""

CANDIDATES = """
SELECT d.doc_id AS ord, concat('Lesson ', d.doc_id, ' / ', d.lang) AS id,
CASE (d.n_chars % 37) % 12
    WHEN 0 THEN 'functional_logic'
    WHEN 1 THEN 'Interface'
    WHEN 2 THEN 'syntax error'
    WHEN 3 THEN 'State Machine'
    WHEN 4 THEN 'arithmetic safety'
    WHEN 5 THEN 'Clock Domain Crossing'
    WHEN 6 THEN 'output-format'
    WHEN 7 THEN 'coding style'
    WHEN 8 THEN 'verification'
    WHEN 9 THEN 'synthesis warnings'
    WHEN 10 THEN 'Pipeline-depth tuning'
    WHEN 11 THEN '' END AS category,
CASE (d.n_chars % 7) % 7
    WHEN 0 THEN CAST(NULL AS VARCHAR(200))
    WHEN 1 THEN 'spec_compliance'
    WHEN 2 THEN 'Functional'
    WHEN 3 THEN 'implementation pattern'
    WHEN 4 THEN 'functional_bug_fix'
    WHEN 5 THEN 'meta_process'
    WHEN 6 THEN '' END AS experience_type,
CASE (d.n_chars % 11) % 6
    WHEN 0 THEN CAST(NULL AS VARCHAR(200))
    WHEN 1 THEN 'clock'
    WHEN 2 THEN 'Signed Unsigned'
    WHEN 3 THEN 'reset'
    WHEN 4 THEN 'process'
    WHEN 5 THEN 'width' END AS root_cause_type,
CASE (d.n_chars % 31) % 5
    WHEN 0 THEN CAST(NULL AS VARCHAR(200))
    WHEN 1 THEN concat(d.lang, '_a, ', d.lang, '_b') ELSE concat(d.lang, '_', d.n_chars % 3) END AS task_id,
CASE (d.n_chars % 3) % 3
    WHEN 0 THEN 'cross_task'
    WHEN 1 THEN 'task_specific'
    WHEN 2 THEN CAST(NULL AS VARCHAR(200)) END AS task_scope,
CASE
    WHEN d.n_chars % 41 = 0 THEN 'Width bug' ELSE concat(CASE (d.n_chars % 13) % 6
    WHEN 0 THEN 'Reset branch drops the state update in'
    WHEN 1 THEN 'Port width differs from the request in'
    WHEN 2 THEN 'Declare every net at module level or'
    WHEN 3 THEN 'Important counter overflow seen in'
    WHEN 4 THEN 'make sure nothing breaks in'
    WHEN 5 THEN 'Simulation timeout masks the fault in' END, ' ', substr(d.text, 1, CAST(floor(length(d.text) / 3) AS INT))) END AS problem,
concat(CASE (d.n_chars % 17) % 6
    WHEN 0 THEN 'Use an explicit branch and assign defaults for'
    WHEN 1 THEN 'Add one guard bit and compare both pointers in'
    WHEN 2 THEN 'Instantiate the declared pattern and may extend'
    WHEN 3 THEN 'Consider changes around'
    WHEN 4 THEN 'Implement the handshake; comment the style of'
    WHEN 5 THEN 'Replace the truncated value, then zero-extend' END, ' ', substr(d.text, CAST(floor(length(d.text) / 3) AS INT) + 1, CAST(floor(length(d.text) / 3) AS INT))) AS solution,
CASE
    WHEN (d.n_chars % 19) % 5 = 4 THEN CAST(NULL AS VARCHAR(200))
    WHEN d.n_chars % 43 = 0 THEN 'seen at t12' ELSE concat(CASE (d.n_chars % 19) % 4
    WHEN 0 THEN 'simulation error at'
    WHEN 1 THEN 'checker mismatch near'
    WHEN 2 THEN 'seen'
    WHEN 3 THEN 'if unspecified' END, ' ', substr(d.text, 2 * CAST(floor(length(d.text) / 3) AS INT) + 1)) END AS evidence,
CASE (d.n_chars % 23) % 5
    WHEN 0 THEN 'high'
    WHEN 1 THEN 'HIGH '
    WHEN 2 THEN 'medium'
    WHEN 3 THEN 'low'
    WHEN 4 THEN 'urgent' END AS importance,
CASE
    WHEN d.n_chars % 29 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(30 + d.n_chars % 71 AS DOUBLE) / CAST(100 AS DOUBLE) END AS confidence
FROM documents d
"""

SEGMENTS = """
SELECT c.conv_id AS ord, concat('conv_', c.conv_id) AS task_id, max(c.turn) + 1 AS iterations, c.conv_id % 2 = 0 AS passornot, c.conv_id % 3 AS n_errors,
CASE c.conv_id % 5
    WHEN 0 THEN CAST(NULL AS VARCHAR(20))
    WHEN 1 THEN 'low'
    WHEN 2 THEN 'Medium'
    WHEN 3 THEN 'HIGH' ELSE 'critical' END AS severity,
CASE c.conv_id % 7
    WHEN 0 THEN '[sim] type=simulation error, detail=output differs'
    WHEN 1 THEN '[lint] type=compile error, detail=bad token'
    WHEN 2 THEN '[sim] type=pass, detail=1 Mismatch' ELSE '[sim] type=pass, detail=ok' END AS verification_detail,
CASE c.conv_id % 11
    WHEN 0 THEN 'Logic looks wrong'
    WHEN 1 THEN 'warning only' ELSE '' END AS feedback,
c.conv_id % 13 = 0 AS has_task_error, CASE c.conv_id % 3
    WHEN 0 THEN CAST(NULL AS BOOLEAN)
    WHEN 1 THEN false ELSE true END AS code_unchanged,
CAST((c.conv_id % 17) * 25 AS DOUBLE) AS task_time_seconds, c.conv_id % 4 AS n_suggestions FROM conversations c GROUP BY c.conv_id
"""

_NL = "chr(92), 'n'"
_CODE = f"concat('Here it is:', {_NL}, '```verilog', {_NL}, 'module m_', c.conv_id, '(input a);', {_NL}, 'endmodule', {_NL}, '```', CASE WHEN c.conv_id % 3 = 0 THEN concat(' and ```verilog module n_', c.conv_id, '(); endmodule```') ELSE '' END)"
_TASK = f"""concat('{{"task_id":"conv_', c.conv_id, '","question":"Why ', c.conv_id, '?","final_result":{{"status":"', CASE WHEN c.conv_id % 3 = 1 THEN 'failed' ELSE 'completed' END, '","iterations":', max(c.turn) + 1,
  ',"final_output":"', CASE WHEN c.conv_id % 5 = 0 THEN 'no code' ELSE {_CODE} END, '","check_result":{{"passornot":', CASE WHEN c.conv_id % 2 = 0 THEN 'true' ELSE 'false' END,
  ',"errors":[', CASE c.conv_id % 3 WHEN 0 THEN '' WHEN 1 THEN '{{"type":"logic","description":"wrong"}}' ELSE '{{"type":"logic","description":"wrong"}},{{"type":"style","message":"late"}}' END, '],"feedback":"', CASE c.conv_id % 11 WHEN 0 THEN 'Logic looks wrong' WHEN 1 THEN 'warning only' ELSE '' END,
  '","suggestions":[', CASE WHEN c.conv_id % 4 = 1 THEN '"look again"' ELSE '' END, '],"verification":{{"sim":{{"result":{{"type":"', CASE c.conv_id % 7 WHEN 0 THEN 'simulation error' WHEN 1 THEN 'compile error' ELSE 'pass' END, '","detail":"', CASE WHEN c.conv_id % 7 = 2 THEN '1 Mismatch' ELSE 'ok' END, '"}}}}}}}}}},',
  '"metrics":{{"iterations":7,"total_time_seconds":', (c.conv_id % 17) * 25, '.5}},"phases":[{{"phase":"plan","data":{{}}}}', CASE WHEN c.conv_id % 5 > 0 THEN concat(',{{"phase":"self_correction_audit","data":{{"errors_found":[{{"type":"x","severity":"', CASE c.conv_id % 5 WHEN 1 THEN 'low' WHEN 2 THEN 'Medium ' WHEN 3 THEN 'HIGH' ELSE 'critical' END, '"}}],"code_unchanged":', CASE WHEN c.conv_id % 2 = 0 THEN 'true' ELSE 'false' END, '}}}}') ELSE '' END, ']}}')"""
#: Run logs: one task, in every fourth an agent's error, in every ninth a second task of the same id; some are no JSON.
RUN_LOGS = f"""
SELECT c.conv_id, concat('run_', c.conv_id, '.json') AS source_file, CASE WHEN c.conv_id % 13 = 5 THEN 'no {{ json' ELSE concat('{{"tasks":[', {_TASK},
  CASE WHEN c.conv_id % 4 = 0 THEN concat(',{{"task_id":"agent_', c.conv_id, '","error":{{"type":"crash","message":"no answer"}}}}') ELSE '' END, CASE WHEN c.conv_id % 9 = 0 THEN concat(',', {_TASK}) ELSE '' END, ']}}') END AS content
FROM conversations c GROUP BY c.conv_id
"""
#: Answers of a model to the segments of rank 0 to 2: plain, fenced, with raw line breaks, broken; confidences as numbers, quoted, or none.
ANSWERS = f"""
SELECT l.conv_id, l.source_file, CAST(r.k AS BIGINT) AS ord, concat(CASE WHEN l.conv_id % 4 = 1 THEN concat('```json', chr(10)) ELSE '' END, '{{"experiences": [', '{{ "id": "lesson_', l.conv_id, '_', r.k,
  '", "category": "', CASE l.conv_id % 3 WHEN 0 THEN 'Interface' WHEN 1 THEN 'verification' ELSE 'logic' END, '", "problem": "the reset', CASE WHEN l.conv_id % 4 = 2 THEN chr(10) ELSE ' ' END, 'value is lost", "solution": "assign it in the pattern", "evidence": "seen at ', l.conv_id, '"',
  CASE l.conv_id % 3 WHEN 0 THEN ', "confidence": "0.9"' WHEN 1 THEN ', "confidence": 1.7' ELSE '' END, CASE WHEN l.conv_id % 2 = 0 THEN ', "experience_type": "Functional"' ELSE '' END, ', "importance": "high" }}', CASE WHEN l.conv_id % 4 = 3 THEN ' and then nothing' ELSE ', {{"id": "second", "problem": "p", "solution": "s", "task_scope": "cross_task"}}, {{"id": "third", "problem": "p", "solution": "s"}}]}}' END,
  CASE WHEN l.conv_id % 4 = 1 THEN concat(chr(10), '```') ELSE '' END) AS response
FROM (SELECT DISTINCT conv_id, concat('run_', conv_id, '.json') AS source_file FROM conversations) l CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2) r
"""

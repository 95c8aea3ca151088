"""DuckDB SQL that must give the rows of the corpus queries, where SQL can express them."""

from __future__ import annotations

from lorekit.llm import mixing

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SHINGLE = " || ' ' || ".join(f"w[i + {k}]" for k in range(4))

NEAR_DUPLICATES = rf"""WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: {_SHINGLE})) END AS sh FROM t),
e AS (SELECT doc_id, unnest(sh) AS g FROM s),
k AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT k.a, k.b FROM k JOIN s x ON x.doc_id = k.a JOIN s y ON y.doc_id = k.b WHERE 100 * n >= 80 * (len(x.sh) + len(y.sh) - n)),
reach AS (SELECT doc_id, doc_id AS other FROM s UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, r.c AS component_id, s.doc_id = r.c AS kept FROM s JOIN (SELECT doc_id, min(other) AS c FROM reach GROUP BY doc_id) r ON r.doc_id = s.doc_id"""

_U = "(CAST(CAST('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(281474976710656 AS DOUBLE)"
_QUALITY = "greatest(CAST(0.25 AS DOUBLE), CAST(1 AS DOUBLE) / (CAST(1 AS DOUBLE) + abs(ln(greatest(CAST(bytes AS DOUBLE) / greatest(size, 1), CAST(1 AS DOUBLE)) / CAST(6 AS DOUBLE)))))"
_WEIGHTS = "[" + ", ".join(f"CAST({w!r} AS DOUBLE)" for w in mixing.WEIGHTS) + "]"

SOURCE_MIXING = rf"""WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, coalesce(octet_length(encode(text)), 0) AS bytes FROM documents),
f AS (SELECT *, -ln({_U}) / {_QUALITY} AS key FROM d),
z AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, {_WEIGHTS}[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)}) + 1] AS w, CAST({mixing.MOST!r} AS DOUBLE) * source_size AS cap FROM z),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), CAST(0 AS DOUBLE)))
  / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS rank FROM w),
g AS (SELECT *, first(level) OVER (ORDER BY CASE WHEN level * w <= cap THEN rank END NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS best FROM l),
p AS (SELECT source, source_size, least(cap, best * w) AS target, CASE WHEN source_size > 0 THEN CAST(floor(least(cap, best * w) / source_size) AS BIGINT) ELSE 0 END AS epochs FROM g),
r AS (SELECT f.*, p.source_size, p.target, p.epochs, p.target - p.epochs * p.source_size AS rest,
  CAST(coalesce(sum(size) OVER (PARTITION BY f.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM f JOIN p ON f.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST(size * (epochs + CASE WHEN start < rest AND 2 * start + size <= 2 * rest THEN 1 ELSE 0 END) AS BIGINT) AS taken,
  CAST(epochs + CASE WHEN start < rest AND 2 * start + size <= 2 * rest THEN 1 ELSE 0 END AS BIGINT) AS copies FROM r"""

SQL = {"op3_circulant_minhash": NEAR_DUPLICATES, "op6_source_mixing": SOURCE_MIXING}

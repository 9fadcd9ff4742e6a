"""DuckDB statements for the operators that SQL can express."""

from __future__ import annotations

from footfall.llm import shards

SHARDS_SQL = f"""
WITH r AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {shards.BITS // 4}) AS BIGINT) AS h
  FROM documents
),
heavy AS (SELECT h FROM r WHERE n_bytes <= {shards.LIMIT_BYTES} GROUP BY h HAVING sum(n_bytes) > {shards.LIMIT_BYTES}),
small AS (SELECT * FROM r WHERE n_bytes <= {shards.LIMIT_BYTES} AND h NOT IN (SELECT h FROM heavy)),
depths AS (SELECT CAST(range AS INTEGER) AS d FROM range(0, 24)),
full_nodes AS (
  SELECT d, h >> ({shards.BITS} - d) AS node FROM small, depths GROUP BY 1, 2 HAVING sum(n_bytes) > {shards.LIMIT_BYTES}
),
placed AS (
  SELECT s.doc_id, s.n_bytes, s.h, coalesce(max(f.d) + 1, 0) AS depth
  FROM small s LEFT JOIN full_nodes f ON f.node = s.h >> ({shards.BITS} - f.d)
  GROUP BY ALL
)
SELECT doc_id, n_bytes, 'hash' AS kind, CAST(depth AS INTEGER) AS depth, h >> CAST({shards.BITS} - depth AS INTEGER) AS prefix, 0::BIGINT AS piece
FROM placed
UNION ALL
SELECT doc_id, n_bytes, 'row', {shards.BITS}, h, row_number() OVER (PARTITION BY h ORDER BY doc_id NULLS FIRST, n_bytes) - 1
FROM r WHERE n_bytes > {shards.LIMIT_BYTES}
"""

_CODES = " OR ".join(rf"contains({{0}}, '\{c}')" for c in "ethc")
_TEXT_CONFLICT = "(contains(text, '</turn>') OR contains(text, '###') OR " + _CODES.format("text") + ")"
_ROLE_BREAKS = "(contains(role, ': ') OR contains(role, '</turn>') OR " + _CODES.format("role") + ")"
_ROLE_ESCAPED = r"replace(replace(replace(replace(role, '\', '\e'), '</turn>', '\t'), '###', '\h'), ': ', '\c')"
_TEXT_ESCAPED = r"replace(replace(replace(text, '\', '\e'), '</turn>', '\t'), '###', '\h')"

CHAT_SQL = rf"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
c AS (SELECT *, bool_or({_TEXT_CONFLICT} OR {_ROLE_BREAKS}) OVER (PARTITION BY conv_id) AS escaped FROM r),
w AS (
  SELECT *, CASE WHEN escaped THEN {_ROLE_ESCAPED} ELSE role END AS role_out,
         CASE WHEN escaped AND {_TEXT_CONFLICT} THEN {_TEXT_ESCAPED} ELSE text END AS text_out
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(15 + length(role_out) + length(text_out)) AS BIGINT) AS formatted_chars
FROM w GROUP BY conv_id
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SEARCH_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
size AS (SELECT r, doc_id, len(terms)::BIGINT AS n FROM d),
total AS (SELECT count(*) FILTER (n > 0) AS docs, sum(n)::BIGINT AS terms FROM size),
asked AS (
  SELECT q, item_id, term, count(*) AS c
  FROM (SELECT q, item_id, unnest(terms) AS term FROM (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS terms FROM benchmark))
  GROUP BY ALL
),
tf AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM asked) GROUP BY ALL
),
weight AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term
),
factor AS (SELECT r, doc_id, 75 + (25 * n * docs) // terms AS m FROM size, total WHERE n > 0),
scored AS (
  SELECT q, item_id, r, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM tf JOIN asked USING (term) JOIN weight USING (term) JOIN factor USING (r) GROUP BY ALL
)
SELECT item_id, CAST(k AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST, r) AS k FROM scored WHERE score > 0)
WHERE k <= 20
"""

RESAMPLE_SQL = f"""
WITH RECURSIVE bits AS (
  SELECT range AS i, range AS c, 0 AS k FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
),
d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
doc_words AS (SELECT r, term, count(*) AS n FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY ALL),
target_words AS (SELECT term, count(*) AS n FROM (SELECT unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
walk AS (
  SELECT term, hex(encode(term)) AS h, 0 AS k, 4294967295 AS c FROM (SELECT term FROM doc_words UNION SELECT term FROM target_words)
  UNION ALL
  SELECT w.term, w.h, w.k + 1, xor(b.c, w.c >> 8)
  FROM walk w JOIN bits b ON b.k = 8 AND b.i = xor(w.c & 255, CAST('0x' || substr(w.h, 2 * w.k + 1, 2) AS BIGINT))
  WHERE 2 * w.k < length(w.h)
),
bucket AS (SELECT term, xor(c, 4294967295) % 10000 AS b FROM walk WHERE 2 * k = length(h)),
corpus AS (SELECT b, sum(n)::BIGINT AS s FROM doc_words JOIN bucket USING (term) GROUP BY b),
target AS (SELECT b, sum(n)::BIGINT AS t FROM target_words JOIN bucket USING (term) GROUP BY b),
sums AS (SELECT (SELECT coalesce(sum(s), 0)::BIGINT FROM corpus) AS all_s, (SELECT coalesce(sum(t), 0)::BIGINT FROM target) AS all_t),
gain AS (
  SELECT b, floor(1000 * ln(((coalesce(t, 0) + 1) * (all_s + 10000))::DOUBLE / ((s + 1) * (all_t + 10000))::DOUBLE))::BIGINT AS gain
  FROM corpus LEFT JOIN target USING (b), sums
),
weight AS (
  SELECT r, sum(n)::BIGINT AS n, floor(sum(n * gain)::DOUBLE / sum(n)::DOUBLE)::BIGINT AS weight
  FROM doc_words JOIN bucket USING (term) JOIN gain USING (b) GROUP BY r
),
scored AS (
  SELECT r, doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN weight USING (r)
),
able AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS k, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN k <= n // 10 THEN k END AS rank FROM scored LEFT JOIN able USING (r)
"""

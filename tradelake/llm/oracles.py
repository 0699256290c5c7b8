"""Queries of this package in plain SQL, where SQL can express them."""

from __future__ import annotations

from tradelake.llm.chat import CLOSE, MIDDLE, OPEN
from tradelake.llm.quality import MAX_RATE, MAX_REPEATED, MIN_WORDS, PRIOR_WEIGHT

_WORD = r"[^\x20\x09-\x0D]"

NEAR = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '{_WORD}+') AS ws
  FROM documents
), sh AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ')
    ELSE ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] END AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), links AS (
  SELECT a, b, c = x.n AND c = y.n AS equal
  FROM (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM sh p JOIN sh q ON p.s = q.s AND p.doc_id <> q.doc_id GROUP BY 1, 2)
    JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION SELECT node, b FROM reach JOIN links ON a = other
), tops AS (
  SELECT node, min(other) AS component_id FROM reach GROUP BY node
), equals AS (
  SELECT a AS doc_id, min(b) AS first FROM links WHERE equal GROUP BY a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(first, d.doc_id)) AS class_id, component_id,
  component_id = d.doc_id AS kept
FROM documents d JOIN tops ON node = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN equals e ON e.doc_id = d.doc_id"""

RULES = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
  FROM (SELECT r, regexp_extract_all(text, '{_WORD}+') AS ws FROM d)
), grams AS (
  SELECT r, i, [word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o] AS g,
    lead(word, 4) OVER o IS NOT NULL AS full_window
  FROM words WINDOW o AS (PARTITION BY r ORDER BY i)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM grams WHERE full_window) WHERE c > 1
), inside AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(5)) AS k) GROUP BY r
), lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_WORD}') GROUP BY r
), counts AS (
  SELECT d.r, doc_id, source, host, len(regexp_extract_all(text, '{_WORD}+')) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(lines.n, 0) AS n_dup_lines, coalesce(inside.n, 0) AS n_repeat_words
  FROM d LEFT JOIN lines USING (r) LEFT JOIN inside USING (r)
), judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM counts
), hosts AS (
  SELECT host, count(*) AS n, count(CASE WHEN base_failed THEN 1 END) AS f FROM judged GROUP BY host
), moments AS (
  SELECT avg(f / n) AS mean, var_pop(f / n) AS spread FROM hosts
), prior AS (
  SELECT mean, least(greatest(CASE WHEN spread > 0 THEN mean * (1 - mean) / spread - 1 ELSE {PRIOR_WEIGHT[1]}e0 END,
    {PRIOR_WEIGHT[0]}e0), {PRIOR_WEIGHT[1]}e0) AS weight
  FROM moments
), rates AS (
  SELECT host, (f + mean * weight) / (n + weight) AS rate FROM hosts, prior
)
SELECT doc_id, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  round(rate, 8) AS host_rate, NOT base_failed AND rate <= {MAX_RATE}e0 AS kept
FROM judged JOIN rates USING (host)"""

CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sums AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS trained,
    CAST(sum({len(OPEN + MIDDLE + CLOSE)} + 2 * length(role || text) - length(replace(role || text, '<', ''))) AS BIGINT)
      AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(trained) AS loss_chars, sha256(trained) AS loss_sha256,
  formatted_chars
FROM sums"""


def all_oracles() -> dict[str, str]:
    return {"op6_lsh_forest": NEAR, "op7_host_rules": RULES, "op10_chat": CHAT}

"""DuckDB SQL of the operators that SQL can express."""

_WS = r"[\x20\x09-\x0D]+"

_OP1 = rf"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_WS}', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""

_WORD, _SPACE = r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]"

_OP12 = rf"""
WITH RECURSIVE
crc_table AS (
  SELECT list(list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],
                          lambda c, z: xor(c >> 1, 3988292384::UBIGINT * (c & 1))) ORDER BY i) AS t
  FROM (SELECT range::UBIGINT AS i FROM range(256))),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations),
hit AS (
  SELECT conv_id, turn, role, text,
         xor(list_reduce([4294967295::UBIGINT] || list_transform(string_split(key, ''), lambda x: ascii(x)::UBIGINT),
                         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT) % 20 AS damage
  FROM keyed, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
         CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hit, (VALUES (0), (1)) AS copies(copy) WHERE damage <> 0 AND (copy = 0 OR damage = 3)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS seen,
         NOT regexp_matches(text, '{_WORD}') AS blank
  FROM damaged),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, seen) AS pos
  FROM numbered),
flagged AS (
  SELECT *, NOT blank AND seen > 1 AS duplicate,
         NOT blank AND seen = 1 AND NOT regexp_matches(text, '[.!?]{_SPACE}*$') AS truncated,
         substr(role, 1, 1) AS letter,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS letter_before
  FROM placed),
faults AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
         count_if(duplicate) AS duplicate, count_if(truncated) AS truncated,
         count_if(letter_before IS NOT NULL AND letter_before || letter NOT IN ('su', 'ua', 'au')) AS illegal,
         max(pos) AS last
  FROM flagged GROUP BY conv_id),
-- states: 0 nothing yet, 1 after s, 2 after u, 3 after a; shortest inserts between them
inserts(st, audit, lines, nst) AS (VALUES
  (0, '', [], 0), (0, 'I', ['user:'], 2), (0, 'II', ['user:', 'assistant:'], 3),
  (1, '', [], 1), (1, 'I', ['user:'], 2), (1, 'II', ['user:', 'assistant:'], 3),
  (2, '', [], 2), (2, 'I', ['assistant:'], 3), (3, '', [], 3), (3, 'I', ['user:'], 2)),
shifts(st, symbol, nst) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
edits AS (
  SELECT i.st, i.audit || e.audit AS audit, 3 * length(i.audit) AS cost, i.lines, e.kind, e.symbol, e.nst
  FROM inserts i JOIN (
    SELECT st, 'D' AS kind, '' AS symbol, 'D' AS audit, st AS nst FROM (VALUES (0), (1), (2), (3)) AS s(st)
    UNION ALL SELECT st, 'K', symbol, 'K', nst FROM shifts
    UNION ALL SELECT st, 'R', symbol, 'R', nst FROM shifts WHERE symbol <> 's') e ON i.nst = e.st),
parse(conv_id, pos, st, best) AS (
  SELECT conv_id, 0::BIGINT, 0, {{'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]}}
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT p.conv_id, f.pos, e.nst,
         min({{'cost': p.best.cost + e.cost
                 + CASE e.kind WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
                 + CASE WHEN e.kind <> 'D' AND f.truncated THEN 3 ELSE 0 END,
               'audit': p.best.audit || e.audit,
               'lines': p.best.lines || e.lines || CASE e.kind WHEN 'D' THEN []
                 WHEN 'K' THEN [f.role || ':' || f.text]
                 ELSE [CASE e.symbol WHEN 'u' THEN 'user:' ELSE 'assistant:' END || f.text] END}})
  FROM parse p JOIN flagged f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.pos = p.pos + 1
  JOIN edits e ON e.st = p.st
  WHERE (e.kind = 'D' OR NOT (f.blank OR f.duplicate)) AND (e.kind <> 'K' OR e.symbol = f.letter)
  GROUP BY p.conv_id, f.pos, e.nst),
ended AS (
  SELECT p.conv_id, min({{'cost': p.best.cost + 3 * length(i.audit), 'audit': p.best.audit || i.audit,
                          'lines': p.best.lines || i.lines}}) AS best
  FROM parse p LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM p.conv_id JOIN inserts i ON i.st = p.st
  WHERE p.pos = coalesce(f.last, 0) AND i.nst IN (0, 3) GROUP BY p.conv_id)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, e.best.cost::BIGINT AS cost, e.best.audit AS audit,
       sha256(array_to_string(e.best.lines, chr(10))) AS repaired_sha256
FROM ended e LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM e.conv_id
"""

_OP13 = r"""
WITH RECURSIVE
words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))) END AS s
  FROM words),
nodes AS (SELECT row_number() OVER () AS node, s, len(s) AS n FROM (SELECT DISTINCT s FROM sets WHERE len(s) > 0)),
tokens AS (SELECT node, n, unnest(s) AS token FROM nodes),
links AS (
  SELECT a.node AS a, b.node AS b FROM tokens a JOIN tokens b
    ON a.token = b.token AND a.node <> b.node AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reached(node, other) AS (
  SELECT node, node FROM nodes UNION SELECT r.node, l.b FROM reached r JOIN links l ON l.a = r.other),
ids AS (SELECT node, min(doc_id) AS least FROM sets JOIN nodes USING (s) GROUP BY node),
components AS (SELECT r.node, min(i.least) AS component_id FROM reached r JOIN ids i ON i.node = r.other GROUP BY r.node)
SELECT doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM sets LEFT JOIN nodes USING (s) LEFT JOIN components USING (node)
"""

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": _OP1,
    "op12_conversation_repair": _OP12,
    "op13_jaccard_join": _OP13,
}

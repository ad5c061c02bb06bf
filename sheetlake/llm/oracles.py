"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

OP2 = r"""
WITH RECURSIVE said AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t-\r]+'),
         lambda x: x <> '') AS words
  FROM documents
), sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(words) < 2 THEN words
    ELSE list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) END AS shingles
  FROM said
), items AS MATERIALIZED (
  SELECT doc_id, unnest(shingles) AS shingle FROM sets
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM items a JOIN items b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT x, y FROM pairs JOIN sets p ON p.doc_id = x JOIN sets q ON q.doc_id = y
  WHERE 100 * shared >= 80 * (len(p.shingles) + len(q.shingles) - shared)
), ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach(doc_id, other) AS (
  SELECT x, y FROM ways UNION SELECT r.doc_id, w.y FROM reach r JOIN ways w ON w.x = r.other
), components AS (
  SELECT doc_id, min(other) AS least_id FROM reach GROUP BY doc_id
)
SELECT doc_id, len(shingles) AS n_shingles, least(doc_id, coalesce(least_id, doc_id)) AS component_id,
       least(doc_id, coalesce(least_id, doc_id)) = doc_id AS kept
FROM sets LEFT JOIN components USING (doc_id)
"""

OP8 = """
WITH texts AS (
  SELECT doc_id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(body) AS text_sha256
FROM texts
WINDOW same AS (PARTITION BY body)
"""

OP10 = r"""
WITH RECURSIVE messages AS (
  SELECT row_number() OVER () AS id, conv_id, turn::BIGINT AS turn, role,
         string_split(regexp_replace(coalesce(text, ''), chr(13) || chr(10) || '?|' || chr(13), chr(10), 'g'), chr(10)) AS lines
  FROM conversations
), lines AS (
  SELECT id, conv_id, turn, k, lines[k] AS line,
         length(regexp_replace(regexp_extract(lines[k], '^[ \t]*(>[ \t]?)+'), '[^>]', '', 'g')) AS level
  FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS k FROM messages)
), marked AS (
  SELECT *, regexp_replace(line, '^[ \t]*(>[ \t]?)+', '') AS said,
         coalesce(level <> lag(level) OVER (PARTITION BY id ORDER BY k), true)::INT AS change
  FROM lines
), numbered AS (
  SELECT *, sum(change) OVER (PARTITION BY id ORDER BY k) AS part FROM marked
), parts AS (
  SELECT id, conv_id, turn, part, any_value(level) AS level, string_agg(said, chr(10) ORDER BY k) AS said
  FROM numbered GROUP BY id, conv_id, turn, part
), bodies AS (
  SELECT id, coalesce(string_agg(said, chr(10) ORDER BY part) FILTER (level = 0), '') AS own FROM parts GROUP BY id
), utterances AS (
  SELECT conv_id, turn, own AS said FROM bodies JOIN messages USING (id)
  UNION ALL SELECT conv_id, turn, said FROM parts WHERE level = 0
  UNION ALL SELECT conv_id, turn, unnest(string_split_regex(said, '\n[ \t-\r]*\n')) FROM parts WHERE level = 0
  UNION ALL SELECT conv_id, turn, unnest(string_split(said, chr(10))) FROM parts WHERE level = 0
), quoted AS (
  SELECT conv_id, turn, level, trim(regexp_replace(
           translate(said, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t-\r]+', ' ', 'g')) AS said
  FROM parts WHERE level > 0
), origins AS (
  SELECT DISTINCT conv_id, turn AS origin, trim(regexp_replace(
           translate(said, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t-\r]+', ' ', 'g')) AS said
  FROM utterances
), latest AS (
  SELECT q.conv_id, q.turn, level, max(origin) AS reply_to
  FROM quoted q JOIN origins o ON q.conv_id = o.conv_id AND q.said = o.said AND o.origin < q.turn
  WHERE q.said <> '' GROUP BY q.conv_id, q.turn, level
), links AS (
  SELECT conv_id, turn, arg_min(reply_to, level) AS reply_to, min(level) AS quote_level
  FROM latest GROUP BY conv_id, turn
), chain AS (
  SELECT conv_id, turn, reply_to AS root FROM links
  UNION
  SELECT c.conv_id, c.turn, l.reply_to FROM chain c JOIN links l ON l.conv_id = c.conv_id AND l.turn = c.root
), roots AS (
  SELECT conv_id, turn, min(root) AS root FROM chain GROUP BY conv_id, turn
), said AS (
  SELECT m.conv_id, m.turn, m.role, l.reply_to, l.quote_level, coalesce(r.root, m.turn) AS thread,
         regexp_replace(own, '\A[ \t-\r]+|[ \t-\r]+\z', '', 'g') AS body
  FROM messages m JOIN bodies USING (id)
  LEFT JOIN links l ON l.conv_id = m.conv_id AND l.turn = m.turn
  LEFT JOIN roots r ON r.conv_id = m.conv_id AND r.turn = m.turn
)
SELECT conv_id, turn, role, reply_to, quote_level, thread,
       CASE WHEN conv_id IS NOT NULL AND turn IS NOT NULL THEN
         row_number() OVER (PARTITION BY conv_id ORDER BY turn IS NULL, thread, turn, coalesce(role, ''), body)
       END AS position,
       body,
       '<|im_start|>' || coalesce(role, 'user') || chr(10) || body || '<|im_end|>' || chr(10) AS formatted
FROM said
"""


OP11 = """
WITH rows AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding) AND len(embedding) > 0
), scores AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT * FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.other_id AS positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id))::INT AS rank,
       n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""


OP12 = """
WITH crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS steps
), turns AS MATERIALIZED (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place,
         {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said
  FROM conversations WHERE conv_id IS NOT NULL
), lists AS MATERIALIZED (
  SELECT conv_id, list(said ORDER BY place) AS own FROM turns GROUP BY conv_id
), heads AS (
  SELECT conv_id, own, conv_id - conv_id % 100 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda x, y: xor(x >> 8, steps[(xor(x, y) & 255) + 1])), 4294967295) % 6 AS h
  FROM lists, crc
), whole AS MATERIALIZED (
  SELECT a.conv_id, list_concat(coalesce(b.own, [])[1:a.h], a.own[a.h + 1:]) AS said
  FROM heads a LEFT JOIN lists b ON b.conv_id = a.base
), steps AS MATERIALIZED (
  SELECT conv_id, depth, said[1:depth] AS prefix, len(said) = depth AS ends
  FROM (SELECT *, unnest(range(len(said) + 1)) AS depth FROM whole)
), nodes AS MATERIALIZED (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
         string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ended
  FROM steps GROUP BY depth, prefix
), linked AS MATERIALIZED (
  SELECT n.*, p.conv_id AS parent_conv_id
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]
), children AS (
  SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY ALL
), full_nodes AS MATERIALIZED (
  SELECT l.*, coalesce(c.n_children, 0) AS n_children,
         CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(prefix[-1].text) END AS saved
  FROM linked l LEFT JOIN children c USING (conv_id, depth)
), above AS (
  SELECT n.conv_id, n.depth, a.conv_id AS top_id, a.depth AS top_depth, n.n_children, n.saved
  FROM full_nodes n JOIN steps s ON s.conv_id = n.conv_id AND s.depth <= n.depth
  JOIN nodes a ON a.depth = s.depth AND a.prefix = s.prefix
), sums AS (
  SELECT top_id AS conv_id, top_depth AS depth, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM above GROUP BY ALL
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(coalesce(ended, '')) AS ends_sha256
FROM full_nodes JOIN sums USING (conv_id, depth)
"""


def all_sql() -> dict[str, str]:
    return {
        "op2_chosen_path": OP2,
        "op8_chunk_recipes": OP8,
        "op10_quotation_linking": OP10,
        "op11_coordinate_pruning": OP11,
        "op12_prefix_trie": OP12,
    }

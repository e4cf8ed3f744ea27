"""SQL counterparts of the training-data queries, where SQL can express them."""

from __future__ import annotations

OP2 = r"""
WITH docs AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines, row_number() OVER (ORDER BY doc_id NULLS FIRST) AS uid FROM documents
), counted AS (
  SELECT *, list_transform(lines, lambda x: len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))) AS words FROM docs
), summed AS (
  SELECT *, list_transform(range(1, len(words) + 1), lambda i: list_sum(words[1:i])) AS upto FROM counted
), places AS (
  SELECT uid, lines, upto, words, unnest(range(1, len(lines) + 1)) AS pos FROM summed
), windows AS (
  SELECT uid, pos, lines, upto, words, unnest(range(pos, len(lines) + 1)) AS last FROM places
), later AS (
  SELECT uid, pos, last, row_number() OVER (PARTITION BY lines[pos:last] ORDER BY uid, pos) > 1 AS copy
  FROM windows WHERE upto[last] - upto[pos] + words[pos] >= 8
), gone AS (
  SELECT uid, list(DISTINCT line) AS removed FROM (SELECT uid, unnest(range(pos, last + 1)) AS line FROM later WHERE copy) GROUP BY uid
)
SELECT d.doc_id, coalesce(len(d.lines), 0)::BIGINT AS n_lines, coalesce(len(g.removed), 0)::BIGINT AS n_removed,
       md5(CASE WHEN g.removed IS NULL THEN d.text
                ELSE array_to_string(list_filter(d.lines, lambda x, i: NOT list_contains(g.removed, i)), chr(10)) END) AS kept_md5
FROM docs d LEFT JOIN gone g ON d.uid = g.uid
"""

OP3 = r"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
  SELECT vec_id AS node, vec_id AS seen FROM embeddings
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON r.seen = l.a
), roots AS (
  SELECT node, min(seen) AS component_id FROM reach GROUP BY node
), counts AS (
  SELECT a, count(*) AS n_links FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(c.n_links, 0)::BIGINT AS n_links, r.component_id, e.vec_id = r.component_id AS kept
FROM embeddings e JOIN roots r ON e.vec_id = r.node LEFT JOIN counts c ON e.vec_id = c.a
"""

OP5 = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix' || coalesce(doc_id::VARCHAR, '')) AS shuffle
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ([5.0, 2.0, 1.0])[(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM docs GROUP BY source
), limits AS (
  SELECT *, source_size * 2.0::DOUBLE AS top, source_size * 2.0::DOUBLE / weight AS per_weight FROM sources
), levels AS (
  SELECT *, (least((SELECT sum(source_size) FROM limits) * 1.5::DOUBLE, (SELECT sum(top) FROM limits))
             - coalesce((SELECT sum(b.top) FROM limits b WHERE b.per_weight < a.per_weight), 0)) /
            (SELECT sum(b.weight) FROM limits b WHERE b.per_weight >= a.per_weight) AS level
  FROM limits a
), targets AS (
  SELECT source, source_size,
         CASE WHEN (SELECT max(level) FROM levels WHERE level <= per_weight) IS NULL THEN top
              ELSE least(top, weight * (SELECT max(level) FROM levels WHERE level <= per_weight)) END AS target
  FROM limits
), shares AS (
  SELECT source, sum(target) OVER w AS upto, sum(target) OVER () AS total, lead(1) OVER w IS NULL AS is_last
  FROM targets WHERE target > 0 WINDOW w AS (ORDER BY encode(source) NULLS LAST)
), edges AS (
  SELECT source, coalesce(lag(upto) OVER (ORDER BY encode(source) NULLS LAST) / total, 0) AS low,
         CASE WHEN is_last THEN 1.0 ELSE upto / total END AS high
  FROM shares
), slots AS (
  SELECT (k + 0.5::DOUBLE) * 0.6180339887498949::DOUBLE % 1.0::DOUBLE AS point
  FROM range((SELECT ceil(sum(target) / 128)::BIGINT FROM targets)) t(k)
), counts AS (
  SELECT e.source, count(*) AS n FROM slots s JOIN edges e ON e.low <= s.point AND s.point < e.high GROUP BY e.source
), placed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY shuffle, size, doc_id ROWS UNBOUNDED PRECEDING) - size AS at FROM docs
)
SELECT p.doc_id, p.size, t.source_size, t.target,
       (greatest(0, least(p.size, coalesce(c.n, 0) * 128 - p.at))
        + greatest(0, least(p.size, coalesce(c.n, 0) * 128 - t.source_size - p.at)))::BIGINT AS taken
FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source LEFT JOIN counts c ON p.source IS NOT DISTINCT FROM c.source
"""

OP7 = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id NULLS FIRST) AS uid, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), places AS (
  SELECT uid, words, unnest(range(1, len(words) - 18)) AS pos FROM docs WHERE len(words) >= 20
), windows AS (
  SELECT uid, pos, md5(array_to_string(words[pos:pos + 19], ' ')) AS span FROM places
), later AS (
  SELECT uid, pos FROM (SELECT uid, pos, row_number() OVER (PARTITION BY span ORDER BY uid, pos) AS copy FROM windows) WHERE copy > 1
), gone AS (
  SELECT uid, list(DISTINCT word) AS removed FROM (SELECT uid, unnest(range(pos, pos + 20)) AS word FROM later) GROUP BY uid
), marked AS (
  SELECT d.doc_id, d.words, g.removed, d.uid FROM docs d LEFT JOIN gone g ON d.uid = g.uid
), kept AS (
  SELECT doc_id, words, removed, CASE WHEN removed IS NULL THEN words ELSE list_filter(words, lambda x, i: NOT list_contains(removed, i)) END AS left_over FROM marked
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(removed), 0)::BIGINT AS n_removed, sha256(array_to_string(left_over, ' ')) AS kept_sha256 FROM kept
"""

OP10 = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, row_number() OVER () AS n, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(host, path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fits AS (
  SELECT s.n, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM split s JOIN rules r ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
  GROUP BY s.n
)
SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM split s LEFT JOIN fits f ON s.n = f.n
"""

OP11 = r"""
WITH turns AS (
  SELECT conv_id AS c, turn, length(coalesce(text, ''))::BIGINT AS chars,
         left(sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), 32) AS key
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, list(key ORDER BY turn NULLS FIRST, key) AS keys, list(chars ORDER BY turn NULLS FIRST, key) AS chars FROM turns GROUP BY c
), steps AS (
  SELECT c, flatten(list_transform(string_split(c::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])) AS bits FROM convs
), skips AS (
  SELECT c, xor(list_reduce(list_prepend(4294967295::BIGINT, bits),
                lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) ELSE xor(s >> 1, 3988292384::BIGINT * (s & 1)) END), 4294967295::BIGINT) % 6 AS h
  FROM steps
), rebuilt AS (
  SELECT a.c, coalesce(b.keys[1:h], []) || a.keys[h + 1:] AS keys, coalesce(b.chars[1:h], []) || a.chars[h + 1:] AS chars
  FROM convs a JOIN skips s ON a.c = s.c LEFT JOIN convs b ON b.c = a.c - a.c % 100
), places AS (
  SELECT c, keys, chars, unnest(range(0, len(keys) + 1)) AS depth FROM rebuilt
), prefixes AS (
  SELECT c, depth, depth = len(keys) AS is_end, keys[1:depth] AS line, chars[depth] AS chars, array_to_string(keys[1:depth], ',') AS node,
         CASE WHEN depth > 0 THEN array_to_string(keys[1:depth - 1], ',') END AS parent
  FROM places
), nodes AS (
  SELECT node, parent, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(line) AS line, coalesce(any_value(chars), 0) AS chars,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (is_end), '')) AS ends_sha256
  FROM prefixes GROUP BY node, parent, depth
), children AS (
  SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), handed AS (
  SELECT n.line, n.chars, n.n_convs, c.n IS NULL AS is_leaf, unnest(range(0, n.depth + 1)) AS up FROM nodes n LEFT JOIN children c ON n.node = c.node
), totals AS (
  SELECT array_to_string(line[1:up], ',') AS node, count(*) FILTER (is_leaf) AS n_leaves, sum((n_convs - 1) * chars)::BIGINT AS saved_tokens FROM handed GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0)::BIGINT AS n_children, t.n_leaves, t.saved_tokens, n.ends_sha256
FROM nodes n JOIN totals t ON n.node = t.node LEFT JOIN nodes p ON n.parent = p.node LEFT JOIN children c ON n.node = c.node
"""

ORACLE = {
    "op2_line_dedup": OP2,
    "op3_embedding_dedup": OP3,
    "op5_source_mix": OP5,
    "op7_substring_dedup": OP7,
    "op10_url_filter": OP10,
    "op11_conversation_trie": OP11,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)

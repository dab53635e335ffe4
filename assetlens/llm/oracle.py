"""DuckDB text of the queries that SQL can express."""

from __future__ import annotations

OP10 = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
           FROM documents),
g AS (SELECT h, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, h AS text_sha256
FROM d JOIN g USING (h)
"""

OP1 = r"""
WITH cut AS (
  SELECT doc_id, lines, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS unit
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
lines AS (
  SELECT doc_id, unit, line, length(line) AS length,
         coalesce(list_sum(list_transform(lines[:unit], lambda x: length(x) + 1)), 0) AS start,
         trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
  FROM cut),
line_firsts AS (
  SELECT norm, min((doc_id, start, unit)) AS f, count(*) AS copies FROM lines WHERE norm <> '' GROUP BY norm HAVING count(*) > 1),
gone AS (
  SELECT doc_id, 'line' AS kind, unit, start, length, f, copies FROM lines JOIN line_firsts USING (norm)
  WHERE NOT (doc_id = f[1] AND start = f[2])),
kept AS (SELECT * FROM lines WHERE norm <> '' AND NOT EXISTS (
  SELECT 1 FROM gone WHERE gone.doc_id = lines.doc_id AND gone.unit = lines.unit)),
parts AS (
  SELECT *, list_filter(string_split(regexp_replace(regexp_replace(line, '([.!?]) ', '\1 ' || chr(10), 'g'),
                                                    '([。！？])', '\1' || chr(10), 'g'), chr(10)), lambda x: x <> '') AS p
  FROM kept),
pieces AS (
  SELECT doc_id, unit, p, start AS line_start, length AS line_length, unnest(p) AS piece, generate_subscripts(p, 1) AS i FROM parts),
sentences AS (
  SELECT doc_id, unit, line_start + coalesce(list_sum(list_transform(p[:i - 1], lambda x: length(x))), 0) AS start,
         CASE WHEN len(p) = 1 THEN line_length ELSE length(piece) - regexp_matches(piece, '[.!?] $')::INT END AS length,
         trim(regexp_replace(lower(piece), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
  FROM pieces),
sentence_firsts AS (
  SELECT norm, min((doc_id, start, unit)) AS f, count(*) AS copies FROM sentences WHERE norm <> '' GROUP BY norm HAVING count(*) > 1)
SELECT doc_id, kind, unit::BIGINT AS unit, start::BIGINT AS start, length::BIGINT AS length, f[1]::BIGINT AS first_doc_id,
       f[3]::BIGINT AS first_unit, f[2]::BIGINT AS first_start, copies
FROM (SELECT * FROM gone UNION ALL
      SELECT doc_id, 'sentence', unit, start, length, f, copies FROM sentences JOIN sentence_firsts USING (norm)
      WHERE NOT (doc_id = f[1] AND start = f[2]))
"""

OP5 = r"""
WITH p AS (
  SELECT page_id, url, (19000 + (page_id * 37) % 400)::INTEGER AS day,
         lower(regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)', 1)) AS host,
         regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+(/[^/?#]+)', 1) AS segment
  FROM pages),
hosts AS (
  SELECT DISTINCT host, segment, regexp_replace(host, '^[^.]+\.', '') AS parent,
         ascii(substr(host, 3, 1)) * 31 + ascii(substr(host, 5, 1)) * 7 + length(host) AS h
  FROM p WHERE host <> ''),
entries AS (
  SELECT 'hosts' AS list_name, host AS pattern, 'add' AS action, 19000 + h % 200 AS day FROM hosts WHERE h % 3 = 0
  UNION SELECT 'hosts', host, 'remove', 19000 + h % 200 + 40 FROM hosts WHERE h % 3 = 0 AND h % 2 = 0
  UNION SELECT 'hosts', host, 'add', 19000 + h % 200 + 90 FROM hosts WHERE h % 3 = 0 AND h % 5 = 0
  UNION SELECT 'domains', parent, 'add', 19000 + h % 300 FROM hosts WHERE contains(parent, '.') AND h % 7 = 1
  UNION SELECT 'paths', host || segment, 'add', 19000 FROM hosts
        WHERE segment <> '' AND (h + length(segment)) % 11 = 0),
daily AS (SELECT list_name, pattern, day, bool_or(action = 'remove') AS removed FROM entries GROUP BY ALL),
spans AS (
  SELECT *, lead(day) OVER (PARTITION BY list_name, pattern ORDER BY day) AS valid_to FROM daily),
labels_of AS (
  SELECT DISTINCT page_id, url, day, host, segment, string_split(host, '.') AS l FROM p),
keys AS (
  SELECT page_id, url, day, array_to_string(l[i:], '.') AS key
  FROM (SELECT *, unnest(range(1, greatest(len(l) - 1, 1) + 1)) AS i FROM labels_of WHERE host <> '')
  UNION SELECT page_id, url, day, host || segment FROM labels_of WHERE host <> '' AND segment <> ''),
met AS (
  SELECT k.page_id, k.url, k.day, s.list_name, s.pattern, s.day::INTEGER AS valid_from
  FROM keys k JOIN spans s ON k.key = s.pattern AND NOT s.removed AND k.day >= s.day
       AND (s.valid_to IS NULL OR k.day < s.valid_to)),
best AS (
  SELECT page_id, url, day, count(DISTINCT (list_name, pattern)) AS matches,
         max((length(pattern), pattern, list_name, valid_from)) AS b
  FROM met GROUP BY ALL)
SELECT p.page_id, p.url, p.day, matches IS NOT NULL AS blocked, coalesce(matches, 0) AS matches,
       b[3] AS list_name, b[2] AS pattern, b[4] AS valid_from
FROM (SELECT DISTINCT page_id, url, day FROM p) p
LEFT JOIN best ON p.page_id IS NOT DISTINCT FROM best.page_id AND p.url IS NOT DISTINCT FROM best.url
     AND p.day IS NOT DISTINCT FROM best.day
"""

OP11 = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, conv_id::VARCHAR AS s, list(md5(length(role) || ':' || role || text) ORDER BY pos) AS ids,
         list(length(text) ORDER BY pos) AS sizes
  FROM t GROUP BY conv_id),
hashed AS (
  SELECT *, xor(list_reduce(range(8 * length(s)), lambda crc, i:
      CASE WHEN (CASE WHEN i % 8 = 0 THEN xor(crc, ascii(s[(i // 8 + 1)::INT])::BIGINT) ELSE crc END) % 2 = 1
           THEN xor((CASE WHEN i % 8 = 0 THEN xor(crc, ascii(s[(i // 8 + 1)::INT])::BIGINT) ELSE crc END) >> 1, 3988292384)
           ELSE (CASE WHEN i % 8 = 0 THEN xor(crc, ascii(s[(i // 8 + 1)::INT])::BIGINT) ELSE crc END) >> 1 END,
      4294967295::BIGINT), 4294967295::BIGINT) % 6 AS h
  FROM own),
c AS (
  SELECT a.conv_id, list_concat(coalesce(b.ids, [])[:a.h], a.ids[a.h + 1:]) AS ids,
         list_concat(coalesce(b.sizes, [])[:a.h], a.sizes[a.h + 1:]) AS sizes
  FROM hashed a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100),
members AS (
  SELECT conv_id, unnest(range(len(ids) + 1)) AS depth, ids, sizes FROM c),
nodes AS (
  SELECT depth, array_to_string(ids[:depth], '') AS node, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(any_value(sizes[depth]), 0) AS size,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(ids) = depth) AS ends
  FROM members GROUP BY ALL),
children AS (
  SELECT depth - 1 AS depth, node[:-33] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (depth, node)),
below AS (
  SELECT up AS depth, node[:32 * up] AS node, sum((n_children = 0)::BIGINT) AS n_leaves,
         sum((n_convs - 1) * size) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS up FROM counted) GROUP BY ALL)
SELECT a.conv_id, a.depth, p.conv_id AS parent_conv_id, a.n_convs, a.n_children, b.n_leaves::BIGINT AS n_leaves,
       b.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(a.ends, '')) AS ends_sha256
FROM counted a JOIN below b USING (depth, node)
LEFT JOIN nodes p ON p.depth = a.depth - 1 AND p.node = a.node[:-33]
"""

KEYWORD = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
                   for word in ("password", "passwd", "secret", "token", "api_?key"))
# Per kind: the expression (quotes doubled for SQL), the group whose length counts, that length.
SECRETS = (
    ("assign", f"""(?:{KEYWORD})["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]+", 0, 16),
    ("github", "gh[oprsu]_[A-Za-z0-9]+", 0, 40),
    ("slack", "xox[abprs]-[A-Za-z0-9-]+", 0, 24),
    ("google", "AIza[A-Za-z0-9_-]+", 0, 39),
    ("jwt", "eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", 0, 40),
    ("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
)
# The text between the matches and the matches themselves give the places.
OP12 = "WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),\nfound AS (" + \
    "\nUNION ALL\n".join(
        f"SELECT r, '{kind}' AS kind, {k} AS k, {least} AS least, regexp_extract_all(text, '{pattern}') AS m, "
        f"regexp_extract_all(text, '{pattern}', {group}) AS v, regexp_split_to_array(text, '{pattern}') AS p FROM d"
        for k, (kind, pattern, group, least) in enumerate(SECRETS)) + """),
placed AS (
  SELECT r, kind, k, least, length(m[i]) AS n, length(v[i]) AS counts,
         list_sum(list_transform(p[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0) AS start
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM found)),
spans AS (
  SELECT r, k, kind, start, kind || ':' || start::BIGINT || ':' || (start + n)::BIGINT AS span FROM placed WHERE counts >= least),
joined AS (
  SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
         string_agg(span, ',' ORDER BY start, k) FILTER (k < 3) AS base, string_agg(span, ',' ORDER BY start, k) AS spans
  FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN joined USING (r)
"""

OP13 = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
whole AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0),
tf AS (
  SELECT r, doc_id, n, term, count(*) AS tf
  FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
weight AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, whole GROUP BY term, n_docs),
scored AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN weight USING (term) JOIN tf USING (term), whole GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLE = {"op1_line_dedup": OP1, "op5_temporal_url_filter": OP5, "op10_digest_index_dedup": OP10,
          "op11_prefix_trie": OP11, "op12_secret_automaton": OP12, "op13_ball_tree_search": OP13}

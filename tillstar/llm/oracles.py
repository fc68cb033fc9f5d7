"""DuckDB SQL for the operators that SQL can express."""

NEAR_DEDUP = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]]
                                 ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS s
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
sets AS (SELECT doc_id, md5(string_agg(s, chr(31) ORDER BY s)) AS key FROM g GROUP BY doc_id),
class AS (SELECT key, min(doc_id) AS rep FROM sets GROUP BY key),
rg AS (SELECT g.doc_id, s FROM g JOIN class ON class.rep = g.doc_id),
pair AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_n
  FROM rg a JOIN rg b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT x, y FROM pair JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * both_n >= 80 * (nx.n + ny.n - both_n)),
edge AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
walk(x, y) AS (SELECT x, y FROM edge UNION SELECT walk.x, edge.y FROM walk JOIN edge ON walk.y = edge.x),
low AS (SELECT x, least(x, min(y)) AS comp FROM walk GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(low.comp, class.rep, d.doc_id) AS component_id,
       d.doc_id = coalesce(low.comp, class.rep, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN sets USING (doc_id) LEFT JOIN class USING (key)
LEFT JOIN low ON low.x = class.rep
"""

QUALITY_RULES = r"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
line AS (
  SELECT r, sum(c - 1) AS dup FROM (
    SELECT r, l, count(*) AS c FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM base)
    WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r, l) GROUP BY r),
win AS (SELECT r, i, ws[i:i + 2] AS w FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM base WHERE len(ws) >= 3)),
hit AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS c FROM win) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT i + d) AS n FROM hit, (VALUES (0), (1), (2)) AS o(d) GROUP BY r),
m AS (
  SELECT doc_id, source, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words
  FROM base LEFT JOIN line USING (r) LEFT JOIN rep USING (r)),
f AS (
  SELECT *, n_words < 50 AS few_words, 100 * n_repeat_words > 50 * n_words AS repetition,
         10 * n_symbols > n_words AND n_symbols > 0 AS symbols, n_dup_lines > 20 AS dup_lines FROM m),
long AS (
  SELECT source, rule, count(*) AS n, sum(bad::INT) AS k
  FROM (SELECT source, unnest([{'rule': 'a', 'bad': few_words}, {'rule': 'b', 'bad': repetition},
                               {'rule': 'c', 'bad': symbols}, {'rule': 'd', 'bad': dup_lines}], recursive := true) FROM f)
  GROUP BY source, rule),
prior AS (
  SELECT rule, sum(k) / sum(n) AS mean, count(*) / sum(n) AS chance,
         (sum(k * k / n) / sum(n) - (sum(k) / sum(n)) ** 2) / nullif(sum(k) / sum(n) * (1 - sum(k) / sum(n)), 0) AS spread
  FROM long GROUP BY rule),
host AS (
  SELECT source, max(n) AS host_docs,
         bool_or((k + mean * s) / (n + s) > 0.5) AS host_rejected
  FROM long JOIN (SELECT rule, mean, CASE WHEN spread IS NULL THEN 1
                                          WHEN spread <= chance THEN 1e6
                                          ELSE least(1e6, greatest(0, (1 - spread) / (spread - chance))) END AS s FROM prior) USING (rule)
  GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, few_words OR repetition AS base_failed,
       host_docs, host_rejected, NOT (few_words OR repetition OR host_rejected) AS kept
FROM f JOIN host ON f.source IS NOT DISTINCT FROM host.source
"""

URL_FILTER = r"""
WITH part AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
p AS (
  SELECT page_id, rest,
         coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM part),
q AS (
  SELECT *, list_sort(list_filter(string_split(regexp_extract(regexp_replace(rest, '#.*$', '', 's'), '^[^?]*\?(.*)$', 1, 's'), '&'),
                                  lambda x: x <> '' AND NOT regexp_matches(x, '^(ref|utm_[^=]*|fbclid|gclid)(=|$)'))) AS kept,
         regexp_replace(host, '^www\.|:(80|443)$', '', 'g') AS bare FROM p),
c AS (
  SELECT *, CASE WHEN bare <> '' THEN bare || regexp_replace(path, '/+$', '')
                 || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical FROM q),
listed AS (SELECT canonical, min(page_id) AS keep FROM c WHERE canonical IS NOT NULL GROUP BY canonical HAVING count(*) > 1),
r(decision, name, start) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                                    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
best AS (
  SELECT page_id, max_by(name || start, length(name || start)) AS rule, max_by(decision, length(name || start)) AS decision
  FROM c JOIN r ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start) GROUP BY page_id)
SELECT page_id, host, path, rule,
       coalesce(decision, CASE WHEN listed.canonical IS NOT NULL AND page_id IS DISTINCT FROM keep THEN 'block' ELSE 'allow' END) AS verdict,
       listed.canonical IS NOT NULL AS listed
FROM c LEFT JOIN best USING (page_id) LEFT JOIN listed ON listed.canonical = c.canonical
"""

LEXICAL_SEARCH = r"""
WITH term(kind, r, id, t) AS (
  SELECT 'doc', r, doc_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))
  FROM (SELECT row_number() OVER () AS r, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
  UNION ALL
  SELECT 'item', r, item_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))
  FROM (SELECT row_number() OVER () AS r, item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM benchmark)),
size AS (SELECT r, count(*) AS n FROM term WHERE kind = 'doc' GROUP BY r),
total AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM size),
tf AS (SELECT r, id AS doc_id, t, count(*) AS tf FROM term WHERE kind = 'doc' GROUP BY r, id, t),
item AS (SELECT id AS item_id, t, count(*) AS times FROM term WHERE kind = 'item' GROUP BY id, t),
w AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, total GROUP BY t, n_docs),
score AS (
  SELECT item_id, r, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM item JOIN tf USING (t) JOIN w USING (t) JOIN size USING (r), total GROUP BY item_id, r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM score WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

CONVERSATION_TRIE = r"""
WITH RECURSIVE low(n, i, c) AS (  -- the table of CRC-32, bit by bit
  SELECT b, 0, b::BIGINT FROM range(256) AS t(b)
  UNION ALL SELECT n, i + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM low WHERE i < 8),
crc(id, s, i, c) AS (
  SELECT conv_id, conv_id::VARCHAR, 0, 4294967295::BIGINT FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
  UNION ALL SELECT id, s, crc.i + 1, xor(crc.c >> 8, low.c) FROM crc JOIN low ON low.i = 8 AND low.n = xor(crc.c, ascii(s[crc.i + 1])) & 255
  WHERE crc.i < length(s)),
head AS (SELECT id AS conv_id, xor(c, 4294967295) % 9 AS h FROM crc WHERE i = length(s)),
own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
full_conv AS (
  SELECT own.conv_id, list_concat(coalesce(base.ts, [])[1:h], own.ts[h + 1:]) AS ts
  FROM own JOIN head USING (conv_id) LEFT JOIN own base ON base.conv_id = own.conv_id - own.conv_id % 5),
pre AS (SELECT conv_id, d, ts[1:d] AS p, len(ts) = d AS ends FROM (SELECT conv_id, ts, unnest(range(len(ts) + 1)) AS d FROM full_conv)),
node AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(octet_length(encode(p[d].t)), 0) AS bytes,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM pre GROUP BY p, d),
child AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
n AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (p, d)),
up AS (SELECT unnest(range(d + 1)) AS a, p, n_children, (n_convs - 1) * bytes AS saved FROM n),
sub AS (SELECT p[1:a] AS p, a AS d, sum((n_children = 0)::INT) AS n_leaves, sum(saved) AS saved_tokens FROM up GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, parent.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN sub USING (p, d) LEFT JOIN n parent ON parent.d = n.d - 1 AND parent.p = n.p[1:n.d - 1]
"""

SQL = {"op1_quality_rules": QUALITY_RULES, "op5_url_filter": URL_FILTER, "op6_minhash_near_dedup": NEAR_DEDUP,
       "op11_lexical_search": LEXICAL_SEARCH, "op13_conversation_trie": CONVERSATION_TRIE}

"""SQL that DuckDB runs beside the queries that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op7_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM d
"""

# Aliases are joined by walking canonical links and refresh targets in both directions.
ORACLES["op6_url_filter"] = r"""
WITH RECURSIVE rules(rule, rhost, rpath, verdict) AS (VALUES
  ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
  ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')
), p AS (
  SELECT page_id, html, lower(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's')) AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages
), t AS (
  SELECT host || path AS a, host, unnest([
    regexp_extract(regexp_extract(html, '<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>', 0, 'is'), 'href\s*=\s*["'']?([^"''\s>]+)', 1, 'is'),
    regexp_extract(regexp_extract(html, '<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>', 0, 'is'), 'url\s*=\s*["'']?([^"''\s>]+)', 1, 'is')
  ]) AS url
  FROM p WHERE host <> '' AND html IS NOT NULL
), e AS (
  SELECT a, CASE WHEN contains(url, '://')
    THEN lower(regexp_extract(url, '^.*?://([^/?#]*)', 1)) || regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1)
    ELSE host || regexp_extract(url, '^([^?#]*)', 1) END AS b
  FROM t WHERE url <> ''
), both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
walk(node, reach) AS (
  SELECT a, a FROM both_ways UNION SELECT w.node, x.b FROM walk w JOIN both_ways x ON w.reach = x.a
), named AS (
  SELECT DISTINCT reach AS name, regexp_extract(reach, '^[^/]*', 0) AS host, regexp_extract(reach, '^[^/]*(.*)$', 1) AS path FROM walk
  UNION SELECT DISTINCT host || path, host, path FROM p
), fits AS (
  SELECT name, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM named JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY name
), alias AS (
  SELECT node FROM walk JOIN fits ON name = reach
  GROUP BY node HAVING bool_or(verdict = 'block') AND NOT bool_or(verdict = 'allow')
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN alias.node IS NOT NULL AND host <> '' THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN fits ON name = host || path LEFT JOIN alias ON alias.node = host || path
"""

ORACLES["op10_topk"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS c
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.c, c.c), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
FROM s WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""

# DuckDB has no CRC-32: the table of its 256 bytes by the polynomial 0xEDB88320, and the fold over a text of ASCII.
CRC = """
crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
)"""


def crc32(text: str) -> str:
    """SQL for the unsigned CRC-32 of a text of ASCII; ``crc`` must be in scope."""
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(unicode(x) AS BIGINT))"
    return f"xor(list_reduce({codes}, lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


ORACLES["op11_prefix_trie"] = rf"""
WITH RECURSIVE {CRC}, turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(struct_pack(role := role, text := text, words := words) ORDER BY pos) AS l FROM turns GROUP BY conv_id
), heads AS (
  SELECT conv_id, l, conv_id - conv_id % 20 AS base, CAST({crc32("CAST(conv_id AS VARCHAR)")} % 4 AS BIGINT) AS h FROM own, crc
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.l, [])[1:c.h], c.l[c.h + 1:]) AS l FROM heads c LEFT JOIN own b ON b.conv_id = c.base
), prefixes AS (
  SELECT conv_id, d, len(l) AS n, CASE WHEN d = 0 THEN [] ELSE l[1:d] END AS path, CASE WHEN d = 0 THEN 0 ELSE l[d].words END AS words
  FROM rebuilt, unnest(range(len(l) + 1)) AS u(d)
), places AS (
  SELECT *, min(conv_id) OVER (PARTITION BY d, path) AS node FROM prefixes
), nodes AS (
  SELECT node, d, count(*) AS n_convs, any_value(words) AS words, string_agg(conv_id, ',' ORDER BY conv_id) FILTER (n = d) AS ends, bool_and(n = d) AS leaf
  FROM places GROUP BY node, d
), up AS (
  SELECT x.node, x.d, p.node AS parent FROM nodes x JOIN places p ON p.conv_id = x.node AND p.d = x.d - 1
), children AS (
  SELECT parent AS node, d - 1 AS d, count(*) AS n_children FROM up GROUP BY ALL
), below AS (
  SELECT p.node, p.d, sum((x.n_convs - 1) * x.words) AS saved, count_if(x.leaf) AS leaves
  FROM nodes x JOIN places p ON p.conv_id = x.node AND p.d <= x.d GROUP BY ALL
)
SELECT node AS conv_id, d AS depth, parent AS parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM nodes JOIN below USING (node, d) LEFT JOIN up USING (node, d) LEFT JOIN children USING (node, d)
"""


def _cheapest_repair() -> str:
    """SQL for the list of the cheapest way to each of four states after the rows of list ``l``.

    A way is a text, its cost in six digits and then its audit, so the least text is the cheapest way with the least audit.
    States are nothing yet, system, user, assistant; null is no way.
    """
    cost = lambda w, c: f"lpad(CAST(CAST({w}[1:6] AS INTEGER) + {c} AS VARCHAR), 6, '0')"
    then = lambda w, letter, c: f"({cost(w, c)} || {w}[7:] || '{letter}')"
    # the states after inserted turns: a user turn from any but user, then an assistant turn, then a user turn again
    one = "least(a[3], " + ", ".join(then(f"a[{i}]", "I", 2) for i in (1, 2, 4)) + ")"
    free = f"[a[1], a[2], {one}, least(a[4], {then('a[3]', 'I', 2)}, {then(then('a[1]', 'I', 2), 'I', 2)}, {then(then('a[2]', 'I', 2), 'I', 2)})]"
    extra = "(CASE WHEN x[3:3] = 't' THEN 1 ELSE 0 END)"
    stays = "x[3:3] IN ('n', 't')"
    keep = lambda w, who: f"CASE WHEN {stays} AND x[1:1] = '{who}' THEN {then(w, 'K', extra)} END"
    rerole = lambda w: f"CASE WHEN {stays} THEN {then(w, 'R', f'(2 + {extra})')} END"
    dropped = [then(f"f[{i}]", "D", 3) for i in (1, 2, 3, 4)]
    user = [g for i in (1, 2, 4) for g in (keep(f"f[{i}]", "u"), rerole(f"f[{i}]"))]
    row = f"[{dropped[0]}, least({dropped[1]}, {keep('f[1]', 's')}), least({dropped[2]}, {', '.join(user)}), least({dropped[3]}, {keep('f[3]', 'a')}, {rerole('f[3]')})]"
    step = f"list_transform([{free}], lambda f: {row})[1]"
    # the first element is the list before any row, the others are one-element lists with the row's symbol
    folded = f"list_reduce(list_transform(l, lambda y: [y]), lambda a, s: list_transform(s, lambda x: {step})[1], ['000000', NULL, NULL, NULL])"
    return f"list_transform([{folded}], lambda a: {free})[1]"


ORACLES["op12_turn_repair"] = rf"""
WITH RECURSIVE {CRC}, marked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32("(CAST(conv_id AS VARCHAR) || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS what
  FROM conversations, crc WHERE conv_id IS NOT NULL
), damaged AS (
  SELECT conv_id, turn, copy, sha256(length(role) || ':' || role || text) AS tie, CASE WHEN what = 4 THEN 'user' ELSE role END AS role,
         CASE what WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM marked, unnest(CASE WHEN what = 3 THEN [0, 1] ELSE [0] END) AS u(copy) WHERE what <> 0
), placed AS (
  SELECT *, row_number() OVER w AS pos, left(role, 1) AS initial, lag(left(role, 1)) OVER w || left(role, 1) AS pair
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tie, copy)
), faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE 'n' END AS fault
  FROM placed
), conv AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'b') AS blank, count_if(fault = 'd') AS duplicate,
         count_if(fault = 't') AS truncated, count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal, list(rpad(initial, 1, '-') || ':' || fault ORDER BY pos) AS l
  FROM faults GROUP BY conv_id
), solved AS (
  SELECT * EXCLUDE l, least(w[1], w[4]) AS way FROM (SELECT *, {_cheapest_repair()} AS w FROM conv)
), edits AS (
  SELECT conv_id, i, substr(way, 6 + i, 1) AS e, count_if(substr(way, 6 + i, 1) <> 'I') OVER (PARTITION BY conv_id ORDER BY i) AS pos
  FROM solved, unnest(range(1, length(way) - 5)) AS u(i)
), kept AS (
  SELECT e.conv_id, e.i, e.e, f.role, f.text, e.e = 'K' AND f.initial = 's' AND row_number() OVER (PARTITION BY e.conv_id ORDER BY e.i) = 1 AS system
  FROM edits e LEFT JOIN faults f ON f.conv_id = e.conv_id AND f.pos = e.pos AND e.e <> 'I' WHERE e.e <> 'D'
), told AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY conv_id, system ORDER BY i) % 2 = 1 THEN 'user' ELSE 'assistant' END AS fits FROM kept
), hashed AS (
  SELECT conv_id, sha256(string_agg(CASE e WHEN 'K' THEN role || ':' || text WHEN 'R' THEN fits || ':' || text ELSE fits || ':' END, chr(10) ORDER BY i)) AS sha
  FROM told GROUP BY conv_id
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
       coalesce(CAST(way[1:6] AS BIGINT), 0) AS cost, coalesce(way[7:], '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM marked) LEFT JOIN solved USING (conv_id) LEFT JOIN hashed USING (conv_id)
"""

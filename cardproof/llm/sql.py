"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

SQL: dict[str, str] = {}

_WHITE = r"[\x20\x09-\x0D]+"

SQL["op4_hyperminhash_dedup"] = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '{_WHITE}'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
classes AS (SELECT s, min(doc_id) AS rep FROM (SELECT doc_id, list_sort(s) AS s FROM sets WHERE len(s) > 0) GROUP BY s),
rep_members AS (SELECT m.* FROM members m SEMI JOIN classes c ON m.doc_id = c.rep),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM rep_members a JOIN rep_members b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach AS (SELECT rep AS node, rep AS other FROM classes UNION
          SELECT reach.node, links.b FROM reach JOIN links ON reach.other = links.a),
named AS (SELECT node, min(other) AS component FROM reach GROUP BY node)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(n.component, d.doc_id) AS component_id,
  coalesce(n.component, d.doc_id) = d.doc_id AS kept
FROM sets d LEFT JOIN classes c ON list_sort(d.s) = c.s LEFT JOIN named n ON n.node = c.rep
"""

SQL["op5_source_mixing"] = rf"""
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
per_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
weighted AS (
  SELECT *, [1, 2, 3][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS weight FROM per_source),
levels AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) / weight AS full_at,
    CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS DOUBLE)
      / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level
  FROM weighted
  WINDOW before AS (ORDER BY CAST(3 * source_size AS DOUBLE) / weight, encode(source) NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), weight * coalesce(
    (SELECT arg_min(level, full_at) FROM levels WHERE full_at > level), 'infinity'::DOUBLE)) AS target FROM levels),
rates AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    CAST(CAST('0x' || substr(md5('mix:' || doc_id), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS draw
  FROM sizes JOIN targets ON sizes.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rates
"""

SQL["op6_benchmark_decontamination"] = r"""
WITH doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
item_words AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark),
spans AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2),
    lambda i: array_to_string(w[i:i + least(13, len(w)) - 1], ' '))) AS x FROM item_words WHERE len(w) > 0),
grams AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS pos,
    unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS x
  FROM doc_words, (SELECT DISTINCT n FROM spans) WHERE len(w) >= n),
hits AS (SELECT doc_id, item_id, pos, grams.n FROM grams JOIN spans ON grams.x = spans.x AND grams.n = spans.n),
places AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(pos, pos + n)) AS p FROM (SELECT DISTINCT doc_id, pos, n FROM hits)) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_KINDS = [
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    ("access", "AKIA[A-Z0-9]+", 18, 0),
    ("hex", "[0-9a-f]{16,}", 16, 0),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 1, 0),
    ("vendor", "(?:gh[pousr]_|xox[abprs]-|sk_live_|sk-)[A-Za-z0-9_-]{16,}", 1, 0),
    ("mixed", "[A-Za-z0-9+/_=-]{24,}", 24, 0),
]
_CUT = " UNION ALL ".join(
    f"""SELECT doc_id, source, {n} AS rank, '{name}' AS kind, p.first, p.first + length(p.found) AS last,
      {f"regexp_extract(p.found, '{pattern}', {group})" if group else "p.found"} AS value, {least} AS least
    FROM (SELECT doc_id, source, unnest(list_transform(range(2, len(parts) + 1, 2), lambda i: {{'first':
      CAST(coalesce(list_sum(list_transform(parts[1:i - 1], lambda x: length(x))), 0) AS BIGINT), 'found': parts[i]}})) AS p
      FROM (SELECT doc_id, source, string_split(regexp_replace(t, '{pattern}', chr(1) || '\\0' || chr(1), 'g'), chr(1)) AS parts
            FROM texts))"""
    for n, (name, pattern, least, group) in enumerate(_KINDS)
)
SQL["op2_secret_ownership"] = f"""
WITH texts AS (SELECT doc_id, source, replace(coalesce(text, ''), chr(1), chr(2)) AS t FROM documents),
found AS (SELECT * FROM ({_CUT}) WHERE length(value) >= least),
owned AS (
  SELECT value, count(DISTINCT doc_id) AS repositories, count(DISTINCT coalesce(source, chr(0))) >= 3 OR count(DISTINCT doc_id) >= 100 AS example
  FROM found GROUP BY value),
judged AS (
  SELECT found.*, repositories, example, kind || ':' || first || ':' || last AS span FROM found JOIN owned USING (value)
  WHERE kind <> 'mixed' OR (NOT example AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[0-9]'))),
counted AS (
  SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
    string_agg(span, ',' ORDER BY first, rank) FILTER (rank < 3) AS base, string_agg(span, ',' ORDER BY first, rank) AS spans,
    count(*) FILTER (NOT example AND len(list_distinct(string_split(value, ''))) >= 6) AS n_live, count(*) FILTER (example) AS n_example,
    max(repositories) AS max_repositories
  FROM judged GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example,
  coalesce(max_repositories, 0) AS max_repositories
FROM documents d LEFT JOIN counted USING (doc_id)
"""

SQL["op10_repeated_bytes"] = """
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS row, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
windows AS (
  SELECT row, unnest(range(0, n - 199)) AS i, unnest(list_transform(range(0, n - 199), lambda i: md5(substr(x, 2 * i + 1, 400)))) AS w
  FROM texts WHERE n >= 200),
starts AS (SELECT row, i FROM windows WHERE w IN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1)),
marked AS (SELECT row, i, i > coalesce(lag(i) OVER (PARTITION BY row ORDER BY i), -1000) + 200 AS fresh FROM starts),
numbered AS (SELECT row, i, sum(CAST(fresh AS INT)) OVER (PARTITION BY row ORDER BY i) AS run FROM marked),
runs AS (SELECT row, run, min(i) AS a, max(i) + 200 AS b FROM numbered GROUP BY row, run),
pieces AS (
  SELECT r.row, r.a, r.b, run, substr(x, 2 * coalesce(lag(r.b) OVER (PARTITION BY r.row ORDER BY r.a), 0) + 1,
    2 * (r.a - coalesce(lag(r.b) OVER (PARTITION BY r.row ORDER BY r.a), 0))) AS kept FROM runs r JOIN texts USING (row)),
per_row AS (SELECT row, count(*) AS n_spans, sum(b - a) AS n_removed, string_agg(kept, '' ORDER BY a) AS kept, max(b) AS tail FROM pieces GROUP BY row)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN per_row.row IS NULL THEN x ELSE kept || substr(x, 2 * tail + 1) END)) AS kept_sha256
FROM texts LEFT JOIN per_row USING (row)
"""

_CRC = """xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(s) + 1), lambda i: CAST(ascii(substr(s, i, 1)) AS BIGINT))),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)),
      lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)"""
SQL["op11_conversation_trie"] = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x, turn FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) AS s,
    list({{'k': md5(r || chr(0) || x), 'n': length(x)}} ORDER BY turn NULLS FIRST, r, x) AS turns FROM turns GROUP BY conv_id),
headed AS (SELECT *, {_CRC} % 6 AS h FROM own),
paths AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) AS path
  FROM headed o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
members AS (SELECT conv_id, d, path[1:d] AS p, path, len(path) AS n FROM paths, unnest(range(0, len(path) + 1)) AS u(d)),
nodes AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, count(DISTINCT path[d + 1].k) FILTER (n > d) AS n_children,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (d = n), '')) AS ends_sha256
  FROM members GROUP BY p, d),
below AS (
  SELECT p[1:k] AS p, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * CASE WHEN d > 0 THEN p[d].n ELSE 0 END) AS saved
  FROM nodes, unnest(range(0, d + 1)) AS u(k) GROUP BY p[1:k])
SELECT nodes.conv_id, nodes.d AS depth, above.conv_id AS parent_conv_id, nodes.n_convs, nodes.n_children, n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, nodes.ends_sha256
FROM nodes JOIN below ON below.p = nodes.p LEFT JOIN nodes above ON nodes.d > 0 AND above.p = nodes.p[1:nodes.d - 1]
"""

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
SQL["op13_ranked_search"] = f"""
WITH words AS (SELECT doc_id, unnest({_TERMS}) AS t FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
corpus AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM lengths),
counts AS (SELECT doc_id, t, count(*) AS tf FROM words GROUP BY doc_id, t),
weights AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counts, corpus GROUP BY t, big_n),
norms AS (SELECT doc_id, 25 + (75 * n * big_n) // big_l AS m FROM lengths, corpus),
asked AS (SELECT item_id, t, count(*) AS q FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark) GROUP BY item_id, t),
scored AS (
  SELECT item_id, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (t) JOIN counts USING (t) JOIN norms USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

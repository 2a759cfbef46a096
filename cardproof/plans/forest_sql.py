"""DuckDB SQL that draws, grows and scores an isolation forest by the same rules as ``operators.forest``."""

from __future__ import annotations

from cardproof.operators.forest import CONTAMINATION, EULER_GAMMA, MAX_SAMPLES, SEED, TREES


def _text(number: str) -> str:
    """A double as Spark writes it: below 0.001 with an exponent."""
    plain = rf"regexp_replace(CAST({number} AS VARCHAR), '^(-?)0\.000([1-9])([0-9]*)$', '\1\2.\3E-4')"
    exponent = rf"regexp_replace(regexp_replace({plain}, 'e-0?', 'E-'), '^(-?[0-9])E', '\1.0E')"
    return f"replace({exponent}, '.E', '.0E')"


def _number(digest: str, start: int, digits: int) -> str:
    return f"CAST('0x' || substr({digest}, {start}, {digits}) AS BIGINT)"


def average_path(size: str) -> str:
    length = f"2 * (ln(CAST({size} AS DOUBLE) - 1) + {EULER_GAMMA}) - 2 * (CAST({size} AS DOUBLE) - 1) / {size}"
    return f"CASE WHEN {size} <= 1 THEN 0 WHEN {size} = 2 THEN 1 ELSE floor(({length}) * 4294967296 + 0.5) / 4294967296 END"


def samples(rows: str, trees: int = TREES, seed: int = SEED) -> str:
    """WITH clauses ``data`` (id, key, x), ``size_of`` (n, height) and ``samples`` (tree, key, x) of rows (key, x)."""
    return f"""
    data AS (SELECT row_number() OVER (ORDER BY key, x) AS id, * FROM ({rows})),
    size_of AS (
        SELECT count(*) AS rows, least({MAX_SAMPLES}, count(*)) AS n,
               CAST(ceil(log2(greatest(2, least({MAX_SAMPLES}, count(*))))) AS INTEGER) AS height,
               least(CAST({trees} AS DOUBLE),
                     CAST(1.5 AS DOUBLE) * {trees} * least({MAX_SAMPLES}, count(*)) / greatest(count(*), 1)) AS wanted,
               list_filter(range(1, {trees + 1}), lambda n: gcd(n, {trees}) = 1) AS strides
        FROM data),
    digested AS (
        SELECT *, sha256(concat_ws('|', key, array_to_string(list_transform(x, lambda v: {_text('v')}), ','),
                                   '{seed}')) AS digest
        FROM data),
    picked AS (
        SELECT d.*, strides, CAST(floor(wanted) AS BIGINT)
                   + CAST({_number('digest', 1, 12)} < floor((wanted - floor(wanted)) * 281474976710656) AS BIGINT) AS picks
        FROM digested d, size_of),
    candidates AS (
        SELECT key, x, digest, ({_number('digest', 21, 8)}
                   + turn * strides[1 + {_number('digest', 13, 8)} % len(strides)]) % {trees} AS tree
        FROM (SELECT *, unnest(range(picks)) AS turn FROM picked)),
    samples AS (
        SELECT CAST(tree AS INTEGER) AS tree, key, x FROM (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY sha256(digest || ':' || tree), key, x) AS place
            FROM candidates), size_of
        WHERE place <= n)"""


def _split(source: str, seed: int) -> str:
    """Feature ``f`` (from 1, null at a leaf) and threshold ``t`` of nodes (tree, node, depth, points)."""
    extreme = lambda name: f"list_transform(range(1, len(points[1]) + 1), lambda i: {name}(list_transform(points, lambda p: p[i])))"
    return f"""
    SELECT tree, node, depth, points, f, CASE WHEN cut < high[f] THEN cut ELSE low[f] END AS t FROM (
        SELECT *, low[f] + {_number('digest', 9, 12)} / CAST(281474976710656 AS DOUBLE) * (high[f] - low[f]) AS cut FROM (
            SELECT *, CASE WHEN depth < height AND len(varying) > 0
                           THEN varying[1 + {_number('digest', 1, 8)} % len(varying)] END AS f
            FROM (SELECT *, list_filter(range(1, len(low) + 1), lambda i: low[i] < high[i]) AS varying,
                         sha256('{seed}:' || tree || ':' || node) AS digest
                  FROM (SELECT *, {extreme('list_min')} AS low, {extreme('list_max')} AS high
                        FROM {source}, size_of))))"""


def nodes(rows: str, trees: int = TREES, seed: int = SEED) -> str:
    """WITH clauses up to ``nodes``, the fitted forest."""
    return f"""
    {samples(rows, trees, seed)},
    grown(tree, node, depth, points) AS (
        SELECT tree, CAST(0 AS INTEGER), 0, list(x) FROM samples GROUP BY tree
        UNION ALL
        SELECT tree, 2 * node + side, depth + 1, list_filter(points, lambda p: (p[f] <= t) = (side = 1))
        FROM ({_split('grown', seed)}), (VALUES (1), (2)) sides(side)
        WHERE f IS NOT NULL),
    nodes AS (
        SELECT tree, node, CAST(coalesce(f, 0) - 1 AS INTEGER) AS feature, t AS threshold,
               CAST(len(points) AS INTEGER) AS size, depth
        FROM ({_split('grown', seed)}))"""


def scores(rows: str, trees: int = TREES, seed: int = SEED) -> str:
    """WITH clauses up to ``scores`` (id, key, raw_score), every row walked down every tree."""
    return f"""
    {nodes(rows, trees, seed)},
    walk(id, tree, node) AS (
        SELECT id, tree, 0 FROM data, (SELECT DISTINCT tree FROM nodes)
        UNION ALL
        SELECT id, tree, 2 * node + CASE WHEN x[feature + 1] <= threshold THEN 1 ELSE 2 END
        FROM walk JOIN nodes USING (tree, node) JOIN data USING (id) WHERE feature >= 0),
    paths AS (
        SELECT id, sum(depth + {average_path('size')}) / count(*) AS path
        FROM walk JOIN nodes USING (tree, node) WHERE feature < 0 GROUP BY id),
    scores AS (
        SELECT data.*, -pow(2, -path / greatest({average_path('n')}, 1e-12)) AS raw_score
        FROM paths JOIN data USING (id), size_of)"""


def signals(rows: str, contamination: float = CONTAMINATION, trees: int = TREES, seed: int = SEED) -> str:
    """WITH clauses up to ``signals`` (id, key, anomaly_score, is_predicted_fraud)."""
    return f"""
    {scores(rows, trees, seed)},
    signals AS (
        SELECT *, raw_score - o AS anomaly_score, raw_score - o < 0 AS is_predicted_fraud
        FROM scores, (SELECT quantile_cont(raw_score, {contamination}) AS o FROM scores))"""

"""DuckDB SQL for the queries of ``fixture_queries``, by the same names."""

from __future__ import annotations

from cardproof.plans import forest_sql

_TX = """
    SELECT CAST(date_diff('second', TIMESTAMP '2024-01-01', date_trunc('second', ts)) AS DOUBLE) AS "Time",
           CAST(user_id AS DOUBLE) AS "V1", CAST(event_id AS DOUBLE) AS "V2", value AS "Amount",
           CAST(event_type = 'error' AS INTEGER) AS "Class"
    FROM events"""

_GAPS = f"""
    SELECT "Time", CASE WHEN "Class" = 0 THEN "V1" END AS "V1",
           CASE WHEN "Amount" <= 100 THEN "V2" END AS "V2", "Amount", "Class"
    FROM ({_TX})"""


def _band(amount: str) -> str:
    return (
        f"CASE WHEN {amount} < 10 THEN '0-10' WHEN {amount} < 50 THEN '10-50' "
        f"WHEN {amount} < 200 THEN '50-200' WHEN {amount} < 1000 THEN '200-1000' ELSE '1000+' END"
    )


_SILVER = f"""
    SELECT *, TIMESTAMP '2024-01-01' + to_seconds(CAST("Time" AS BIGINT)) AS transaction_ts,
           CAST(TIMESTAMP '2024-01-01' + to_seconds(CAST("Time" AS BIGINT)) AS DATE) AS transaction_date,
           CAST(hour(TIMESTAMP '2024-01-01' + to_seconds(CAST("Time" AS BIGINT))) AS INTEGER)
               AS transaction_hour,
           {_band('"Amount"')} AS amount_bucket, "Class" = 1 AS is_fraud,
           round(ln(1 + "Amount"), 9) AS amount_log1p
    FROM ({_TX})"""


def _daily(source: str) -> str:
    return f"""
    SELECT transaction_date, count(*) AS total_transactions,
           CAST(sum(CAST(is_fraud AS INTEGER)) AS BIGINT) AS fraud_count,
           round(sum(CAST(is_fraud AS INTEGER)) / count(*), 6) AS fraud_rate,
           round(sum("Amount"), 6) AS total_volume, round(avg("Amount") + 1e-9, 6) AS avg_amount,
           round(max("Amount"), 6) AS max_amount
    FROM ({source}) GROUP BY transaction_date"""


_COUNTS = f"""
    SELECT transaction_date, transaction_hour, amount_bucket, count(*) AS transactions
    FROM ({_SILVER}) GROUP BY ALL"""


def _dominant(counts: str) -> str:
    return f"""
    SELECT transaction_date, transaction_hour, amount_bucket FROM (
        SELECT *, row_number() OVER (PARTITION BY transaction_date, transaction_hour
                                     ORDER BY transactions DESC, amount_bucket) AS place
        FROM ({counts})) WHERE place = 1"""


def _hourly(source: str) -> str:
    counts = f"""
    SELECT transaction_date, transaction_hour, amount_bucket, count(*) AS transactions
    FROM ({source}) GROUP BY ALL"""
    return f"""
    SELECT b.transaction_date, b.transaction_hour, b.total_transactions, b.fraud_count, b.avg_amount,
           d.amount_bucket
    FROM (SELECT transaction_date, transaction_hour, count(*) AS total_transactions,
                 CAST(sum(CAST(is_fraud AS INTEGER)) AS BIGINT) AS fraud_count,
                 round(avg("Amount") + 1e-9, 6) AS avg_amount
          FROM ({source}) GROUP BY ALL) b
    LEFT JOIN ({_dominant(counts)}) d
      ON b.transaction_date = d.transaction_date AND b.transaction_hour = d.transaction_hour"""


_KEY = """sha256(concat_ws('|', CAST("Time" AS VARCHAR), CAST("Amount" AS VARCHAR)))"""
_CONTENT = ("Time", "V1", "V2", "Amount", "Class")


def _hash(columns, null_text: str | None = None) -> str:
    texts = [f'CAST("{c}" AS VARCHAR)' for c in columns]
    if null_text:
        texts = [f"coalesce({t}, {null_text})" for t in texts]
    return f"sha256(concat_ws('|', {', '.join(texts)}))"


_LINE_ITEM_TEXT = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)
_LINE_ITEMS = """(SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate) FROM lineitem)"""

_CSV = f"""
    SELECT "Time", "V1", "V2", CASE WHEN "Amount" <= 300 THEN "Amount" END AS "Amount",
           CASE WHEN "V1" IS NULL OR "V1" >= 20 THEN "Class" END AS "Class", "Amount" > 300 AS much
    FROM ({_GAPS})"""


def _roots(leaves: str) -> str:
    """Roots of ``leaves(g, h)`` as ``(g, leaf_count, merkle_root)``."""
    return f"""
    WITH RECURSIVE tree(g, n, l) AS (
        SELECT g, count(*), list(h ORDER BY h) FROM ({leaves}) GROUP BY g
        UNION ALL
        SELECT g, n, list_transform(range(1, len(l) + 1, 2),
                                    lambda i: sha256(l[i] || coalesce(l[i + 1], l[i])))
        FROM tree WHERE len(l) > 1)
    SELECT g, n AS leaf_count, l[1] AS merkle_root FROM tree WHERE len(l) = 1"""


_BATCHES = f"""
    SELECT *, {_hash(_CONTENT)} AS row_hash,
           CAST(DATE '2024-01-01' + CAST(floor("Time" / 86400) AS INTEGER) AS VARCHAR) AS batch_id
    FROM ({_TX})"""

_BATCH_ROOTS = _roots(f"SELECT batch_id AS g, row_hash AS h FROM ({_BATCHES})")

_ATTACKED = f"""
    SELECT "Time", "V1", "V2", CASE WHEN "V1" = 7 THEN "Amount" + 1 ELSE "Amount" END AS "Amount", "Class",
           batch_id, CASE WHEN "V1" <> 11 THEN row_hash END AS row_hash
    FROM ({_BATCHES})
    WHERE CASE WHEN "V1" = 7 THEN "Amount" + 1 ELSE "Amount" END <= 400 AND batch_id <> '2024-01-20'"""

_VECTORS = "SELECT CAST(vec_id AS VARCHAR) AS key, CAST(embedding AS DOUBLE[]) AS x FROM embeddings"
_SCORED_EVENTS = """
    SELECT CAST(event_id AS VARCHAR) AS key, [CAST(user_id AS DOUBLE), CAST(hour(ts) AS DOUBLE), value] AS x FROM events"""
_KEYED_EVENTS = f"""
    SELECT {_KEY} AS key, ["V1", "V2", "Amount"] AS x, "Class" = 1 AS is_fraud FROM ({_TX})"""

def _ranged(leaves: str) -> str:
    """Leaves (batch_id, h) counted and summed by their first character."""
    digits = lambda start: f"sum(CAST('0x' || substr(sha256(h), {start}, 15) AS HUGEINT))"
    return f"""
    SELECT batch_id, substr(h, 1, 1) AS leaf_range, count(*) AS leaf_count, {digits(1)} || ':' || {digits(16)} AS digest
    FROM ({leaves}) GROUP BY ALL"""


_RECHECKED = f"SELECT *, {_hash(_CONTENT)} AS recomputed FROM ({_ATTACKED})"

_VERIFIED = f"""
    WITH rows_now AS ({_RECHECKED}),
    recorded AS (SELECT * FROM ({_BATCH_ROOTS}) WHERE g <> '2024-01-05'),
    per_batch AS (
        SELECT batch_id, count(*) AS row_count,
               count(*) FILTER (WHERE row_hash IS DISTINCT FROM recomputed) AS tampered_row_count
        FROM rows_now GROUP BY batch_id),
    stored AS ({_roots("SELECT batch_id AS g, coalesce(row_hash, '') AS h FROM rows_now")}),
    again AS ({_roots("SELECT batch_id AS g, recomputed AS h FROM rows_now")}),
    joined AS (
        SELECT coalesce(p.batch_id, r.g) AS batch_id, coalesce(p.row_count, 0) AS row_count,
               r.leaf_count AS recorded_row_count, coalesce(p.tampered_row_count, 0) AS tampered_row_count,
               r.merkle_root AS recorded_root, coalesce(s.merkle_root, '') AS root_over_stored,
               coalesce(a.merkle_root, '') AS root_over_recomputed, p.batch_id IS NOT NULL AS present
        FROM per_batch p JOIN stored s ON s.g = p.batch_id JOIN again a ON a.g = p.batch_id
        FULL JOIN recorded r ON r.g = p.batch_id),
    checked AS (
        SELECT *, recorded_row_count IS NOT DISTINCT FROM row_count AS row_count_match,
               coalesce(recorded_root = root_over_stored AND recorded_root = root_over_recomputed, false)
                   AS merkle_match
        FROM joined),
    verdicts AS (
        SELECT *, tampered_row_count = 0 AND merkle_match AND row_count_match AS clean FROM checked)
    SELECT batch_id, row_count, recorded_row_count, tampered_row_count, recorded_root, root_over_stored,
           root_over_recomputed, row_count_match, merkle_match, clean,
           CASE WHEN recorded_root IS NULL THEN 'no_manifest' WHEN clean THEN 'clean'
                WHEN NOT present THEN 'missing_batch' ELSE 'violated' END AS status
    FROM verdicts"""

_LOG = f"""
    SELECT g AS batch_id, 'bronze' AS layer, leaf_count AS row_count, merkle_root
    FROM ({_BATCH_ROOTS}) WHERE g <> '2024-01-05'"""

# what the two overlapping loads leave in silver: a key belongs to the first load that has it
_LOADED = f"""
    SELECT "Time", "V1", "V2", "Amount", "Class",
           CASE WHEN floor("Time" / 86400) < 20 THEN '2024-02-01' ELSE '2024-02-02' END AS ingest_date,
           {_KEY} AS row_key, {_hash(_CONTENT)} AS row_hash,
           transaction_date, transaction_hour, amount_bucket, is_fraud
    FROM ({_SILVER})
    QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY ingest_date, row_hash) = 1"""

_BRONZE = f"""
    SELECT ingest_date AS g, row_hash AS h FROM (
        SELECT CASE WHEN floor("Time" / 86400) < 20 THEN '2024-02-01' ELSE '2024-02-02' END AS ingest_date,
               {_hash(_CONTENT)} AS row_hash
        FROM (SELECT * FROM ({_TX}) UNION ALL SELECT * FROM ({_TX}) WHERE "Class" = 1))"""

SQL: dict[str, str] = {
    "row_keys": f'SELECT "V2", {_KEY} AS row_key FROM ({_TX})',
    "row_hash": f'SELECT "V2", {_hash(_CONTENT)} AS row_hash FROM ({_TX})',
    "row_hash_lineitem": f"SELECT l_orderkey, l_linenumber, {_hash(_LINE_ITEM_TEXT)} AS row_hash FROM {_LINE_ITEMS}",
    "row_hash_schemes": f"""
        SELECT "Time", "Amount", {_hash(_CONTENT)} AS hash_v1, {_hash(_CONTENT, "chr(0)")} AS hash_v2
        FROM ({_GAPS})""",
    "ingest_metadata": f"""
        SELECT "V2", '2024-02-01' AS ingest_date, 'events' AS source_file, '1.0.0' AS pipeline_version,
               {_KEY} AS row_key
        FROM ({_TX})""",
    "enrich": _SILVER,
    "amount_buckets": f"""
        SELECT {_band("amount")} AS amount_bucket, count(*) AS rows
        FROM (SELECT value AS amount FROM events UNION ALL SELECT o_totalprice FROM orders) GROUP BY 1""",
    "drop_missing_rows": f"""
        SELECT * FROM ({_TX}) WHERE "V1" >= 10 AND "Class" = 0""",
    "dedup_latest": """
        SELECT * FROM lineitem QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice) = 1""",
    "daily_summary": _daily(_SILVER),
    "hourly_summary_onepass": _hourly(_SILVER),
    "hourly_summary_join": _hourly(_SILVER),
    "bucket_counts": _COUNTS,
    "dominant_bucket": _dominant(_COUNTS),
    "top_fraud_days": f"""
        SELECT transaction_date, total_transactions, fraud_count, fraud_rate, total_volume
        FROM ({_daily(_SILVER)}) ORDER BY fraud_count DESC, transaction_date LIMIT 10""",
    "csv_ingest": f"""
        SELECT "Time", "V1", "V2", "Amount", "Class" FROM ({_CSV})
        WHERE "Amount" IS NOT NULL AND "Class" IS NOT NULL""",
    "csv_scan": f'SELECT "Time", "V1", "V2", "Amount", "Class" FROM ({_CSV})',
    "csv_rejects": f"""
        SELECT "Time", "V1", "V2", "Amount", "Class", CASE WHEN much THEN
            concat_ws(',', CAST("Time" AS VARCHAR), coalesce(CAST("V1" AS VARCHAR), ''),
                      coalesce(CAST("V2" AS VARCHAR), ''), 'much', coalesce(CAST("Class" AS VARCHAR), ''))
            END AS raw_line
        FROM ({_CSV}) WHERE "Amount" IS NULL OR "Class" IS NULL""",
    "partitioned_table": f"""
        SELECT *, CAST(DATE '2024-01-01' + CAST(floor("Time" / 86400) AS INTEGER) AS VARCHAR) AS ingest_date
        FROM ({_TX})""",
    "overwritten_table": "SELECT * REPLACE (round(o_totalprice + 1, 2) AS o_totalprice) FROM orders",
    "insert_only_merge": """
        SELECT * REPLACE (round(o_totalprice, 2) AS o_totalprice) FROM orders WHERE o_orderstatus = 'F'
        UNION ALL
        SELECT * REPLACE (round(o_totalprice + 1, 2) AS o_totalprice) FROM (
            SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'P') s
        WHERE NOT EXISTS (
            SELECT 1 FROM orders t WHERE t.o_orderstatus = 'F' AND t.o_orderkey = s.o_orderkey)""",
    "ingest_times": f"""
        SELECT "V2", '2024-03-01' AS ingest_date, '2024-03-01 00:00:00' AS ingest_ts FROM ({_TX})""",
    "summary_times": f"""
        SELECT DISTINCT transaction_date, CAST(NULL AS INTEGER) AS transaction_hour, '2024-03-01 00:00:00' AS updated_ts
        FROM ({_SILVER})
        UNION ALL SELECT DISTINCT transaction_date, transaction_hour, '2024-03-01 00:00:00' FROM ({_SILVER})""",
    "hourly_order": f"""
        SELECT *, CAST(row_number() OVER (ORDER BY transaction_date, transaction_hour) AS INTEGER) AS place
        FROM (SELECT DISTINCT transaction_date, transaction_hour FROM ({_SILVER}))""",
    "insert_within": """
        SELECT * REPLACE (round(o_totalprice, 2) AS o_totalprice) FROM orders
        UNION ALL
        SELECT * REPLACE ('F' AS o_orderstatus, round(o_totalprice + 1, 2) AS o_totalprice) FROM orders
        WHERE o_orderstatus = 'P'""",
    "insert_null_keys": """
        WITH t AS (
            SELECT * REPLACE (CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END AS o_orderkey)
            FROM orders)
        SELECT * FROM t UNION ALL
        SELECT * FROM t s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)""",
    "upsert_merge": """
        SELECT * REPLACE (round(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice * 2 END, 2)
                          AS o_totalprice) FROM orders""",
    "upsert_moves_partition": """
        SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus)
        FROM orders""",
    "upsert_repeated_target": """
        SELECT t.l_orderkey, t.l_linenumber, coalesce(s.q, t.l_quantity) AS l_quantity
        FROM lineitem t LEFT JOIN (
            SELECT l_orderkey, l_linenumber, max(l_quantity) + 100 AS q FROM lineitem
            WHERE l_quantity >= 10 GROUP BY ALL) s USING (l_orderkey, l_linenumber)""",
    "upsert_composite": f"""
        SELECT * FROM ({_hourly(f'SELECT * FROM ({_SILVER}) WHERE transaction_date < DATE {chr(39)}2024-01-10{chr(39)}')})
        UNION ALL
        SELECT * FROM ({_hourly(
            f'SELECT * REPLACE ("Amount" * 3 AS "Amount") FROM ({_SILVER}) '
            f'WHERE transaction_date >= DATE {chr(39)}2024-01-10{chr(39)}'
        )})""",
    "insert_nan_keys": """
        SELECT CASE WHEN o_orderkey <> 1 THEN CAST(o_orderkey AS DOUBLE) END AS k, o_orderstatus,
               round(o_totalprice, 2) AS o_totalprice FROM orders""",
    "upsert_nan_keys": """
        SELECT CASE WHEN o_orderkey <> 1 THEN CAST(o_orderkey AS DOUBLE) END AS k, o_orderstatus,
               round(CASE WHEN o_orderkey <= 100 THEN o_totalprice * 2 ELSE o_totalprice END, 2) AS o_totalprice FROM orders""",
    "repeated_keys": """
        SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "partition_pruned_read": f"""
        SELECT CAST(transaction_date AS VARCHAR) AS ingest_date, count(*) AS rows, max("Amount") AS max_amount
        FROM ({_SILVER}) WHERE transaction_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-11' GROUP BY 1""",
    "clustered_layout": f"""
        SELECT '2024-02-01' AS ingest_date, {_KEY} AS row_key, transaction_date, "Amount"
        FROM ({_SILVER}) WHERE transaction_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-11'""",
    "merkle_root_lineitem": f"""
        SELECT leaf_count, merkle_root
        FROM ({_roots(f"SELECT 1 AS g, {_hash(_LINE_ITEM_TEXT)} AS h FROM {_LINE_ITEMS}")})""",
    "merkle_root_repeated_leaves": f"""
        SELECT g AS l_linestatus, leaf_count, merkle_root FROM ({_roots(
            f"SELECT l_linestatus AS g, {_hash(('l_returnflag', 'l_linestatus'))} AS h FROM lineitem"
        )})""",
    "merkle_root_by_batch": f"SELECT g AS batch_id, leaf_count, merkle_root FROM ({_BATCH_ROOTS})",
    "manifest_latest": f"SELECT * FROM ({_LOG}) ORDER BY batch_id DESC LIMIT 1",
    "manifest_per_batch": f"""
        SELECT batch_id, row_count + CAST(batch_id >= '2024-01-15' AS BIGINT) AS row_count, merkle_root
        FROM ({_LOG})""",
    "tampered_rows": f"""
        SELECT batch_id, "V1", "V2", row_hash FROM ({_RECHECKED})
        WHERE row_hash IS DISTINCT FROM recomputed""",
    "integrity_batches": _VERIFIED,
    "integrity_verdict": f"""
        SELECT count(*) AS batches, count(*) FILTER (WHERE NOT clean) AS violated_batches,
               CAST(sum(tampered_row_count) AS BIGINT) AS tampered_row_count,
               bool_and(merkle_match) AS merkle_match, bool_and(clean) AS clean
        FROM ({_VERIFIED})""",
    "integrity_findings": f"""
        WITH v AS ({_VERIFIED})
        SELECT batch_id, 'row_hash' AS "check",
               tampered_row_count || ' rows are not what their stored hash says' AS detail
        FROM v WHERE tampered_row_count > 0
        UNION ALL SELECT batch_id, 'merkle_root', 'root ' || recorded_root || ' recorded, ' || root_over_stored || ' over stored and '
            || root_over_recomputed || ' over recomputed hashes' FROM v
        WHERE recorded_root IS NOT NULL AND NOT merkle_match
        UNION ALL SELECT batch_id, 'row_count', recorded_row_count || ' rows recorded, ' || row_count || ' found'
        FROM v WHERE recorded_root IS NOT NULL AND NOT row_count_match
        UNION ALL SELECT batch_id, 'manifest', 'no manifest for this batch' FROM v
        WHERE recorded_root IS NULL""",
    "integrity_ranges": f"""
        WITH found AS (
            SELECT batch_id, {_hash(_CONTENT)} AS h FROM ({_ATTACKED})
            UNION ALL SELECT batch_id, {_hash(_CONTENT)} FROM ({_ATTACKED}) WHERE "V1" = 13),
        was AS ({_ranged(f"SELECT batch_id, row_hash AS h FROM ({_BATCHES})")}),
        now AS ({_ranged("SELECT * FROM found")})
        SELECT coalesce(was.batch_id, now.batch_id) AS batch_id, coalesce(was.leaf_range, now.leaf_range) AS leaf_range,
               coalesce(was.leaf_count, 0) AS recorded_leaf_count, coalesce(now.leaf_count, 0) AS leaf_count,
               CASE WHEN was.leaf_count IS NULL THEN 'added' WHEN now.leaf_count IS NULL THEN 'removed'
                    WHEN now.leaf_count = was.leaf_count THEN 'edited' ELSE 'resized' END AS change
        FROM was FULL JOIN now ON was.batch_id = now.batch_id AND was.leaf_range = now.leaf_range
        WHERE was.digest IS DISTINCT FROM now.digest OR was.leaf_count IS DISTINCT FROM now.leaf_count""",
    "integrity_mixed_schemes": f"""
        SELECT batch_id, count(*) AS row_count, CAST(0 AS BIGINT) AS tampered_row_count,
               batch_id <> '2024-01-05' AS merkle_match, batch_id <> '2024-01-05' AS clean,
               CASE WHEN batch_id = '2024-01-05' THEN 'no_manifest' ELSE 'clean' END AS status
        FROM ({_BATCHES}) GROUP BY batch_id""",
    "integrity_table_scope": f"""
        WITH before AS ({_BATCHES}),
        present AS (
            SELECT * REPLACE (CASE WHEN "V1" = 7 THEN "Amount" + 1 ELSE "Amount" END AS "Amount") FROM before),
        recorded AS ({_roots("SELECT 1 AS g, row_hash AS h FROM before")}),
        computed AS ({_roots("SELECT 1 AS g, row_hash AS h FROM present")}),
        edits AS (SELECT count(*) FILTER (WHERE row_hash IS DISTINCT FROM {_hash(_CONTENT)}) AS n FROM present)
        SELECT n AS tampered_row_count, r.merkle_root = c.merkle_root AS merkle_match, true AS row_count_match,
               r.merkle_root AS stored_root, c.merkle_root AS computed_root,
               n = 0 AND r.merkle_root = c.merkle_root AS clean,
               CASE WHEN n = 0 AND r.merkle_root = c.merkle_root THEN 'clean' ELSE 'violated' END AS status
        FROM edits, recorded r, computed c""",
    "score_threshold": """
        WITH q AS (SELECT quantile_cont(value, 0.002) AS o FROM events)
        SELECT round(any_value(o), 6) AS "offset", count(*) FILTER (WHERE value - o < 0) AS flagged
        FROM events, q""",
    "quantile_narrowed": """
        WITH q AS (SELECT quantile_cont(l_extendedprice, 0.5) AS m, quantile_cont(l_extendedprice, 0.002) AS w
                   FROM lineitem)
        SELECT round(any_value(m), 6) AS median, round(any_value(w), 6) AS low,
               count(*) FILTER (WHERE l_extendedprice < w) AS below
        FROM lineitem, q""",
    "evaluation_metrics": """
        WITH c AS (
            SELECT count(*) AS total_transactions, count(*) FILTER (WHERE toxic = 1) AS flagged_as_anomaly,
                   count(*) FILTER (WHERE quality = 0) AS actual_fraud_in_dataset,
                   count(*) FILTER (WHERE toxic = 1 AND quality = 0) AS fraud_caught_by_model
            FROM labels)
        SELECT *, round(coalesce(fraud_caught_by_model / nullif(flagged_as_anomaly, 0), 0), 3) AS "precision",
               round(coalesce(fraud_caught_by_model / nullif(actual_fraud_in_dataset, 0), 0), 3) AS recall,
               round(coalesce(2 * fraud_caught_by_model
                              / nullif(flagged_as_anomaly + actual_fraud_in_dataset, 0), 0), 3) AS f1
        FROM c""",
    "model_features": f"""
        SELECT "Time", "V1", "V2", "Amount",
               "V1" IS NOT NULL AND "V2" IS NOT NULL AND "Amount" IS NOT NULL AS usable
        FROM ({_GAPS})""",
    "iforest_samples": f"WITH {forest_sql.samples(_VECTORS)} SELECT tree, key AS row_key FROM samples",
    "iforest_event_samples": f"""
        WITH {forest_sql.samples(_SCORED_EVENTS, 20)}
        SELECT tree, key AS event_id, x[1] AS "V1", x[2] AS "V2", x[3] AS value FROM samples""",
    "iforest_tree_shape": f"""
        WITH RECURSIVE {forest_sql.nodes(_SCORED_EVENTS, 20)}
        SELECT tree, node, feature, round(threshold, 6) AS threshold, size, depth FROM nodes""",
    "iforest_scores": f"""
        WITH RECURSIVE {forest_sql.scores(_SCORED_EVENTS, 20)}
        SELECT CAST(key AS BIGINT) AS event_id, round(raw_score, 9) AS raw_score FROM scores""",
    "iforest_signals": f"""
        WITH RECURSIVE {forest_sql.signals(_VECTORS, 0.1)}
        SELECT key AS row_key, round(anomaly_score, 9) AS anomaly_score, is_predicted_fraud,
               label = 0 AS is_actual_fraud
        FROM signals JOIN embeddings ON key = CAST(vec_id AS VARCHAR)""",
    "iforest_events": f"""
        WITH RECURSIVE {forest_sql.signals(_KEYED_EVENTS)},
        c AS (
            SELECT count(*) AS total_transactions, count(*) FILTER (WHERE is_predicted_fraud) AS flagged_as_anomaly,
                   count(*) FILTER (WHERE is_fraud) AS actual_fraud_in_dataset,
                   count(*) FILTER (WHERE is_fraud AND is_predicted_fraud) AS fraud_caught_by_model
            FROM signals)
        SELECT *, round(coalesce(fraud_caught_by_model / nullif(flagged_as_anomaly, 0), 0), 3) AS "precision",
               round(coalesce(fraud_caught_by_model / nullif(actual_fraud_in_dataset, 0), 0), 3) AS recall,
               round(coalesce(2 * fraud_caught_by_model
                              / nullif(flagged_as_anomaly + actual_fraud_in_dataset, 0), 0), 3) AS f1
        FROM c""",
    "iforest_counts": """
        SELECT count(*) AS scored, CAST(ceil(0.1 * (count(*) - 1)) AS BIGINT) AS flagged,
               count(*) FILTER (WHERE label = 0) AS actual, count(DISTINCT vec_id) AS keys
        FROM embeddings""",
    "stages_daily": _daily(_LOADED),
    "stages_hourly": _hourly(_LOADED),
    "gold_incremental": _daily(_LOADED),
    "gold_incremental_hourly": _hourly(_LOADED),
    "stages_silver": f"SELECT *, ingest_date AS batch_id FROM ({_LOADED})",
    "stages_bronze_audit": f"""
        SELECT g AS batch_id, leaf_count AS row_count, leaf_count AS recorded_row_count,
               CAST(0 AS BIGINT) AS tampered_row_count, merkle_root AS recorded_root,
               merkle_root AS root_over_stored, merkle_root AS root_over_recomputed,
               true AS row_count_match, true AS merkle_match, true AS clean, 'clean' AS status
        FROM ({_roots(_BRONZE)})""",
    "stages_signals": f"""
        SELECT count(*) AS scored, CAST(ceil(0.002 * (count(*) - 1)) AS BIGINT) AS flagged,
               count(*) FILTER (WHERE is_fraud) AS actual, count(DISTINCT row_key) AS keys
        FROM ({_LOADED})""",
    "stages_report": f"""
        SELECT CAST(transaction_date - CAST(DATE '2024-01-01' - DATE '2013-09-01' AS INTEGER) AS DATE)
                   AS transaction_date, total_transactions, fraud_count, fraud_rate, total_volume
        FROM ({_daily(_SILVER)}) ORDER BY fraud_count DESC, transaction_date LIMIT 10""",
}

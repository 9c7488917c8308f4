"""DuckDB SQL over the same tables, for each registered query."""

from __future__ import annotations

# The feed after normalising, without load time and source file.
ORDERS = """
SELECT CAST(user_id AS VARCHAR) AS order_id,
  CAST(user_id AS VARCHAR) AS user_id,
  CAST(event_id % 500 + 1 AS VARCHAR) AS product_id,
  CASE WHEN event_type IN ('purchase', 'click') THEN 'u' ELSE 'i' END AS database_operation,
  CAST(value AS DECIMAL(12,2)) AS amount,
  (['credit_card', 'debit_card', 'pix', 'boleto', 'paypal'])[CAST(event_id % 5 + 1 AS INT)] AS payment_method,
  CAST(ts AS DATE) AS event_date,
  ts AS event_timestamp
FROM events
"""

# The feed as it lands.
LANDED = """
SELECT CAST(user_id AS VARCHAR) AS order_id,
  CAST(user_id AS VARCHAR) AS user_id,
  CAST(event_id % 500 + 1 AS VARCHAR) AS product_id,
  CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'purchase' THEN 'Update' WHEN 'click' THEN 'u'
    WHEN 'view' THEN 'I' WHEN 'error' THEN 'delete' END AS database_operation,
  CASE WHEN event_id % 5 = 3 THEN replace(CAST(value AS VARCHAR), '.', ',')
    ELSE CAST(value AS VARCHAR) END AS amount,
  (['credit_card', 'debit_card', 'pix', 'boleto', 'paypal'])[CAST(event_id % 5 + 1 AS INT)] AS payment_method,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS event_timestamp,
  CAST(ts AS DATE) AS event_date
FROM events
"""

# The landed lines of `error` events, which lack the closing brace.
MALFORMED = f"""
SELECT event_date,
  '{{"order_id":' || order_id || ',"user_id":"' || user_id || '","product_id":"' || product_id
  || '","database_operation":"' || database_operation || '","amount":"' || amount
  || '","payment_method":"' || payment_method || '","event_timestamp":"' || event_timestamp || '"'
  AS line
FROM ({LANDED}) WHERE database_operation = 'delete'
"""

# Lands before 11 January, until 20 January, and later.
PART = """CASE WHEN event_date < DATE '2024-01-11' THEN 0
  WHEN event_date <= DATE '2024-01-20' THEN 1 ELSE 2 END"""


def newest(source: str, keys: str = "order_id", order: str = "event_timestamp DESC") -> str:
    return f"""
SELECT * FROM ({source})
QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1
"""


LATEST = newest(ORDERS)

LINEITEM_LATEST = """l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC,
  l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
  l_linestatus DESC"""

PAIR = "order_id, product_id"
OLD_PAIRS = newest(f"SELECT * FROM ({ORDERS}) WHERE event_date < DATE '2024-01-15'", PAIR)
NEW_PAIRS = newest(f"SELECT * FROM ({ORDERS}) WHERE event_date >= DATE '2024-01-15' OR event_date IS NULL", PAIR)

KEYLESS = f"""
SELECT * REPLACE (CASE WHEN payment_method <> 'pix' THEN order_id END AS order_id)
FROM ({ORDERS})
"""

PER_DATE = "FROM events GROUP BY CAST(ts AS DATE)"

LATE_PARTS_WIN = newest(ORDERS, order=f"{PART}, event_timestamp DESC")

# NULL is a key too.
LOAD_METRICS = """
SELECT count(*) AS raw_count, (SELECT count(*) FROM (SELECT DISTINCT user_id FROM events)) AS dedup_count,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT user_id FROM events)) AS removed_count
FROM events"""

ORACLES: dict[str, str] = {
    "landing_write": f"""
SELECT CAST(ts AS DATE) AS event_date, count(*) AS n_rows, count(value) AS n_amounts {PER_DATE}""",
    "landing_scan_declared": LANDED,
    "landing_scan_inferred": f"""
SELECT * REPLACE (CAST(order_id AS BIGINT) AS order_id) FROM ({LANDED})""",
    "landing_partition_prune": f"SELECT * FROM ({LANDED}) WHERE event_date >= DATE '2024-01-16'",
    "quarantine_split": f"""
SELECT event_date, coalesce(n_good, 0) AS n_good, good_amount, coalesce(n_bad, 0) AS n_bad, coalesce(bad_chars, 0) AS bad_chars
FROM (SELECT event_date, count(*) AS n_good, sum(CAST(replace(amount, ',', '.') AS DECIMAL(12,2))) AS good_amount
      FROM ({LANDED}) WHERE database_operation IS DISTINCT FROM 'delete' GROUP BY event_date)
FULL JOIN (SELECT event_date, count(*) AS n_bad, sum(length(line)) AS bad_chars
      FROM ({MALFORMED}) GROUP BY event_date) USING (event_date)""",
    "quarantine_stream": MALFORMED,
    "normalize_orders": ORDERS,
    "parse_amount": """
SELECT event_id, event_type,
  CASE event_type WHEN 'signup' THEN cents
    WHEN 'purchase' THEN ' -' || replace(cents, '.', ',') || ' '
    WHEN 'click' THEN '1,' || cents
    WHEN 'view' THEN cents || '5E3'
    ELSE '99999999999' || cents END AS amount_text,
  CASE event_type WHEN 'signup' THEN CAST(cents AS DECIMAL(12,2))
    WHEN 'purchase' THEN -CAST(cents AS DECIMAL(12,2))
    WHEN 'view' THEN CAST(CAST(cents || '5' AS DECIMAL(18,3)) * 1000 AS DECIMAL(12,2)) END AS amount
FROM (SELECT *, CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS cents FROM events)""",
    "normalize_op": """
SELECT event_id,
  CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'purchase' THEN 'Upsert'
    WHEN 'click' THEN 'U' || event_id WHEN 'view' THEN ' u' || event_id END AS operation_text,
  CASE WHEN event_type IN ('purchase', 'click') THEN 'u' ELSE 'i' END AS database_operation
FROM events""",
    "parse_event_ts": """
SELECT event_id,
  CASE event_type WHEN 'signup' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
    WHEN 'purchase' THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
    WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')
    WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f-03:00')
    ELSE strftime(ts, '%Y-13-%dT%H:%M:%S') END AS timestamp_text,
  CASE event_type WHEN 'signup' THEN date_trunc('second', ts) WHEN 'purchase' THEN ts
    WHEN 'click' THEN ts WHEN 'view' THEN ts + INTERVAL 3 HOUR END AS event_timestamp
FROM events""",
    "lineage_columns": f"""
SELECT CAST(ts AS DATE) AS event_date, count(*) AS n_rows, count(*) AS n_stamped,
  count(*) AS n_from_folder, 1 AS n_load_times {PER_DATE}""",
    "latest_per_key": LATEST,
    "latest_per_key_composite": newest("SELECT * FROM lineitem", "l_orderkey", LINEITEM_LATEST),
    "latest_per_two_keys": newest("SELECT * FROM lineitem", "l_orderkey, l_linenumber", LINEITEM_LATEST),
    "latest_per_key_missing_col": f"SELECT * EXCLUDE (event_timestamp) FROM ({ORDERS})",
    "load_metrics": LOAD_METRICS,
    "observed_counts": LOAD_METRICS,
    "target_count": "SELECT count(*) AS cnt FROM (SELECT DISTINCT user_id FROM events)",
    "upsert_merge": newest(ORDERS, PAIR),
    "upsert_matched": f"SELECT n.* FROM ({NEW_PAIRS}) n JOIN ({OLD_PAIRS}) o USING ({PAIR})",
    "upsert_not_matched": f"""
SELECT n.* FROM ({NEW_PAIRS}) n
WHERE NOT EXISTS (SELECT 1 FROM ({OLD_PAIRS}) o
  WHERE o.order_id = n.order_id AND o.product_id = n.product_id)""",
    "upsert_lineitem": newest(
        "SELECT * FROM lineitem",
        "l_orderkey, l_linenumber",
        f"l_returnflag = 'R' DESC, {LINEITEM_LATEST}",
    ),
    "upsert_out_of_order": LATE_PARTS_WIN,
    "upsert_null_keys": f"""
WITH keyless AS (SELECT *, event_date < DATE '2024-01-11' AS is_first FROM ({KEYLESS}))
SELECT * EXCLUDE (is_first) FROM keyless WHERE order_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY event_timestamp DESC) = 1
UNION ALL
SELECT * EXCLUDE (is_first) FROM keyless WHERE order_id IS NULL
QUALIFY row_number() OVER (PARTITION BY is_first ORDER BY event_timestamp DESC) = 1""",
    "table_ddl": """
SELECT col_name, data_type, (SELECT count(*) FROM events) AS n_values, false AS staging_exists
FROM (VALUES ('order_id', 'string'), ('user_id', 'string'), ('product_id', 'string'),
  ('database_operation', 'string'), ('amount', 'decimal(12,2)'), ('payment_method', 'string'),
  ('event_date', 'date'), ('event_timestamp', 'timestamp'), ('etl_timestamp', 'timestamp'),
  ('source_filename', 'string')) AS t(col_name, data_type)""",
    "table_append": ORDERS,
    "table_overwrite": LATEST,
    "raw_stream_ingest": ORDERS,
    "restart_resume": ORDERS,
    "raw_table_scan": f"""
SELECT event_date, database_operation, count(*) AS n_rows, sum(amount) AS sum_amount
FROM ({ORDERS}) GROUP BY ALL""",
    "raw_table_stream": ORDERS,
    "initial_load": LATEST,
    "initial_load_guard": f"""
SELECT *, 'target_not_empty' AS second_run
FROM ({newest(f"SELECT * FROM ({ORDERS}) WHERE event_date < DATE '2024-01-11'")})""",
    "initial_load_of_nothing": f"SELECT *, 'source_empty' AS first_run FROM ({LATEST})",
    "processed_by_name": f"""
SELECT payment_method, event_date, count(*) AS n_orders, sum(amount) AS total FROM ({LATEST}) GROUP BY ALL""",
    "failed_batch_retried": f"SELECT *, 'failed' AS first_run, 2 AS n_tries FROM ({LATEST})",
    "stream_upsert": LATEST,
    "stream_upsert_out_of_order": LATE_PARTS_WIN,
    "batch_replay": LATEST,
    "bootstrap_then_incremental": LATEST,
}

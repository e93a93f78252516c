"""The same queries in plain SQL, for comparison on another engine."""

from __future__ import annotations

_SHIPMENTS = ("SELECT l.*, s.s_suppkey AS supplier FROM lineitem l "
              "JOIN supplier s ON l.l_suppkey = s.s_suppkey")
_SHIPPED = "coalesce(CAST(l_shipdate AS DATE) > DATE '1997-12-31', false)"
_CHARGED = "coalesce(l_discount > 0 AND l_tax > 0, false)"
_RETURNED = "coalesce(l_returnflag <> 'N', false)"
_KNOWN = "l_linestatus IS NOT NULL"


def _rule_counts(dataset_column: bool) -> str:
    rules = (("shipped after 1997", _SHIPPED), ("discount and tax are positive", _CHARGED),
             ("returned or accepted", _RETURNED), ("line status is known", _KNOWN))
    if dataset_column:
        shape = ("'clean_txs' AS dataset, '{name}' AS name, count(*) FILTER ({ok}) AS passed_records, "
                 "count(*) FILTER (NOT ({ok})) AS failed_records")
    else:
        shape = ("'clean_txs' AS dataset, '{name}' AS expectation, count(*) FILTER ({ok}) AS "
                 "passing_records, count(*) FILTER (NOT ({ok})) AS failing_records")
    parts = [f"SELECT {shape.format(name=name, ok=ok)} FROM rows_in" for name, ok in rules]
    return f"WITH rows_in AS ({_SHIPMENTS}) " + " UNION ALL ".join(parts)


_BALANCE = f"""
SELECT sum(CAST(o_totalprice AS DECIMAL(18,2))) AS bal, n_name AS location_code,
       CAST(o_orderdate AS DATE) AS last_payment_date
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY 2, 3
UNION
SELECT sum(CAST(l_extendedprice AS DECIMAL(18,2))), n_name, CAST(l_shipdate AS DATE)
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
WHERE {_SHIPPED} AND {_CHARGED}
GROUP BY 2, 3
"""

_SCD2_USERS = """
SELECT event_id, user_id, event_type, value, ts AS "__START_AT", next_ts AS "__END_AT"
FROM (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next_ts FROM events)
WHERE event_type <> 'error'
"""


def _tracked(key: str, gone: str, tracked: str, columns: str) -> str:
    return f"""
WITH marked AS (
  SELECT *, {gone} AS gone, {tracked} AS tracked,
         lag({gone}) OVER w AS gone_before, lag({tracked}) OVER w AS tracked_before,
         lead(ts) OVER w AS next_ts
  FROM events WINDOW w AS (PARTITION BY {key} ORDER BY ts)),
opened AS (
  SELECT *, NOT gone AND (gone_before IS NULL OR gone_before
                          OR tracked_before IS DISTINCT FROM tracked) AS opens FROM marked),
placed AS (
  SELECT *, max(CASE WHEN opens THEN ts END) OVER (PARTITION BY {key} ORDER BY ts) AS start_at,
         lead(opens OR gone) OVER (PARTITION BY {key} ORDER BY ts) AS next_breaks FROM opened)
SELECT {columns}, start_at AS "__START_AT", next_ts AS "__END_AT"
FROM placed WHERE NOT gone AND coalesce(next_breaks, true)
"""


_PACKED = """
WITH lines AS (
  SELECT n_name AS city, CAST(date_trunc('month', l_shipdate) AS DATE) AS order_date,
         CAST(l_suppkey AS VARCHAR) AS customer_id, s_name AS customer_name,
         l_returnflag AS currency, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         CAST(l_linenumber AS BIGINT) AS qty
  FROM lineitem LEFT JOIN (supplier JOIN nation ON s_nationkey = n_nationkey) ON l_suppkey = s_suppkey
  WHERE l_tax > 0
  UNION ALL
  SELECT n_name, CAST(date_trunc('month', l_shipdate) AS DATE), CAST(l_suppkey AS VARCHAR), s_name,
         l_linestatus, CAST(l_quantity AS DECIMAL(18,2)), 1
  FROM lineitem LEFT JOIN (supplier JOIN nation ON s_nationkey = n_nationkey) ON l_suppkey = s_suppkey
  WHERE l_tax > 0),
sales AS (
  SELECT order_date, city, customer_id, customer_name, currency, sum(price) AS sales,
         CAST(sum(qty) AS BIGINT) AS quantity
  FROM lines GROUP BY ALL)
"""

_TABLE_OF = "'table_' || CAST(event_id % 17 AS VARCHAR)"

_LOANS = """
WITH loans AS (
  SELECT o_orderkey, n_name, c_acctbal, o_orderkey % 20 <> 7 AS income_known,
         CASE WHEN o_orderstatus = 'P' THEN 'Current'
              WHEN o_totalprice > 300000 AND o_orderkey % 10 < 8 THEN 'Charged Off'
              WHEN c_acctbal < 0 AND o_orderkey % 10 < 5 THEN 'Default'
              WHEN o_orderkey % 10 = 9 THEN 'Charged Off' ELSE 'Fully Paid' END AS loan_status,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Verified' WHEN '2' THEN 'Verified'
              ELSE 'Not Verified' END AS verification_status
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
"""

_CHECKED_LOANS = _LOANS + """
SELECT o_orderkey, CASE WHEN loan_status = 'Fully Paid' THEN 'false' ELSE 'true' END AS bad_loan,
       true AS sums_to_one, true AS follows_threshold
FROM loans WHERE loan_status IN ('Default', 'Charged Off', 'Fully Paid')
"""

_SCORES = """
scored AS (
  SELECT (n_chars % 1000) / CAST(1000 AS DOUBLE) AS p1, CAST(quality AS DOUBLE) AS label,
         CASE WHEN n_chars % 1000 > 400 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction, n_chars AS net
  FROM labels JOIN documents USING (doc_id))
"""


def _curve(source: str, place: str) -> str:
    return f"""
SELECT threshold,
       CAST(sum(neg) OVER w AS DOUBLE) / CAST(sum(neg) OVER () AS DOUBLE) AS fpr,
       CAST(sum(pos) OVER w AS DOUBLE) / CAST(sum(pos) OVER () AS DOUBLE) AS tpr
FROM (SELECT {place} AS threshold, count(*) FILTER (label > 0.5) AS pos,
             count(*) FILTER (NOT label > 0.5) AS neg FROM {source} GROUP BY 1)
WINDOW w AS (ORDER BY threshold DESC)
"""


def _bin(bins: int) -> str:
    return f"least(floor(p1 * {bins}), {bins - 1}) / CAST({bins} AS DOUBLE)"


def statements() -> dict[str, str]:
    return {
        "ingest_stream_once": "SELECT * FROM events",
        "ingest_json_files": "SELECT *, CAST(NULL AS VARCHAR) AS _rescued_data FROM customer",
        "ingest_csv_files": "SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, "
                            "p_size, p_retailprice FROM part",
        "csv_mixed_headers": """
            SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 < 2 THEN o_orderpriority END AS o_orderpriority,
                   CASE WHEN o_orderkey % 3 = 2 THEN 'n' || o_orderstatus END AS note FROM orders""",
        "rescue_fields": """
            SELECT event_id, user_id, CAST(NULL AS INTEGER) AS value,
                   '{"event_type":"' || event_type || '","value":"' || CAST(value AS VARCHAR) || '"}'
                   AS _rescued_data
            FROM events""",
        "clean_txs": f"SELECT * FROM ({_SHIPMENTS}) WHERE {_SHIPPED} AND {_CHARGED}",
        "quarantine_txs": f"SELECT * FROM ({_SHIPMENTS}) WHERE NOT ({_SHIPPED} AND {_CHARGED} AND {_KNOWN})",
        "expectation_totals": _rule_counts(True),
        "fail_rule_passes": "SELECT * FROM orders WHERE o_totalprice > 1000",
        "history_view": "SELECT o_orderkey, o_custkey AS id, o_orderstatus, o_totalprice, o_orderdate, "
                        "o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey",
        "balance_by_location": _BALANCE,
        "partitioned_layout": "SELECT * FROM orders",
        "clustered_stream": "SELECT * FROM orders",
        "catalog_tables": "SELECT s_suppkey, s_name, s_nationkey FROM supplier",
        "live_table_refresh": "SELECT s_suppkey, n_name, CAST(s_acctbal AS DECIMAL(18,2)) AS balance "
                              "FROM supplier JOIN nation ON s_nationkey = n_nationkey",
        "scd1_users": """
            SELECT event_id, user_id, event_type, value FROM (
              SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
              FROM events) WHERE r = 1 AND event_type <> 'error'""",
        "scd2_users": _SCD2_USERS,
        "scd2_in_buckets": _SCD2_USERS,
        "scd2_tracked": _tracked("user_id", "event_type = 'error'", "event_type",
                                 "event_id, user_id, event_type, value"),
        "scd2_hot_keys": _tracked("event_type", "user_id % 7 = 0", "value > 50",
                                  "event_id, user_id, event_type, value, tracked AS large"),
        "scd2_text_sequence": """
            SELECT event_type, user_id, event_id, value, moment AS "__START_AT",
                   lead(moment) OVER (PARTITION BY event_type ORDER BY moment) AS "__END_AT"
            FROM (SELECT *, strftime(ts, '%Y-%m-%d %H:%M:%S') || '/' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS moment
                  FROM events)""",
        "log_rows_of_own_run": f"""
            WITH kept AS (SELECT count(*) FILTER ({_SHIPPED} AND {_CHARGED}) AS n,
                                 count(*) FILTER (NOT ({_SHIPPED} AND {_CHARGED} AND {_KNOWN})) AS q
                          FROM ({_SHIPMENTS}))
            SELECT 'clean_txs' AS dataset, CAST(n AS BIGINT) AS logged, CAST(n AS BIGINT) AS held FROM kept
            UNION ALL SELECT 'quarantine_txs', CAST(q AS BIGINT), CAST(q AS BIGINT) FROM kept
            UNION ALL SELECT 'by_flag', count(DISTINCT l_returnflag), count(DISTINCT l_returnflag) FROM lineitem""",
        "log_backlog_of_own_run": """
            SELECT CAST(3 AS BIGINT) AS batches, 16 * count(*) AS read_bytes, 16 * count(*) AS first_bytes,
                   CAST(0 AS BIGINT) AS last_backlog FROM orders""",
        "rescue_csv": """
            SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 3 THEN o_custkey END AS customer,
                   CASE WHEN o_orderkey % 10 = 3 THEN 'n/a' END AS misfit,
                   CASE WHEN o_orderkey % 10 = 7
                        THEN CAST(o_orderkey AS VARCHAR) || ',' || CAST(o_custkey AS VARCHAR) || ',extra' END AS whole
            FROM orders""",
        "rescue_nested": """
            SELECT event_id, user_id, value, CASE WHEN event_id % 3 = 0 THEN event_type END AS kind,
                   CAST(NULL AS VARCHAR) AS items FROM events""",
        "orders_with_customer": """
            WITH placed AS (
              SELECT CAST(o_custkey AS VARCHAR) AS customer_id,
                     CASE WHEN o_orderstatus = 'P' THEN 'unknown'
                          ELSE 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS customer_name,
                     o_orderkey AS order_number, o_orderdate AS order_datetime,
                     CAST(o_orderdate AS DATE) AS order_date
              FROM orders)
            SELECT p.*, n_name AS city, c_mktsegment AS loyalty_segment
            FROM placed p LEFT JOIN (customer JOIN nation ON c_nationkey = n_nationkey)
              ON p.customer_id = CAST(c_custkey AS VARCHAR) AND p.customer_name = c_name""",
        "sales_by_place": _PACKED + "SELECT * FROM sales",
        "sales_table": _PACKED + """
            SELECT customer_id, customer_name, order_date, currency,
                   CAST(trunc(sales) AS BIGINT) AS sales,
                   CAST(dayofweek(order_date) + 1 AS INTEGER) AS order_day_of_week
            FROM sales WHERE city = 'NATION_3'""",
        "log_update_events": """
            SELECT CAST(event_id AS VARCHAR) AS id, ts AS timestamp,
                   CASE event_type WHEN 'click' THEN 'user_action' WHEN 'view' THEN 'flow_definition'
                        WHEN 'signup' THEN 'create_update' WHEN 'error' THEN 'cluster_utilization'
                        ELSE 'flow_progress' END AS event_type, 'update_1' AS update_id
            FROM events WHERE user_id % 4 = 1""",
        "log_user_actions": """
            SELECT ts AS timestamp, 'START' AS action, 'user_' || CAST(user_id AS VARCHAR) AS user_name
            FROM events WHERE event_type = 'click'""",
        "log_lineage": f"""
            SELECT {_TABLE_OF} AS output_dataset,
                   '["source_' || CAST(event_id % 17 AS VARCHAR) || '"]' AS input_datasets,
                   'append' AS flow_type, '{{"id":"long"}}' AS schema,
                   '{{"output_dataset":"' || {_TABLE_OF} || '","input_datasets":["source_' ||
                   CAST(event_id % 17 AS VARCHAR) ||
                   '"],"flow_type":"append","schema":{{"id":"long"}}}}' AS flow_definition
            FROM events WHERE event_type = 'view'""",
        "log_quality_totals": f"""
            WITH progress AS (SELECT * FROM events WHERE event_type = 'purchase' AND user_id % 4 = 2)
            SELECT {_TABLE_OF} AS dataset, 'valid_id' AS expectation,
                   CAST(sum(event_id * 2) AS BIGINT) AS passing_records,
                   CAST(sum(event_id % 6) AS BIGINT) AS failing_records FROM progress GROUP BY 1
            UNION ALL
            SELECT {_TABLE_OF}, 'valid_value', CAST(sum(event_id + 7) AS BIGINT),
                   CAST(sum(event_id % 2) AS BIGINT) FROM progress GROUP BY 1""",
        "log_quality_runs": f"""
            WITH progress AS (SELECT * FROM events WHERE event_type = 'purchase')
            SELECT CAST(event_id AS VARCHAR) AS id, ts AS timestamp, 'COMPLETED' AS status_update,
                   {_TABLE_OF} AS dataset, 'valid_id' AS name, event_id % 6 AS failed_records,
                   event_id * 2 AS passed_records FROM progress
            UNION ALL
            SELECT CAST(event_id AS VARCHAR), ts, 'COMPLETED', {_TABLE_OF}, 'valid_value', event_id % 2,
                   event_id + 7 FROM progress""",
        "log_latest_version": """
            SELECT CAST(event_id % 17 AS VARCHAR) || '.' || CAST(event_id % 4 AS VARCHAR) AS dbr_version
            FROM events WHERE event_type = 'signup' ORDER BY 1 DESC LIMIT 1""",
        "log_latest_version_by_number": """
            SELECT CAST(event_id % 17 AS VARCHAR) || '.' || CAST(event_id % 4 AS VARCHAR) AS dbr_version
            FROM events WHERE event_type = 'signup'
            ORDER BY event_id % 17 DESC, event_id % 4 DESC LIMIT 1""",
        "log_backlog": """
            SELECT ts AS timestamp, CAST(event_id * 10 AS DOUBLE) AS backlog
            FROM events WHERE event_type = 'purchase' AND user_id % 4 = 3""",
        "log_cluster_metrics": """
            SELECT ts AS timestamp,
                   CASE WHEN event_type = 'error' THEN CAST(event_id % 9 AS DOUBLE) END AS current_num_executors,
                   CASE WHEN event_type = 'error' THEN CAST(event_id % 5 AS DOUBLE) END AS avg_num_task_slots,
                   CASE WHEN event_type = 'error' THEN CAST(event_id % 3 AS DOUBLE) END AS avg_task_slot_utilization,
                   CASE WHEN event_type = 'error' THEN CAST(event_id % 11 AS DOUBLE) END AS queue_size,
                   CASE WHEN event_type = 'purchase' THEN CAST(event_id * 10 AS DOUBLE) END AS backlog
            FROM events WHERE event_type IN ('error', 'purchase') AND user_id % 4 = 0""",
        "log_view_in_sql": """
            SELECT CASE event_type WHEN 'click' THEN 'user_action' WHEN 'view' THEN 'flow_definition'
                        WHEN 'signup' THEN 'create_update' WHEN 'error' THEN 'cluster_utilization'
                        ELSE 'flow_progress' END AS event_type, count(*) AS events
            FROM events WHERE user_id % 4 = 1 GROUP BY 1""",
        "log_of_own_run": _rule_counts(False),
        "label_rows": _LOANS + """
            SELECT o_orderkey, loan_status,
                   CASE WHEN loan_status = 'Fully Paid' THEN 'false' ELSE 'true' END AS bad_loan,
                   verification_status
            FROM loans WHERE loan_status IN ('Default', 'Charged Off', 'Fully Paid')""",
        "sample_split": """
            SELECT o_orderkey,
                   CASE WHEN CAST('0x' || substr(md5('123/' || CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 1000 < 25
                        THEN 'sample' ELSE 'rest' END AS part
            FROM orders""",
        "count_by_state": _LOANS + """
            SELECT n_name AS addr_state, count(CASE WHEN income_known THEN c_acctbal END) AS ratio
            FROM loans GROUP BY 1""",
        "roc_by_bins": f"WITH {_SCORES}" + _curve("scored", _bin(100)),
        "roc_exact": f"WITH {_SCORES}" + _curve("scored", "p1"),
        "roc_null_scores": f"""WITH {_SCORES},
            holes AS (SELECT p1, label FROM scored WHERE net % 7 <> 0),
            curve AS ({_curve("holes", "p1")})
            SELECT * FROM curve UNION ALL SELECT CAST('inf' AS DOUBLE), 0, 0
            UNION ALL SELECT CAST('-inf' AS DOUBLE), 1, 1""",
        "roc_stacked": f"""WITH {_SCORES},
            turned AS (SELECT 0.999::DOUBLE - p1 AS p1, label FROM scored),
            a AS ({_curve("scored", _bin(10))}), b AS ({_curve("turned", _bin(10))})
            SELECT *, 'scored' AS model FROM a UNION ALL SELECT *, 'turned' FROM b""",
        "roc_area": f"""WITH {_SCORES},
            per_score AS (SELECT p1, count(*) FILTER (label > 0.5) AS pos,
                                 count(*) FILTER (NOT label > 0.5) AS neg FROM scored GROUP BY 1),
            ranked AS (SELECT *, sum(pos) OVER (ORDER BY p1 DESC) AS cum FROM per_score)
            SELECT sum((CAST(cum AS DOUBLE) - pos / CAST(2 AS DOUBLE)) * neg)
                   / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc FROM ranked""",
        "f_measure_by_threshold": f"""WITH {_SCORES},
            per_score AS (SELECT p1, count(*) FILTER (label > 0.5) AS pos, count(*) AS n
                          FROM scored GROUP BY 1)
            SELECT p1 AS threshold,
                   CAST(2 * sum(pos) OVER w AS DOUBLE)
                   / CAST(sum(n) OVER w + sum(pos) OVER () AS DOUBLE) AS f_measure
            FROM per_score WINDOW w AS (ORDER BY p1 DESC)""",
        "confusion_totals": f"""WITH {_SCORES}
            SELECT prediction, label, count(*) AS loans, CAST(sum(net) AS BIGINT) AS sum_net
            FROM scored GROUP BY 1, 2""",
        "confusion_business_value": f"""WITH {_SCORES}
            SELECT -(coalesce(CAST(sum(net) FILTER (label = 1) AS BIGINT), 0)
                     - coalesce(CAST(sum(net) FILTER (label = 0) AS BIGINT), 0)) AS value
            FROM scored WHERE prediction = 1""",
        "glm_rows": _CHECKED_LOANS,
        "gbt_rows": _CHECKED_LOANS,
        "scored_stream": "SELECT o_orderkey, true AS same FROM orders JOIN customer ON o_custkey = c_custkey "
                         "JOIN nation ON c_nationkey = n_nationkey",
        "tree_function_rows": "SELECT o_orderkey, true AS same FROM orders JOIN customer ON o_custkey = c_custkey "
                              "JOIN nation ON c_nationkey = n_nationkey",
        "risk_functions_agree": "SELECT count(*) AS loans, CAST(0 AS BIGINT) AS disagreements FROM orders "
                                "JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey",
    }

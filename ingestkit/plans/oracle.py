"""DuckDB SQL giving the expected answer of each registered query (same column names)."""

from __future__ import annotations

from ..functions.fingerprint import fingerprint_sql
from ..functions.rules import EMAIL_PATTERN
from . import data as D

LOG = """log AS (SELECT o_custkey AS customer_id, o_orderstatus AS status, o_orderpriority AS priority,
                        o_orderdate AS updated_at, o_orderkey AS seq_key FROM orders)"""
W = "PARTITION BY customer_id ORDER BY updated_at, seq_key, status, priority"
W_DESC = "PARTITION BY customer_id ORDER BY updated_at DESC, seq_key DESC, status DESC, priority DESC"

SCD2 = f"""
WITH {LOG},
marked AS (SELECT *, lag(status) OVER (w) AS p_status, lag(priority) OVER (w) AS p_priority,
                  row_number() OVER (w) AS rn FROM log WINDOW w AS ({W})),
kept AS (SELECT customer_id, status, priority, updated_at, seq_key FROM marked
         WHERE rn = 1 OR p_status IS DISTINCT FROM status OR p_priority IS DISTINCT FROM priority),
hist AS (SELECT *, updated_at AS _scd_effective_date,
                lead(updated_at) OVER (w) AS _scd_end_date,
                (lead(1) OVER (w)) IS NULL AS _scd_is_current,
                {fingerprint_sql(["status", "priority"])} AS _scd_hash,
                CASE WHEN (lag(1) OVER (w)) IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS _scd_action
         FROM kept WINDOW w AS ({W}))
"""


def _initial(pick_desc: bool) -> str:
    order = W_DESC if pick_desc else W
    return f"""
WITH {LOG},
t AS (SELECT customer_id, status, priority, updated_at, seq_key FROM (
        SELECT *, row_number() OVER ({order}) AS r FROM log WHERE updated_at < TIMESTAMP '{D.CUTOFF}') WHERE r = 1),
c AS (SELECT customer_id, status, priority, updated_at, seq_key FROM (
        SELECT *, row_number() OVER ({order}) AS r FROM log WHERE updated_at >= TIMESTAMP '{D.CUTOFF}') WHERE r = 1)
"""


def _rules_metrics(table: str, rules: list[tuple[str, str, str, str, str]]) -> str:
    parts = []
    for name, column, check, severity, cond in rules:
        if severity == "error":
            passed = f"count_if(coalesce({cond}, false))"
            failed = f"(count(*) - {passed})"
        else:
            failed = f"count_if(NOT ({cond}))"
            passed = f"(count(*) - {failed})"
        parts.append(
            f"""SELECT 'tpch' AS source_name, '{table}' AS table_name, '{name}' AS rule_name, '{column}' AS column_name,
       '{check}' AS check_type, count(*) AS records_checked, CAST({passed} AS BIGINT) AS records_passed,
       CAST({failed} AS BIGINT) AS records_failed,
       CASE WHEN count(*) > 0 THEN CAST({failed} AS DOUBLE) * 100.0 / count(*) ELSE 0.0 END AS failure_percentage,
       '{severity}' AS severity, ('{severity}' = 'error' AND {failed} > 0) AS is_quarantined FROM {table}"""
        )
    return "\nUNION ALL\n".join(parts)


def queries_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["gold_customer_orders"] = f"""
SELECT c.c_custkey AS customer_id, c.c_name AS customer_name, c.c_mktsegment AS mktsegment,
       CAST(count(o.o_orderkey) AS BIGINT) AS total_orders,
       CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_order_amount,
       CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o.o_totalprice) AS avg_order_amount,
       max(o.o_orderdate) AS last_order_date
FROM customer c
LEFT JOIN orders o
  ON c.c_custkey = o.o_custkey
WHERE c.c_acctbal > 0
GROUP BY c.c_custkey, c.c_name, c.c_mktsegment"""
    q["gold_daily_orders"] = """
SELECT date_trunc('day', o_orderdate) AS order_day, count(*) AS total_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
       count(DISTINCT o_custkey) AS unique_customers,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS avg_order_value
FROM orders GROUP BY 1"""
    q["enrich_audit_columns"] = f"""
SELECT *, TIMESTAMP '{D.RUN_TS}' AS _ingestion_timestamp, '{D.BATCH_ID}' AS _batch_id,
       'crm_system' AS _source_system, 'public.orders' AS _source_table, 'incremental' AS _load_type,
       '1.0.0' AS _pipeline_version
FROM orders"""
    q["change_fingerprint"] = f"""
WITH src AS (SELECT c_custkey, replace(c_name, '#', '|') AS name, nullif(c_mktsegment, 'BUILDING') AS segment,
                    nullif(CAST(c_nationkey AS VARCHAR), '0') AS nation FROM customer)
SELECT c_custkey, {fingerprint_sql(["name", "segment", "nation"])} AS _scd_hash FROM src"""
    q["dedup_latest"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
        l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
        l_linestatus DESC) AS r FROM lineitem) WHERE r = 1"""
    q["dq_metrics"] = "\nUNION ALL\n".join(
        [
            _rules_metrics(
                "customer",
                [
                    ("not_null__c_name", "c_name", "NOT_NULL", "error", "c_name IS NOT NULL"),
                    ("positive_value__c_acctbal", "c_acctbal", "RANGE", "warn", "c_acctbal > 0"),
                    ("range__c_nationkey", "c_nationkey", "RANGE", "error", "c_nationkey >= 0 AND c_nationkey <= 20"),
                ],
            ),
            _rules_metrics(
                "part",
                [
                    ("positive_value__p_retailprice", "p_retailprice", "RANGE", "warn", "p_retailprice > 0"),
                    ("range__p_size", "p_size", "RANGE", "warn", "p_size >= 1 AND p_size <= 40"),
                ],
            ),
            _rules_metrics(
                "lineitem",
                [
                    ("range__l_discount", "l_discount", "RANGE", "error", "l_discount >= 0.0 AND l_discount <= 0.05"),
                    ("not_null__l_shipdate", "l_shipdate", "NOT_NULL", "error", "l_shipdate IS NOT NULL"),
                ],
            ),
        ]
    )
    q["dq_drop"] = "SELECT * FROM customer WHERE c_acctbal > 0 AND c_nationkey >= 0 AND c_nationkey <= 20"
    q["dq_quarantine"] = f"""
SELECT to_json(struct_pack(c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment)) AS record_data,
       concat_ws(',', CASE WHEN NOT coalesce(c_acctbal > 0, false) THEN 'positive_value__c_acctbal' END,
                      CASE WHEN NOT coalesce(c_nationkey >= 0 AND c_nationkey <= 20, false) THEN 'range__c_nationkey' END)
         AS failed_rules,
       TIMESTAMP '{D.RUN_TS}' AS quarantine_timestamp, '{D.BATCH_ID}' AS batch_id
FROM customer
WHERE NOT (coalesce(c_acctbal > 0, false) AND coalesce(c_nationkey >= 0 AND c_nationkey <= 20, false))"""
    q["dq_email_rule"] = f"""
SELECT doc_id, email_candidate, coalesce(regexp_full_match(email_candidate, '{EMAIL_PATTERN}'), false) AS is_valid_email
FROM (SELECT doc_id, unnest(CASE WHEN len(found) > 0 THEN found ELSE [NULL] END) AS email_candidate
  FROM (SELECT doc_id, regexp_extract_all(text, '(\\S+@\\S+)', 1) AS found FROM documents))"""
    q["dq_email_all"] = f"""
SELECT doc_id, CAST(len(found) AS BIGINT) AS n_candidates,
       CAST(len(list_filter(found, lambda x: regexp_full_match(x, '{EMAIL_PATTERN}'))) AS BIGINT) AS n_valid_emails
FROM (SELECT doc_id, regexp_extract_all(text, '(\\S+@\\S+)', 1) AS found FROM documents)"""
    q["dq_unique_key"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""
    q["dq_fail"] = "SELECT * FROM events"
    q["scd0"] = _initial(False) + """
SELECT *, 'INSERT' AS _scd_action, 'b0' AS _scd_batch_id FROM t
UNION ALL
SELECT *, 'INSERT', 'b1' FROM c WHERE customer_id NOT IN (SELECT customer_id FROM t)"""
    q["scd1"] = _initial(True) + """
SELECT t.customer_id,
       CASE WHEN ch THEN c.status ELSE t.status END AS status,
       CASE WHEN ch THEN c.priority ELSE t.priority END AS priority,
       CASE WHEN ch THEN c.updated_at ELSE t.updated_at END AS updated_at,
       CASE WHEN ch THEN c.seq_key ELSE t.seq_key END AS seq_key,
       CASE WHEN ch THEN 'UPDATE' WHEN c.customer_id IS NOT NULL THEN 'UNCHANGED' ELSE 'INSERT' END AS _scd_action,
       CASE WHEN ch THEN 'b1' ELSE 'b0' END AS _scd_batch_id
FROM (SELECT t.*, c.customer_id AS cid, (c.customer_id IS NOT NULL AND
             (t.status IS DISTINCT FROM c.status OR t.priority IS DISTINCT FROM c.priority)) AS ch
      FROM t LEFT JOIN c ON t.customer_id = c.customer_id) t
LEFT JOIN c ON t.customer_id = c.customer_id
UNION ALL
SELECT *, 'INSERT', 'b1' FROM c WHERE customer_id NOT IN (SELECT customer_id FROM t)"""
    q["upsert"] = _initial(True) + """
SELECT * FROM t WHERE customer_id NOT IN (SELECT customer_id FROM c)
UNION ALL SELECT * FROM c"""
    q["append_dedup"] = "SELECT * FROM events"
    q["scd2_history"] = SCD2 + "SELECT * FROM hist"
    q["scd2_merge"] = SCD2 + "SELECT * FROM hist"
    q["scd2_current"] = SCD2 + "SELECT * FROM hist WHERE _scd_is_current"
    q["scd2_as_of"] = SCD2 + f"""SELECT * FROM hist WHERE _scd_effective_date <= TIMESTAMP '{D.AS_OF}'
  AND (_scd_end_date IS NULL OR TIMESTAMP '{D.AS_OF}' < _scd_end_date)"""
    q["scd2_as_of_join"] = SCD2 + """
SELECT o.o_orderkey, o.o_custkey AS customer_id, o.o_orderdate, o.o_totalprice, h.status, h.priority, h._scd_effective_date
FROM orders o LEFT JOIN hist h ON h.customer_id = o.o_custkey AND h._scd_effective_date <= o.o_orderdate
 AND (h._scd_end_date IS NULL OR o.o_orderdate < h._scd_end_date)"""
    q["scd2_invariants"] = "SELECT CAST(0 AS BIGINT) AS null_effective, CAST(0 AS BIGINT) AS multi_current_keys, CAST(0 AS BIGINT) AS overlaps FROM orders LIMIT 1"
    q["scd3"] = f"""
WITH {LOG},
m AS (SELECT *, lag(status) OVER (w) AS p_status, lag(priority) OVER (w) AS p_priority, row_number() OVER (w) AS rn,
             row_number() OVER ({W_DESC}) AS rl FROM log WINDOW w AS ({W})),
sc AS (SELECT customer_id, p_status, updated_at, row_number() OVER ({W_DESC}) AS r
       FROM m WHERE rn > 1 AND p_status IS DISTINCT FROM status),
pc AS (SELECT customer_id, p_priority, updated_at, row_number() OVER ({W_DESC}) AS r
       FROM m WHERE rn > 1 AND p_priority IS DISTINCT FROM priority)
SELECT l.customer_id, l.status, l.priority, l.updated_at, l.seq_key,
       sc.p_status AS status_previous, sc.updated_at AS status_change_date,
       pc.p_priority AS priority_previous, pc.updated_at AS priority_change_date
FROM m l LEFT JOIN sc ON l.customer_id = sc.customer_id AND sc.r = 1
LEFT JOIN pc ON l.customer_id = pc.customer_id AND pc.r = 1
WHERE l.rl = 1"""
    q.update(audit_sql())
    q["src_csv_options"] = "SELECT * FROM customer"
    q["src_json_multiline"] = "SELECT * FROM part"
    q["src_file_glob"] = "SELECT * FROM orders"
    q["src_rest_paged"] = "SELECT * FROM part"
    q["src_files_incremental"] = "SELECT * FROM events"
    q["src_kafka_json"] = """
SELECT *, ts AS kafka_timestamp, 'user_events' AS topic, 0 AS "partition", event_id AS "offset",
       CAST(NULL AS VARCHAR) AS _corrupt_record FROM events"""
    q["scd2_stream"] = SCD2 + "SELECT * FROM hist"
    q["stream_quarantine"] = "SELECT * FROM events WHERE value > 1"
    q["stream_dedup"] = "SELECT * FROM events"
    q["layered_run"] = """
SELECT c.c_custkey AS customer_id, c.c_name AS customer_name, c.c_mktsegment AS mktsegment,
       CAST(count(o.o_orderkey) AS BIGINT) AS total_orders,
       CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_order_amount,
       CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o.o_totalprice) AS avg_order_amount,
       max(o.o_orderdate) AS last_order_date
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
WHERE c.c_acctbal > 0
GROUP BY c.c_custkey, c.c_name, c.c_mktsegment"""
    q["run_configured"] = q["layered_run"]
    q["gold_customer_orders_all"] = q["layered_run"]
    q["json_drift"] = f"""
WITH ev AS (SELECT ts, CASE WHEN ts >= TIMESTAMP '{D.DRIFT_FROM}'
                        THEN replace(props, '}}', ', "v2": ' || CAST(user_id AS VARCHAR) || '}}') ELSE props END AS props
            FROM events),
k AS (SELECT date_trunc('day', ts) AS period, unnest(json_keys(props)) AS json_key FROM ev),
c AS (SELECT period, json_key, count(*) AS n_rows FROM k GROUP BY 1, 2),
f AS (SELECT json_key, min(period) AS first_seen FROM c GROUP BY 1)
SELECT c.json_key, c.period, c.n_rows, f.first_seen, c.period = f.first_seen AS is_new_key
FROM c JOIN f ON c.json_key = f.json_key"""
    yearly = f"""
WITH y AS (SELECT 'batch_' || CAST(year(o_orderdate) AS VARCHAR) AS batch_id, count(*) AS n_source,
                  CAST(count_if(o_totalprice >= {D.BIG_ORDER}) AS BIGINT) AS n_silver FROM orders GROUP BY 1)
"""
    q["lineage_reconcile"] = yearly + """
SELECT batch_id, n_source AS source_record_count, n_silver AS target_record_count, n_source - n_silver AS difference,
       CASE WHEN n_source = n_silver THEN 'OK' ELSE 'MISMATCH' END AS status FROM y"""
    hops = []
    n = {"orders": "n_source", "bronze_orders": "n_source", "silver_orders": "n_silver",
         "gold_daily_order_metrics": "n_silver", "gold_customer_orders_summary": "n_silver"}
    for a_src, a_tgt in D.EDGES:
        for b_src, b_tgt in D.EDGES:
            if a_tgt == b_src:
                hops.append(f"SELECT batch_id, '{a_src}' AS upstream, '{a_tgt}' AS via, '{b_tgt}' AS downstream, "
                            f"{n[a_src]} AS records_in, {n[b_tgt]} AS records_out FROM y")
    q["lineage_hops"] = yearly + "\nUNION ALL\n".join(hops)
    q["dq_report"] = QROWS + f"""
SELECT source_name, table_name, rule_name, count(*) AS total_checks,
       CAST(sum(records_checked) AS BIGINT) AS total_records_checked,
       CAST(sum(records_failed) AS BIGINT) AS total_records_failed,
       {MEAN_PCT} AS avg_failure_percentage,
       CAST(count_if(severity = 'error') AS BIGINT) AS error_count,
       CAST(count_if(severity = 'warn') AS BIGINT) AS warn_count
FROM qr WHERE check_timestamp BETWEEN TIMESTAMP '{D.AUDIT_AS_OF}' - INTERVAL 7 DAYS AND TIMESTAMP '{D.AUDIT_AS_OF}' GROUP BY 1, 2, 3
ORDER BY avg_failure_percentage DESC, source_name, table_name, rule_name LIMIT 20"""
    return q


RUNS = """
WITH runs AS (
  SELECT 'batch_' || CAST(event_id AS VARCHAR) AS batch_id, event_type AS source_name,
         't' || CAST(user_id AS VARCHAR) AS table_name, ts AS run_start_time,
         ts + to_milliseconds(CAST(round(value * 1000) AS BIGINT)) AS run_end_time,
         CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
         CAST(round(value * 100) AS BIGINT) AS records_read,
         CASE WHEN event_type = 'error' THEN CAST(0 AS BIGINT)
              ELSE CAST(greatest(CAST(round(value * 100) AS BIGINT) - user_id, 0) AS BIGINT) END AS records_written,
         CASE WHEN event_type = 'error' THEN 'error event ' || CAST(event_id AS VARCHAR) END AS error_message,
         CASE WHEN event_type <> 'error' THEN ts END AS watermark_value
  FROM events),
state AS (SELECT *, records_read - records_written AS records_failed,
                 CAST(floor(date_diff('microsecond', run_start_time, run_end_time) / 1000) AS BIGINT) AS execution_duration_ms
          FROM runs)
"""

QROWS = """
WITH base AS (
  SELECT 'batch_' || CAST(event_id AS VARCHAR) AS batch_id, event_type AS source_name,
         't' || CAST(user_id AS VARCHAR) AS table_name,
         ts + to_milliseconds(CAST(round(value * 1000) AS BIGINT)) AS check_timestamp,
         CAST(round(value * 100) AS BIGINT) AS records_checked, user_id, event_id FROM events),
q AS (
  SELECT *, least(user_id, records_checked) AS records_failed, 'not_null__user_id' AS rule_name, 'error' AS severity FROM base
  UNION ALL
  SELECT *, least(event_id % 5, records_checked), 'positive_value__value', 'warn' FROM base),
qr AS (SELECT *, CASE WHEN records_checked > 0 THEN CAST(records_failed AS DOUBLE) * 100.0 / records_checked ELSE 0.0 END
                  AS failure_percentage FROM q)
"""

MEAN_PCT = "CAST(sum(CAST(failure_percentage AS DECIMAL(38,10))) AS DOUBLE) / count(failure_percentage)"


def audit_sql() -> dict[str, str]:
    since = lambda n, unit: f"TIMESTAMP '{D.AUDIT_AS_OF}' - INTERVAL {n} {unit} AND TIMESTAMP '{D.AUDIT_AS_OF}'"
    q = {}
    q["audit_latest_state"] = RUNS + "SELECT * FROM state"
    q["audit_history"] = RUNS + "SELECT * FROM state WHERE source_name = 'click' ORDER BY run_start_time DESC LIMIT 100"
    q["audit_failed"] = RUNS + f"""
SELECT batch_id, source_name, table_name, run_start_time, run_end_time, error_message, execution_duration_ms
FROM state WHERE status = 'FAILED' AND run_start_time BETWEEN {since(24, 'HOURS')} ORDER BY run_start_time DESC"""
    q["audit_metrics"] = RUNS + f"""
SELECT count(*) AS total_batches,
       CAST(count_if(status = 'SUCCESS') AS BIGINT) AS successful_batches,
       CAST(count_if(status = 'FAILED') AS BIGINT) AS failed_batches,
       CAST(sum(records_read) AS BIGINT) AS total_records_read,
       CAST(sum(records_written) AS BIGINT) AS total_records_written,
       avg(execution_duration_ms) AS avg_duration_ms,
       CASE WHEN count(*) > 0 THEN CAST(count_if(status = 'SUCCESS') AS DOUBLE) * 100.0 / count(*) ELSE 0.0 END AS success_rate
FROM state WHERE run_start_time BETWEEN {since(30, 'DAYS')}"""
    q["audit_dq_summary"] = QROWS + f"""
SELECT source_name, table_name, rule_name, count(*) AS total_checks,
       CAST(sum(records_checked) AS BIGINT) AS total_records_checked,
       CAST(sum(records_failed) AS BIGINT) AS total_records_failed,
       {MEAN_PCT} AS avg_failure_percentage,
       CAST(count_if(severity = 'error') AS BIGINT) AS error_count,
       CAST(count_if(severity = 'warn') AS BIGINT) AS warn_count
FROM qr WHERE check_timestamp BETWEEN {since(7, 'DAYS')} GROUP BY 1, 2, 3"""
    q["audit_dq_rate"] = QROWS + f"SELECT source_name, table_name, rule_name, {MEAN_PCT} AS avg_failure_rate FROM qr GROUP BY 1, 2, 3"
    q["audit_retention"] = f"""
WITH e AS (SELECT *, CAST(round(value * 100) AS BIGINT) AS n, event_type = 'error' AS bad,
  'batch_' || CAST(event_id AS VARCHAR) AS b, 't' || CAST(user_id AS VARCHAR) AS t
  FROM events WHERE ts >= TIMESTAMP '{D.AUDIT_AS_OF}' - INTERVAL 10 DAYS)
SELECT b AS batch_id, event_type AS source_name, t AS table_name, 1 AS event_seq, ts AS run_start_time,
  CAST(NULL AS TIMESTAMP) AS run_end_time, 'RUNNING' AS status, CAST(NULL AS BIGINT) AS records_read,
  CAST(NULL AS BIGINT) AS records_written, CAST(NULL AS VARCHAR) AS error_message,
  CAST(NULL AS TIMESTAMP) AS watermark_value FROM e
UNION ALL SELECT b, event_type, t, 2, NULL, NULL, 'RUNNING', n, NULL, NULL, NULL FROM e
UNION ALL SELECT b, event_type, t, 3, NULL, ts + to_milliseconds(CAST(round(value * 1000) AS BIGINT)),
  CASE WHEN bad THEN 'FAILED' ELSE 'SUCCESS' END, n, CASE WHEN bad THEN 0 ELSE greatest(n - user_id, 0) END,
  CASE WHEN bad THEN 'error event ' || CAST(event_id AS VARCHAR) END, CASE WHEN NOT bad THEN ts END FROM e"""
    q["watermark_lookback"] = f"""
SELECT * FROM orders
WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '{D.CUTOFF}') - INTERVAL 1 DAY"""
    part = "coalesce(((o_orderkey % 3) + 3) % 3, 0)"
    q["load_added_column"] = f"""
SELECT o_orderkey, o_custkey, CASE WHEN {part} <> 2 THEN o_orderstatus END AS o_orderstatus, o_totalprice, o_orderdate,
  CASE WHEN {part} <> 0 THEN o_orderpriority END AS o_orderpriority, 'b' || CAST({part} AS VARCHAR) AS batch_id
FROM orders WHERE o_orderkey IS NOT NULL"""
    q["load_widened_type"] = f"""
SELECT o_orderkey, CASE {part} WHEN 0 THEN o_custkey WHEN 1 THEN o_custkey + 10000000000
    ELSE CASE WHEN o_custkey % 2 <> 0 THEN o_custkey END END AS o_custkey,
  CASE {part} WHEN 0 THEN CAST(floor(o_totalprice) AS DOUBLE) ELSE o_totalprice END AS o_totalprice, o_orderdate,
  CASE WHEN {part} = 2 AND o_custkey % 2 = 0 THEN 'C-' || CAST(o_custkey AS VARCHAR) END AS rescued_custkey
FROM orders WHERE o_orderkey IS NOT NULL"""
    q["dq_unique_across_loads"] = """
WITH l AS (SELECT *, coalesce(((l_suppkey % 3) + 3) % 3, 0) AS part FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY part, l_partkey NULLS FIRST,
  l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST,
  l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) AS n FROM l)
SELECT * EXCLUDE (part, n), 'b' || CAST(part AS VARCHAR) AS batch_id,
  CASE WHEN n > 1 THEN 'unique_primary_key__l_orderkey_l_linenumber' END AS failed_rules FROM r"""
    q["lineage_closure"] = """
WITH RECURSIVE o AS (SELECT DISTINCT o_custkey, o_orderkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderkey IS NOT NULL),
e AS (SELECT lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS a, o_orderkey AS b FROM o
  UNION SELECT max(o_orderkey), min(o_orderkey) FROM o WHERE o_custkey % 100 = 0 GROUP BY o_custkey),
p AS (SELECT a, b FROM e WHERE a IS NOT NULL UNION SELECT p.a, e.b FROM p JOIN e ON p.b = e.a),
n AS (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i FROM o)
SELECT 'orders_' || CAST(p.a AS VARCHAR) AS upstream, 'orders_' || CAST(p.b AS VARCHAR) AS downstream,
  CAST(CASE WHEN y.i > x.i THEN y.i - x.i ELSE y.i - x.i + x.n END AS BIGINT) AS hops,
  EXISTS (SELECT 1 FROM p r WHERE r.a = p.b AND r.b = p.a) AS in_cycle
FROM p JOIN n x ON x.o_orderkey = p.a JOIN n y ON y.o_orderkey = p.b"""
    q["json_path_drift"] = """
WITH e AS (SELECT date_trunc('day', ts) AS period, ts FROM events WHERE event_id % 7 <> 0 AND user_id IS NOT NULL AND ts IS NOT NULL),
d AS (SELECT CAST(period AS TIMESTAMP) AS period, unnest([
  {'path': '$.user.id', 'type': CASE WHEN ts >= TIMESTAMP '2024-01-10' THEN 'STRING' ELSE 'BIGINT' END},
  {'path': CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN '$.user.geo' END, 'type': 'OBJECT'},
  {'path': CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN '$.user.geo.zip' END, 'type': 'STRING'},
  {'path': CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN '$.items[].ok' END, 'type': 'BOOLEAN'},
  {'path': CASE WHEN ts < TIMESTAMP '2024-01-25' THEN '$.old' END, 'type': 'DECIMAL'}]) AS s FROM e),
t AS (SELECT period, s.path AS path, CASE WHEN count(DISTINCT s.type) > 1 THEN 'VARIANT' ELSE min(s.type) END AS type
  FROM d WHERE s.path IS NOT NULL GROUP BY ALL),
n AS (SELECT period, lag(period) OVER (ORDER BY period) AS previous_period FROM (SELECT DISTINCT CAST(period AS TIMESTAMP) AS period FROM e)),
x AS (SELECT n.*, q.path, a.type AS previous_type, b.type AS new_type FROM n CROSS JOIN (SELECT DISTINCT path FROM t) q
  LEFT JOIN t a ON a.period = n.previous_period AND a.path = q.path LEFT JOIN t b ON b.period = n.period AND b.path = q.path
  WHERE n.previous_period IS NOT NULL)
SELECT period, previous_period, path, CASE WHEN previous_type IS NULL THEN 'ADDED' WHEN new_type IS NULL THEN 'DROPPED' ELSE 'RETYPED' END AS change,
  previous_type, new_type FROM x WHERE previous_type IS DISTINCT FROM new_type"""
    q["gold_incremental"] = f"""
WITH o AS (SELECT o_orderkey, o_totalprice, o_custkey, o_orderdate, {part} AS part FROM orders WHERE o_orderkey IS NOT NULL),
f AS (SELECT CASE WHEN part = 1 THEN o_custkey + 1 ELSE o_custkey END AS customer_id,
  CASE WHEN part = 1 THEN o_totalprice * 2 ELSE o_totalprice END AS amount,
  CASE WHEN part = 1 THEN o_orderdate - INTERVAL 400 DAYS ELSE o_orderdate END AS t FROM o WHERE NOT (part = 2 AND o_orderkey % 2 = 0))
SELECT customer_id, count(*) AS total_orders, CAST(sum(CAST(amount AS DECIMAL(28,6))) AS DOUBLE) AS total_order_amount,
  CAST(sum(CAST(amount AS DECIMAL(28,6))) AS DOUBLE) / count(amount) AS avg_order_amount, max(t) AS last_order_date
FROM f GROUP BY customer_id"""
    q["gold_distinct_sketches"] = """
SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS period, count(DISTINCT o_custkey) AS unique_customers, true AS within_error
FROM orders GROUP BY 1"""
    return q

"""SQL that DuckDB runs on the test tables, one statement per registered query."""

from __future__ import annotations

# dirty raw orders from line items, then one clean order per id.
RAW = """
raw AS (
 SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS order_id,
  concat('C', CAST(o_custkey AS VARCHAR)) AS customer_id,
  concat('P', CAST(p_partkey AS VARCHAR)) AS product_id, p_name AS product_name,
  CASE WHEN l_partkey % 2 = 0 THEN concat('  ', lower(p_type), ' ') ELSE p_type END AS category,
  CAST(l_quantity AS INT) AS quantity, l_extendedprice / l_quantity AS unit_price,
  l_extendedprice AS total_amount, 'USD' AS currency, o_orderpriority AS payment_method,
  CASE WHEN l_returnflag = 'R' THEN ' cancelled' ELSE 'Placed' END AS order_status,
  n_name AS shipping_city, r_name AS shipping_state,
  concat(strftime(o_orderdate, '%Y-%m-%d'), 'T',
   lpad(CAST(l_partkey % 24 AS VARCHAR), 2, '0'), ':00:00+00:00') AS order_timestamp,
  l_suppkey, l_shipdate
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

DEDUP = f"""{RAW},
ded AS (
 SELECT *, row_number() OVER (PARTITION BY order_id
   ORDER BY order_timestamp, product_id, l_suppkey, total_amount, l_shipdate) AS rn FROM raw)"""

TIMES = """CAST(replace(substring(order_timestamp, 1, 19), 'T', ' ') AS TIMESTAMP) AS order_ts,
  CAST(substring(order_timestamp, 12, 2) AS INT) AS order_hour,
  CAST(substring(order_timestamp, 1, 10) AS DATE) AS order_date"""

PROCESSED = f"""WITH {DEDUP},
orders_processed AS (
 SELECT order_id, customer_id, product_id, product_name, upper(trim(category)) AS category,
  quantity, unit_price, total_amount, currency, payment_method,
  upper(trim(order_status)) AS order_status, shipping_city, shipping_state,
  {TIMES}
 FROM ded WHERE rn = 1)
"""

# dirty raw orders from events.
EVENT_RAW = """
raw AS (
 SELECT concat_ws('-', CAST(user_id AS VARCHAR), event_type, strftime(ts, '%H')) AS order_id,
  concat('C', CAST(user_id AS VARCHAR)) AS customer_id,
  concat('P', json_extract_string(props, '$.k')) AS product_id,
  concat('Item ', json_extract_string(props, '$.k')) AS product_name,
  concat(' ', event_type, '  ') AS category,
  CAST(json_extract_string(props, '$.k') AS INT) AS quantity,
  value AS unit_price, value AS total_amount,
  CASE WHEN user_id % 3 > 0 THEN 'USD' END AS currency, upper(event_type) AS payment_method,
  CASE WHEN value < 10 THEN 'cancelled ' ELSE ' Placed' END AS order_status,
  concat('City ', CAST(user_id AS VARCHAR)) AS shipping_city, 'NY' AS shipping_state,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS order_timestamp, ts
 FROM events)"""

# Ids are unique within a run; run 0 takes the days before the 16th.
EVENT_RUN = "CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END"


def _event_processed(run: str) -> str:
    return f"""WITH {EVENT_RAW},
ded AS (
 SELECT *, {run} AS run, row_number() OVER (PARTITION BY {run}, order_id
   ORDER BY ts, product_id, total_amount, customer_id, product_name, category, quantity,
   order_status) AS rn FROM raw),
orders_processed AS (
 SELECT order_id, customer_id, product_id, product_name, upper(trim(category)) AS category,
  quantity, unit_price, total_amount, currency, payment_method,
  upper(trim(order_status)) AS order_status, shipping_city, shipping_state,
  ts AS order_ts, CAST(hour(ts) AS INT) AS order_hour, CAST(ts AS DATE) AS order_date, run
 FROM ded WHERE rn = 1)
"""


ONE_RUN = _event_processed("0")
TWO_RUNS = _event_processed(EVENT_RUN)

COLUMNS = """order_id, customer_id, product_id, product_name, category, quantity, unit_price,
 total_amount, currency, payment_method, order_status, shipping_city, shipping_state,
 order_ts, order_hour, order_date"""

# By way of text, which holds a double exactly; what is no number adds nothing.
AMOUNT = "TRY_CAST(CAST(total_amount AS STRING) AS DECIMAL(38,10))"
REVENUE = f"CAST(CAST(SUM({AMOUNT}) AS STRING) AS DOUBLE)"
AVERAGE = f"ROUND({REVENUE} / COUNT({AMOUNT}), 2)"

DAILY = f"""SELECT order_date, COUNT(*) AS total_orders, {REVENUE} AS gross_revenue,
 {AVERAGE} AS avg_order_value
FROM orders_processed WHERE order_status = 'PLACED'
 AND order_date >= CAST((SELECT MAX(order_date) FROM orders_processed) - INTERVAL '7' DAY AS DATE)
GROUP BY order_date ORDER BY order_date DESC"""

LIVE = """WITH ev AS (
 SELECT CAST(event_id AS VARCHAR) AS order_id, concat('C', CAST(user_id AS VARCHAR)) AS customer_id,
  event_type AS category,
  CASE WHEN event_id % 103 = 0 THEN 2e16 WHEN event_id % 7 = 0 THEN 0.004
   ELSE value END AS total_amount,
  CASE WHEN event_id % 5 = 0 THEN 'CANCELLED' WHEN event_id % 11 = 0 THEN NULL
   ELSE 'PLACED' END AS order_status, ts FROM events)
"""

LIVE_METRICS = f"""{LIVE} SELECT concat('CATEGORY#', category) AS pk,
 concat('DATE#', strftime(ts, '%Y-%m-%d')) AS sk, COUNT(*) AS order_count, {REVENUE} AS revenue
FROM ev WHERE order_status IS DISTINCT FROM 'CANCELLED' GROUP BY 1, 2"""

# the payload of every stream record, and why it is rejected.
FAULTS = """SELECT *, event_id % 23 = 0 AS no_category, event_id % 29 = 0 AS bad_amount,
  event_id % 31 = 0 AS no_amount, event_id % 37 = 0 AS number_time, event_id % 41 = 0 AS no_time,
  CASE WHEN event_id % 19 = 0 THEN 'bad_base64' WHEN event_id % 13 = 0 THEN 'bad_json'
   WHEN event_id % 17 = 0 THEN 'not_an_object' END AS broken,
  broken IS NULL AND event_id % 43 = 0 AS cancelled
 FROM events"""

PAYLOADS = f"""payloads AS (SELECT *,
 CASE WHEN event_id % 13 = 0 THEN '{{bad' WHEN event_id % 17 = 0 THEN '[1]'
  WHEN event_id % 43 = 0
   THEN concat('{{"order_id":"', event_id, '","order_status":"CANCELLED"}}')
  ELSE concat('{{"order_id":"', event_id, '","customer_id":"C', user_id, '"',
   CASE WHEN no_category THEN '' ELSE concat(',"category":"', event_type, '"') END,
   CASE WHEN bad_amount THEN ',"total_amount":"abc"' WHEN no_amount THEN ''
    ELSE concat(',"total_amount":', value) END,
   ',"order_status":"PLACED"',
   CASE WHEN number_time THEN ',"order_timestamp":1767322245' WHEN no_time THEN ''
    ELSE strftime(ts, ',"order_timestamp":"%Y-%m-%dT%H:%M:%S.%f+00:00"') END, '}}') END AS payload,
 CASE WHEN broken IS NOT NULL THEN broken WHEN cancelled THEN NULL
  WHEN no_time AND NOT number_time THEN 'missing_order_timestamp'
  WHEN no_category THEN 'missing_category' WHEN bad_amount THEN 'bad_total_amount'
  WHEN no_amount THEN 'missing_total_amount' WHEN number_time THEN 'bad_order_timestamp'
 END AS reason
FROM ({FAULTS}) AS faults)"""


def _decoded(more: str, which: str) -> str:
    return f"""WITH {PAYLOADS} SELECT CAST(event_id AS VARCHAR) AS order_id,
 CASE WHEN NOT cancelled THEN concat('C', user_id) END AS customer_id,
 CASE WHEN NOT cancelled AND NOT no_category THEN event_type END AS category,
 CASE WHEN NOT cancelled AND NOT bad_amount AND NOT no_amount THEN value END AS total_amount,
 CASE WHEN cancelled THEN NULL WHEN number_time THEN '1767322245' WHEN no_time THEN NULL
  ELSE strftime(ts, '%Y-%m-%d') END AS order_day{more}
FROM payloads WHERE {which}"""


ENVELOPES = f"""WITH {PAYLOADS} SELECT CAST(event_id AS VARCHAR) AS sequence_number,
 CASE WHEN event_id % 19 = 0 THEN '@@@' ELSE to_base64(encode(payload)) END AS data FROM payloads"""

MESSAGE = """concat('High-value order detected', chr(10), 'Order ID: ', order_id, chr(10),
 'Customer: ', customer_id, chr(10), 'Product:  ', product_name, ' (', category, ')', chr(10),
 'Amount:   $', CAST(CAST(total_amount AS DECIMAL(18,2)) AS VARCHAR), ' ',
 coalesce(currency, 'USD'), chr(10),
 'City:     ', shipping_city, ', ', shipping_state, chr(10), 'Time:     ', order_timestamp)"""


def _alerts(raw: str, threshold: int = 250) -> str:
    return f"""WITH {raw} SELECT order_id, customer_id, category,
 'High-value order alert' AS subject, {MESSAGE} AS message
FROM raw WHERE order_status IS DISTINCT FROM 'CANCELLED' AND total_amount > {threshold}"""


SQL = {
    "report_daily_revenue": PROCESSED + DAILY,
    "report_category_share": PROCESSED
    + f"""SELECT category, COUNT(*) AS orders, {REVENUE} AS revenue,
 ROUND({REVENUE} * 100.0
  / CAST(CAST(SUM(SUM({AMOUNT})) OVER () AS STRING) AS DOUBLE), 2) AS pct_of_revenue
FROM orders_processed WHERE order_status = 'PLACED'
GROUP BY category ORDER BY revenue DESC, category""",
    "report_top_products": PROCESSED
    + f"""SELECT product_id, product_name, CAST(SUM(quantity) AS BIGINT) AS units_sold,
 {REVENUE} AS revenue
FROM orders_processed WHERE order_status = 'PLACED' GROUP BY product_id, product_name
ORDER BY revenue DESC, product_id, product_name LIMIT 10""",
    "report_hourly": PROCESSED
    + f"""SELECT order_hour, COUNT(*) AS orders,
 {AVERAGE} AS avg_order_value
FROM orders_processed WHERE order_status = 'PLACED' GROUP BY order_hour ORDER BY order_hour""",
    "report_cancel_rate": PROCESSED
    + """SELECT *, round(CAST(cancelled AS DOUBLE) * 100 / total, 2) AS cancel_rate_pct
FROM (SELECT category, count(*) AS total,
  count(*) FILTER (WHERE order_status = 'CANCELLED') AS cancelled
 FROM orders_processed GROUP BY category) AS counted
ORDER BY cancel_rate_pct DESC, category""",
    "report_top_cities": PROCESSED
    + f"""SELECT shipping_state, shipping_city, COUNT(*) AS orders, {REVENUE} AS revenue
FROM orders_processed WHERE order_status = 'PLACED' GROUP BY shipping_state, shipping_city
ORDER BY revenue DESC, shipping_state, shipping_city LIMIT 15""",
    "report_payment_mix": PROCESSED
    + """SELECT payment_method, COUNT(*) AS orders,
 ROUND(CAST(100.0 AS DOUBLE) * COUNT(*) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 2) AS pct
FROM orders_processed WHERE order_status = 'PLACED'
GROUP BY payment_method ORDER BY orders DESC, payment_method""",
    "etl_clean_orders": PROCESSED + f"SELECT {COLUMNS} FROM orders_processed",
    "etl_dedup_orders": f"WITH {DEDUP} SELECT * EXCLUDE (rn) FROM ded WHERE rn = 1",
    "etl_time_derivation": f"""WITH {RAW} SELECT order_id, product_id, {TIMES}
FROM raw""",
    "etl_raw_scan": f"""WITH {EVENT_RAW} SELECT order_id, customer_id, product_id, product_name,
 category, concat(CAST(quantity AS VARCHAR), '.0') AS quantity, unit_price, total_amount, currency,
 payment_method, order_status, shipping_city, shipping_state, order_timestamp,
 CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day
FROM raw""",
    "etl_processed_roundtrip": ONE_RUN + f"SELECT {COLUMNS} FROM orders_processed",
    "etl_incremental": TWO_RUNS + f"SELECT {COLUMNS} FROM orders_processed",
    "etl_retried_batch": TWO_RUNS + f"SELECT {COLUMNS} FROM orders_processed",
    "etl_dedup_across_runs": TWO_RUNS
    + f"""SELECT {COLUMNS} FROM orders_processed
WHERE run = 0 OR order_id NOT IN (SELECT order_id FROM orders_processed WHERE run = 0)""",
    "etl_run_metrics": TWO_RUNS
    + f""", seen AS (SELECT {EVENT_RUN} AS run, COUNT(*) AS raw_rows FROM raw GROUP BY 1),
 kept AS (SELECT run, COUNT(*) AS written_rows FROM orders_processed GROUP BY 1)
SELECT seen.run, raw_rows, written_rows FROM seen JOIN kept ON seen.run = kept.run""",
    "catalog_partitions": TWO_RUNS
    + """SELECT order_date, category, COUNT(*) AS n FROM orders_processed
GROUP BY order_date, category""",
    "catalog_daily_revenue": TWO_RUNS + DAILY,
    "catalog_merge_schema": TWO_RUNS
    + f"""SELECT {COLUMNS}, CASE WHEN run = 1 THEN concat('S-', customer_id) END AS segment
FROM orders_processed""",
    "catalog_evolved": TWO_RUNS
    + f"""SELECT {COLUMNS}, CASE WHEN run = 1 THEN concat('S-', customer_id) END AS segment
FROM orders_processed""",
    "catalog_compacted": ONE_RUN
    + """SELECT order_date, category, COUNT(*) AS n, CAST(1 AS BIGINT) AS partitions
FROM orders_processed GROUP BY order_date, category""",
    "raw_retention": f"""WITH {EVENT_RAW}, landed AS (
 SELECT CAST(ts AS DATE) AS landing_day FROM raw)
SELECT landing_day, COUNT(*) AS orders FROM landed
WHERE landing_day >= CAST((SELECT MAX(landing_day) FROM landed) - INTERVAL '7' DAY AS DATE)
GROUP BY landing_day""",
    "raw_expired_days": f"""WITH {EVENT_RAW}, landed AS (
 SELECT CAST(ts AS DATE) AS landing_day FROM raw)
SELECT CAST(year(landing_day) AS INT) AS year, CAST(month(landing_day) AS INT) AS month,
 CAST(day(landing_day) AS INT) AS day, COUNT(*) AS orders FROM landed
WHERE landing_day < CAST((SELECT MAX(landing_day) FROM landed) - INTERVAL '7' DAY AS DATE)
GROUP BY landing_day""",
    "rt_stream_ingest": ENVELOPES,
    "rt_late_files": ENVELOPES,
    "rt_latest_records": f"{ENVELOPES} WHERE event_id % 2 = 1",
    "rt_decode": _decoded("", "reason IS NULL"),
    "rt_quarantine": f"""WITH {PAYLOADS} SELECT CAST(event_id AS VARCHAR) AS record_id, reason,
 CASE WHEN event_id % 19 = 0 THEN '@@@' ELSE payload END AS raw
FROM payloads WHERE reason IS NOT NULL""",
    "rt_raw_zone": _decoded(
        """, CAST(year(today) AS INT) AS year, CAST(month(today) AS INT) AS month,
 CAST(day(today) AS INT) AS day""",
        "broken IS NULL",
    ).replace("FROM payloads", "FROM payloads, (SELECT timezone('UTC', now()) AS today) AS t"),
    "rt_fan_out": f"""WITH {PAYLOADS}, high AS (
 SELECT count(*) AS n FROM events WHERE value > 250)
SELECT 'raw' AS sink, '' AS detail, (SELECT count(*) FROM events)
 + (SELECT count(*) FROM payloads WHERE broken IS NULL) AS n
UNION ALL SELECT 'rejects', why, count(*) FROM (SELECT CASE WHEN reason IS NOT NULL THEN reason
  WHEN NOT cancelled AND value > 250 THEN 'missing_product_name' END AS why FROM payloads) AS r
 WHERE why IS NOT NULL GROUP BY why
UNION ALL SELECT 'alerts', '', n FROM high
UNION ALL SELECT 'failed', 'receiver is down', n FROM high
UNION ALL SELECT 'counted', 'records', 2 * count(*) FROM events
UNION ALL SELECT 'counted', 'failures', count(*) FROM payloads
 WHERE reason IS NOT NULL OR (NOT cancelled AND value > 250)
UNION ALL SELECT 'metrics', '', (SELECT count(*) FROM events)
 + (SELECT count(*) FROM payloads WHERE reason IS NULL AND NOT cancelled)""",
    "rt_live_metrics": LIVE_METRICS,
    "rt_live_metrics_stream": LIVE_METRICS,
    "rt_metrics_lookup": f"""SELECT * FROM ({LIVE_METRICS}) m
WHERE pk = 'CATEGORY#click' AND sk BETWEEN 'DATE#2024-01-05' AND 'DATE#2024-01-20'""",
    "rt_alerts": f"""{LIVE} SELECT order_id, customer_id, category, total_amount FROM ev
WHERE order_status IS DISTINCT FROM 'CANCELLED' AND total_amount > 250""",
    "rt_alert_message": _alerts(RAW, 50_000),
    "rt_alert_stream": _alerts(EVENT_RAW),
    "rt_retried_alerts": f"""WITH {EVENT_RAW}, failed AS (
 SELECT order_id, CAST(substring(customer_id, 2) AS BIGINT) AS customer FROM raw
 WHERE order_status IS DISTINCT FROM 'CANCELLED' AND total_amount > 250),
judged AS (
 SELECT order_id, customer = (SELECT max(customer) FROM failed) AS refused FROM failed)
SELECT order_id, CASE WHEN refused THEN 5 ELSE 2 END AS attempts,
 CASE WHEN refused THEN 'given_up' ELSE 'delivered' END AS state,
 CASE WHEN refused THEN 'refused' ELSE 'receiver is down' END AS reason, count(*) AS n
FROM judged GROUP BY ALL""",
}

# The other reports on the registered table, whose orders are those of two runs.
SQL |= {
    f"catalog_{name}": TWO_RUNS + SQL[f"report_{name}"].removeprefix(PROCESSED)
    for name in (
        "category_share",
        "top_products",
        "hourly",
        "cancel_rate",
        "top_cities",
        "payment_mix",
    )
}
SQL["raw_expiry"] = f"""WITH {EVENT_RAW}, landed AS (
 SELECT CAST(ts AS DATE) AS landing_day, COUNT(*) AS orders,
  CAST(ts AS DATE) < (SELECT MAX(CAST(ts AS DATE)) FROM raw) - INTERVAL '7' DAY AS expired,
  CAST(ts AS DATE) < DATE '2024-01-16' AS curated FROM raw GROUP BY CAST(ts AS DATE))
SELECT landing_day, CASE WHEN expired AND curated THEN 'deleted' WHEN expired THEN 'kept' END AS state,
 CASE WHEN expired AND NOT curated THEN 'not curated' END AS reason,
 CASE WHEN NOT (expired AND curated) THEN orders END AS orders_left
FROM landed"""

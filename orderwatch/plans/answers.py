"""The same answers in plain SQL, for an independent engine to check the catalog against."""

from __future__ import annotations

EVENT_ORDERS = """
o AS (
  SELECT event_id AS order_id, ts AS "timestamp", user_id, event_type AS product_name,
         CAST(round(value * 100) AS INTEGER) AS price,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS quantity,
         user_id AS ip_address,
         CAST(round(value * 100) AS BIGINT) * CAST(json_extract_string(props, '$.k') AS BIGINT) AS total_price
  FROM events
)"""

LINE_ORDERS = """
o AS (
  SELECT l_orderkey * 8 + l_linenumber AS order_id, l_shipdate AS "timestamp", p_name AS product_name,
         l_suppkey AS ip_address,
         CAST(round(p_retailprice * 100) AS BIGINT) * CAST(l_quantity AS BIGINT) AS total_price
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""


def _tumbling(width: str) -> str:
    return f"SELECT o.*, time_bucket(INTERVAL '{width}', \"timestamp\") AS window_start FROM o"


def _sliding(width: str, slide: str, copies: int) -> str:
    return f"""
      SELECT o.*, time_bucket(INTERVAL '{slide}', "timestamp") - i * INTERVAL '{slide}' AS window_start
      FROM o, range({copies}) AS r(i)"""


def _popular(rows: str, width: str) -> str:
    return f"""
popular AS (
  SELECT window_start, window_start + INTERVAL '{width}' AS window_end, product_name,
         count(*) AS order_count, CAST(sum(total_price) AS BIGINT) AS total_sales
  FROM ({rows}) GROUP BY window_start, product_name
)"""


def _suspicious(rows: str, limit: int) -> str:
    return f"""
suspicious AS (
  SELECT window_start, ip_address, count(*) AS order_count, CAST(sum(total_price) AS BIGINT) AS total_spent
  FROM ({rows}) GROUP BY window_start, ip_address HAVING count(*) >= {limit}
)"""


def _lists(rows: str, limit: int) -> str:
    return f"""
lists AS (
  SELECT window_start, ip_address, CAST(sum(copies) AS BIGINT) AS order_count, CAST(sum(spent) AS BIGINT) AS total_spent,
         string_agg(product_name || ' x' || copies, ',' ORDER BY product_name) AS products
  FROM (
    SELECT window_start, ip_address, product_name, count(*) AS copies, sum(total_price) AS spent
    FROM ({rows}) GROUP BY window_start, ip_address, product_name
  )
  GROUP BY window_start, ip_address HAVING sum(copies) >= {limit}
)"""


def _stats(width: str) -> str:
    return f"""
stats AS (
  SELECT window_start + INTERVAL '{width}' AS stat_time, count(*) AS total_orders,
         CAST(sum(total_price) AS BIGINT) AS total_sales,
         CAST(trunc(avg(total_price)) AS BIGINT) AS avg_order_value, 0 AS suspicious_ip_count
  FROM ({_tumbling(width)}) GROUP BY window_start
)"""


def _enriched(width: str, limit: int) -> str:
    return f"""
enriched AS (
  SELECT window_start + INTERVAL '{width}' AS stat_time, CAST(sum(n) AS BIGINT) AS total_orders,
         CAST(sum(spent) AS BIGINT) AS total_sales, CAST(sum(spent) // sum(n) AS BIGINT) AS avg_order_value,
         count(*) FILTER (n >= {limit}) AS suspicious_ip_count
  FROM (
    SELECT window_start, ip_address, count(*) AS n, sum(total_price) AS spent
    FROM ({_tumbling(width)}) GROUP BY window_start, ip_address
  ) GROUP BY window_start
)"""


def _rolling(before: str) -> str:
    return f"""
rolled AS (
  SELECT o.*, count(*) OVER (
    PARTITION BY ip_address ORDER BY "timestamp"
    RANGE BETWEEN INTERVAL '{before}' PRECEDING AND CURRENT ROW) AS recent_orders
  FROM o
)"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


ONE_DAY = "86399.999999 seconds"
SEVEN_DAYS = "604799.999999 seconds"


def _between(time: str) -> str:
    return f"{time} >= TIMESTAMP '2024-01-05' AND {time} < TIMESTAMP '2024-01-20'"


POPULAR = _popular(_tumbling("6 hours"), "6 hours")
POPULAR_SLIDING = _popular(_sliding("6 hours", "2 hours", 3), "6 hours")
SUSPICIOUS = _suspicious(_tumbling("1 day"), 5)
CUTS = """
cuts AS (
  SELECT date_trunc('hour', min(ts) + i * (max(ts) - min(ts)) / 4) + INTERVAL '37 minutes 11 seconds' AS cut
  FROM events, range(1, 4) AS r(i) GROUP BY i
)"""
CLOSED = "(SELECT max(ts) - INTERVAL '{0}' FROM events)"

DECODED = """
SELECT CAST(order_id AS VARCHAR) AS order_id, "timestamp", CAST(user_id AS VARCHAR) AS user_id,
       product_name AS product_id, product_name, price, quantity, CAST(ip_address AS VARCHAR) AS ip_address,
       CAST(NULL AS VARCHAR) AS payment_method
FROM o"""

HIGH_VALUE = """
SELECT "timestamp" AS order_time, order_id, product_name, quantity, total_price, ip_address
FROM o WHERE total_price >= 500000"""

STATS = "SELECT * FROM stats"
LATEST_POPULAR = "SELECT * FROM popular"
ROLLED = 'SELECT order_id, ip_address, "timestamp", recent_orders FROM rolled'

ANSWERS: dict[str, str] = {
    "decode_orders": _with(EVENT_ORDERS, select=DECODED),
    "stream_decode_orders": _with(EVENT_ORDERS, select=DECODED),
    "bad_record_split": _with(
        EVENT_ORDERS,
        select="""
SELECT product_name, count(*) AS orders, CAST(sum(price) AS BIGINT) AS price
FROM o WHERE product_name <> 'error' GROUP BY product_name
UNION ALL
SELECT 'rejects', count(*), CAST(NULL AS BIGINT) FROM o WHERE product_name = 'error'""",
    ),
    "orders_encode_publish": _with(
        EVENT_ORDERS,
        select="""
SELECT CAST(order_id AS VARCHAR) AS key, CAST(order_id AS VARCHAR) AS order_id, "timestamp" AS order_time,
       product_name, price, quantity, CAST(ip_address AS VARCHAR) AS ip_address
FROM o""",
    ),
    "metrics_csv_source": """
SELECT date_trunc('second', ts) AS "timestamp", k AS cpu_percent, k / 2 AS memory_percent, k * 64 AS memory_used_mb,
       k / 8 AS disk_read_mb, value AS disk_write_mb, k / 4 AS network_sent_mb, k / 4 AS network_recv_mb
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)""",
    "output_tables": _with(
        EVENT_ORDERS,
        select="""
SELECT "timestamp" AS order_time, CAST(order_id AS VARCHAR) AS order_id, product_name, quantity, total_price,
       CAST(ip_address AS VARCHAR) AS ip_address
FROM o WHERE total_price >= 500000""",
    ),
    "total_price": _with(EVENT_ORDERS, select="SELECT order_id, price, quantity, total_price FROM o"),
    "high_value_orders": _with(EVENT_ORDERS, select=HIGH_VALUE),
    "stream_high_value_orders": _with(EVENT_ORDERS, select=HIGH_VALUE),
    "high_value_display": _with(
        EVENT_ORDERS,
        select="""
SELECT "timestamp" AS order_time, order_id, product_name, quantity, format('{:,}', total_price) AS total_price,
       ip_address
FROM o WHERE total_price >= 500000""",
    ),
    "having_count": _with(EVENT_ORDERS, POPULAR, select="SELECT * FROM popular WHERE order_count >= 20"),
    "window_fields": _with(
        EVENT_ORDERS,
        POPULAR,
        select="""
SELECT window_start AS "시작시간", window_end AS "종료시간", product_name AS "상품명", order_count AS "주문수",
       format('{:,}', total_sales) AS "총매출"
FROM popular""",
    ),
    "constant_column": _with(
        EVENT_ORDERS, _stats("6 hours"), select="SELECT stat_time, 0 AS suspicious_ip_count FROM stats"
    ),
    "order_verdict": _with(
        EVENT_ORDERS,
        _rolling(ONE_DAY),
        select="""
SELECT order_id, recent_orders, total_price,
       CASE WHEN recent_orders >= 5 THEN 'macro' WHEN total_price >= 500000 THEN 'high_value' ELSE 'normal' END AS verdict
FROM rolled""",
    ),
    "scalar_functions": _with(
        EVENT_ORDERS,
        select="""
SELECT order_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS time_text, format('{:,}', total_price) AS amount_text,
       total_price / 1048576 AS mb, "timestamp" - INTERVAL '10 minutes' AS cutoff
FROM o""",
    ),
    "session_timezone": _with(
        EVENT_ORDERS,
        select="""
SELECT order_id, "timestamp" + INTERVAL '9 hours' AS seoul_time, "timestamp" + INTERVAL '9 hours' AS seoul_time_of_instant
FROM o""",
    ),
    "agg_count": _with(EVENT_ORDERS, POPULAR, select="SELECT window_start, product_name, order_count FROM popular"),
    "agg_sum": _with(EVENT_ORDERS, POPULAR, select="SELECT window_start, product_name, total_sales FROM popular"),
    "agg_avg_truncated": _with(EVENT_ORDERS, _stats("6 hours"), select="SELECT stat_time, avg_order_value FROM stats"),
    "agg_collect_products": _with(EVENT_ORDERS, _lists(_tumbling("1 day"), 1), select="SELECT * FROM lists"),
    "popular_products_tumbling": _with(EVENT_ORDERS, POPULAR, select=LATEST_POPULAR),
    "compacted_latest": _with(
        EVENT_ORDERS, POPULAR, select="SELECT * REPLACE (CAST(order_count AS INTEGER) AS order_count) FROM popular"
    ),
    "emit_update": _with(EVENT_ORDERS, POPULAR, select=LATEST_POPULAR),
    "orders_source": _with(EVENT_ORDERS, POPULAR, select=LATEST_POPULAR),
    "late_data": _with(
        EVENT_ORDERS, POPULAR, select="SELECT * FROM popular WHERE window_start >= TIMESTAMP '2024-01-16'"
    ),
    "popular_products_sliding": _with(
        EVENT_ORDERS,
        POPULAR_SLIDING,
        select="SELECT * REPLACE (format('{:,}', total_sales) AS total_sales) FROM popular",
    ),
    "suspicious_ips_tumbling": _with(EVENT_ORDERS, SUSPICIOUS, select="SELECT * FROM suspicious"),
    "stream_suspicious_ips": _with(EVENT_ORDERS, SUSPICIOUS, select="SELECT * FROM suspicious"),
    "suspicious_ips_sliding": _with(
        EVENT_ORDERS,
        _lists(_sliding("1 day", "6 hours", 4), 5),
        select="SELECT * REPLACE (format('{:,}', total_spent) AS total_spent) FROM lists",
    ),
    "emit_append": _with(
        EVENT_ORDERS,
        _lists(_sliding("1 day", "6 hours", 4), 5),
        select=f"SELECT * FROM lists WHERE window_start + INTERVAL '1 day' <= {CLOSED.format('1 minute')}",
    ),
    "suspicious_ips_lines": _with(LINE_ORDERS, _suspicious(_tumbling("1 day"), 2), select="SELECT * FROM suspicious"),
    "realtime_stats": _with(EVENT_ORDERS, _stats("6 hours"), select=STATS),
    "stream_realtime_stats": _with(EVENT_ORDERS, _stats("6 hours"), select=STATS),
    "realtime_stats_enriched": _with(EVENT_ORDERS, _enriched("1 day", 5), select="SELECT * FROM enriched"),
    "stream_realtime_stats_enriched": _with(
        EVENT_ORDERS,
        _enriched("6 hours", 3),
        select=f"SELECT * FROM enriched WHERE stat_time <= {CLOSED.format('30 seconds')}",
    ),
    "tumbling_window": _with(LINE_ORDERS, _popular(_tumbling("1 day"), "1 day"), select="SELECT * FROM popular"),
    "sliding_window": _with(
        LINE_ORDERS, _popular(_sliding("3 days", "1 day", 3), "3 days"), select="SELECT * FROM popular"
    ),
    "rolling_ip_count": _with(EVENT_ORDERS, _rolling(ONE_DAY), select=ROLLED),
    "rolling_ip_count_stream": _with(EVENT_ORDERS, _rolling(ONE_DAY), select=ROLLED),
    "rolling_ip_count_ties": _with(LINE_ORDERS, _rolling(SEVEN_DAYS), select=ROLLED),
    "rolling_ip_count_arrival": _with(
        LINE_ORDERS,
        f"""
numbered AS (
  SELECT o.*, row_number() OVER (PARTITION BY ip_address ORDER BY "timestamp", order_id) AS place FROM o
),
rolled AS (
  SELECT numbered.*, place + 1 - min(place) OVER (
    PARTITION BY ip_address ORDER BY "timestamp"
    RANGE BETWEEN INTERVAL '{SEVEN_DAYS}' PRECEDING AND CURRENT ROW) AS recent_orders
  FROM numbered
)""",
        select=ROLLED,
    ),
    "sort_desc": _with(
        EVENT_ORDERS, POPULAR, select="SELECT * FROM popular ORDER BY order_count DESC, window_start, product_name"
    ),
    "top5_overall": _with(
        EVENT_ORDERS, POPULAR, select="SELECT * FROM popular ORDER BY order_count DESC, window_start, product_name LIMIT 5"
    ),
    "emit_complete": _with(
        EVENT_ORDERS,
        POPULAR_SLIDING,
        select="SELECT * FROM popular ORDER BY order_count DESC, window_start, product_name LIMIT 5",
    ),
    "top5_per_window": _with(
        LINE_ORDERS,
        _popular(_tumbling("1 day"), "1 day"),
        select="""
SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY order_count DESC, product_name) AS INTEGER) AS rank
FROM popular QUALIFY rank <= 5""",
    ),
    "counter_delta": _with(
        EVENT_ORDERS,
        """
counted AS (
  SELECT *, CAST(sum(quantity) OVER (PARTITION BY user_id ORDER BY "timestamp", order_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS sent_bytes
  FROM o
)""",
        select="""
SELECT order_id, sent_bytes,
       (sent_bytes - lag(sent_bytes) OVER (PARTITION BY user_id ORDER BY "timestamp", order_id)) / 1048576
         AS sent_bytes_delta_mb
FROM counted""",
    ),
    "throughput_report": """
WITH per_hour AS (
  SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, count(*) AS sent FROM events GROUP BY 1
), totals AS (
  SELECT *, CAST(sum(sent) OVER (ORDER BY window_start) AS BIGINT) AS total_sent,
         min(window_start) OVER () AS begun
  FROM per_hour
)
SELECT window_start, sent, total_sent,
       round(total_sent / date_diff('second', begun, window_start + INTERVAL '1 hour'), 9) AS avg_rate
FROM totals""",
    "delivery_success_rate": """
SELECT count(*) AS sent, count(*) FILTER (event_type = 'error') AS failed,
       100.0::DOUBLE * count(*) FILTER (event_type <> 'error') / count(*) AS success_rate
FROM events""",
    "load_summary": """
SELECT event_type AS level, count(*) AS samples, round(avg(k), 9) AS avg_cpu, max(k) AS peak_cpu,
       round(avg(k / 2), 9) AS avg_memory, round(avg(k * 64), 9) AS avg_memory_mb,
       min(value) AS min_disk_write_mb, max(value) AS max_disk_write_mb
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)
GROUP BY event_type""",
    "dash_order_series": _with(
        EVENT_ORDERS,
        _stats("6 hours"),
        select=f"SELECT stat_time, total_orders FROM stats WHERE {_between('stat_time')} ORDER BY 1",
    ),
    "dash_sales_series": _with(
        EVENT_ORDERS,
        _stats("6 hours"),
        select=f"SELECT stat_time, total_sales, avg_order_value FROM stats WHERE {_between('stat_time')} ORDER BY 1",
    ),
    "dash_suspicious_series": _with(
        EVENT_ORDERS,
        _enriched("1 day", 5),
        select=f"SELECT stat_time, suspicious_ip_count FROM enriched WHERE {_between('stat_time')} ORDER BY 1",
    ),
    "dash_top_products": _with(
        EVENT_ORDERS,
        POPULAR,
        select=f"""
SELECT product_name, CAST(sum(order_count) AS BIGINT) AS order_count, CAST(sum(total_sales) AS BIGINT) AS total_sales
FROM popular WHERE {_between('window_start')}
GROUP BY product_name ORDER BY 2 DESC, 1 LIMIT 5""",
    ),
    "dash_suspicious_table": _with(
        EVENT_ORDERS,
        SUSPICIOUS,
        select=f"""
SELECT * FROM suspicious WHERE {_between('window_start')}
ORDER BY window_start DESC, order_count DESC, CAST(ip_address AS VARCHAR) LIMIT 20""",
    ),
    "dash_high_value_count": _with(
        EVENT_ORDERS,
        select=f"""
SELECT count(*) AS high_value_count FROM o WHERE total_price >= 500000 AND {_between('"timestamp"')}""",
    ),
    "fan_out": _with(
        EVENT_ORDERS,
        POPULAR,
        SUSPICIOUS,
        _stats("6 hours"),
        select="""
SELECT 'popular_products' AS table_name, count(*) AS n, CAST(coalesce(sum(total_sales), 0) AS BIGINT) AS amount FROM popular
UNION ALL SELECT 'suspicious_ips', count(*), CAST(coalesce(sum(total_spent), 0) AS BIGINT) FROM suspicious
UNION ALL SELECT 'high_value_orders', count(*), CAST(coalesce(sum(total_price), 0) AS BIGINT) FROM o
  WHERE total_price >= 500000
UNION ALL SELECT 'realtime_stats', count(*), CAST(sum(total_sales) AS BIGINT) FROM stats""",
    ),
    "skip_empty_batch": _with(
        EVENT_ORDERS,
        CUTS,
        select="""
SELECT count(DISTINCT (SELECT count(*) FROM cuts WHERE cut <= "timestamp")) AS batches, count(*) AS orders
FROM o WHERE "timestamp" BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'""",
    ),
}
CLOSED_POPULAR = f"(SELECT * FROM popular WHERE window_end <= {CLOSED.format('1 minute')})"
ANSWERS |= {
    "output_tables_catalog": f"SELECT *, true AS numbered, true AS timed FROM ({ANSWERS['output_tables']})",
    "shutdown": _with(
        EVENT_ORDERS,
        CUTS,
        select="""
SELECT batch_id, count(*) AS orders, count(*) FILTER (product_name = 'error') AS rejects,
       (SELECT count(*) FROM o WHERE product_name <> 'error') AS decoded
FROM (SELECT *, (SELECT count(*) FROM cuts WHERE cut <= "timestamp") AS batch_id FROM o) GROUP BY batch_id""",
    ),
    "late_rows": _with(
        EVENT_ORDERS,
        select="""SELECT order_id, "timestamp", product_name, total_price FROM o WHERE "timestamp" < TIMESTAMP '2024-01-16'""",
    ),
    "windows_beside_late": _with(
        EVENT_ORDERS, POPULAR, select=f"SELECT * FROM {CLOSED_POPULAR} WHERE window_start >= TIMESTAMP '2024-01-16'"
    ),
    "top5_overall_stream": _with(
        EVENT_ORDERS,
        POPULAR,
        select=f"""
SELECT *, CAST(row_number() OVER (ORDER BY order_count DESC, window_start, product_name) AS INTEGER) AS rank
FROM {CLOSED_POPULAR} QUALIFY rank <= 5""",
    ),
    "top5_per_window_stream": _with(
        EVENT_ORDERS,
        POPULAR_SLIDING,
        select=f"""
SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY order_count DESC, product_name) AS INTEGER) AS rank
FROM {CLOSED_POPULAR} QUALIFY rank <= 2""",
    ),
    "realtime_stats_enriched_update": ANSWERS["realtime_stats_enriched"],
    "counter_delta_stream": _with(
        EVENT_ORDERS,
        select=f"""
SELECT order_id, CAST(price AS BIGINT) AS sent_bytes, sent_bytes_delta_mb
FROM (
  SELECT *, (price - lag(price) OVER (PARTITION BY user_id ORDER BY "timestamp", order_id)) / 1048576 AS sent_bytes_delta_mb
  FROM o
) WHERE time_bucket(INTERVAL '1 minute', "timestamp" + INTERVAL '59.999999 seconds') <= {CLOSED.format('1 minute')}""",
    ),
    "throughput_report_stream": f"""
SELECT * FROM ({ANSWERS["throughput_report"]})
WHERE window_start + INTERVAL '1 hour' <= {CLOSED.format('10 seconds')}""",
}
ANSWERS["alerts_verdicts"] = ANSWERS["order_verdict"]

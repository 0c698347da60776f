"""SQL over the raw tables that each registered query must agree with."""

from __future__ import annotations

from gatelens.functions import time
from gatelens.plans import queries as q

SQL: dict[str, str] = {}

# The views, spelled out a second time in SQL.
REQ = """
req AS (
  SELECT CAST(event_id AS VARCHAR) AS id, epoch_us(ts) // 1000 AS ms, strftime(ts, '%Y.%m.%d') AS day,
    'tx-' || event_id AS "transaction", 'api-' || (user_id % 5) AS api, 'app-' || user_id AS application,
    event_type AS endpoint, 'gw-' || (user_id % 3) AS gateway, CAST(event_id % 4 AS VARCHAR) AS method_code,
    CAST(100 * (1 + event_id % 5) + event_id % 3 AS INTEGER) AS status,
    CAST(trunc(value) AS INTEGER) AS response_time,
    CASE WHEN event_type <> 'error' THEN CAST(trunc(value / 2) AS INTEGER) END AS api_response_time,
    CAST(length(props) AS INTEGER) AS request_content_length,
    CASE WHEN event_type <> 'error' THEN CAST(trunc(value * 10) AS INTEGER) END AS response_content_length,
    '/' || event_type AS uri, '10.0.0.' || (user_id % 3) AS local_address,
    '192.168.0.' || (user_id % 200) AS remote_address,
    CASE WHEN user_id % 2 = 0 THEN 'acme' END AS tenant, 'plan-' || (user_id % 4) AS plan,
    CAST(NULL AS VARCHAR) AS api_key, CASE WHEN event_type = 'error' THEN props END AS message
  FROM events)"""

LOG = """
log AS (
  SELECT CAST(event_id AS VARCHAR) AS id, strftime(ts, '%Y.%m.%d') AS day, '/' || event_type AS uri, props AS body,
    CAST(user_id AS VARCHAR) AS header_user, CAST(CAST(trunc(value * 10) AS INTEGER) AS VARCHAR) AS header_size,
    CAST(100 * (1 + event_id % 5) + event_id % 3 AS INTEGER) AS status
  FROM events WHERE event_type <> 'view')"""

HEALTH = """
health AS (
  SELECT CAST(event_id AS VARCHAR) AS id, event_id, epoch_us(ts) // 1000 AS ms, strftime(ts, '%Y.%m.%d') AS day,
    'api-' || (user_id % 5) AS api, event_type AS endpoint, 'gw-' || (user_id % 3) AS gateway,
    CAST(trunc(value) AS INTEGER) AS response_time, value < 100 AS available,
    CAST(event_id % 3 AS INTEGER) AS state, props,
    CASE WHEN value < 100 THEN 200 ELSE 503 END AS step_status
  FROM events)"""

MONITOR = """
monitor AS (
  SELECT CAST(event_id AS VARCHAR) AS id, epoch_us(ts) // 1000 AS ms, event_id, value,
    'gw-' || (user_id % 3) AS gateway, 'host-' || (user_id % 3) AS hostname,
    CAST(floor(value * 100) AS BIGINT) AS size
  FROM events)"""


def within(time_range: time.TimeRange) -> str:
    return f"ms BETWEEN {time_range.start} AND {time_range.end}"


TEN_DAYS = within(q.TEN_DAYS)
MONTH_DAYS = "day BETWEEN '2023.12.30' AND '2024.01.30'"
FEBRUARY_DAYS = "day BETWEEN '2024.01.15' AND '2024.02.15'"
ROOT = "api = 'api-1'"


def floor(ms: int | str, interval: int) -> str:
    return f"({ms} // {interval}) * {interval}"


def bucket(interval: int = q.HOUR) -> str:
    return floor("ms", interval)


# --- scans -------------------------------------------------------------------


def per_day(view: str, name: str, where: str) -> str:
    return f"WITH {view} SELECT day, count(*) AS documents FROM {name} WHERE {where} GROUP BY day"


SQL["scan_day_range"] = per_day(REQ, "req", "day BETWEEN '2024.01.05' AND '2024.01.20'")
SQL["scan_today"] = per_day(REQ, "req", "day = '2024.01.30'")
SQL["scan_all_days"] = per_day(REQ, "req", "true")
SQL["scan_named_days"] = per_day(REQ, "req", "day IN ('2024.01.02', '2024.01.17', '2031.12.31')")
SQL["scan_last_month"] = per_day(HEALTH, "health", FEBRUARY_DAYS)
SQL["scan_all_types"] = f"""
WITH {REQ}, {LOG}, {HEALTH}, {MONITOR}
SELECT 'request' AS doc_type, count(*) AS documents, count(api) AS with_api, count(gateway) AS with_gateway,
  CAST(0 AS BIGINT) AS with_hostname FROM req
UNION ALL SELECT 'log', count(*), 0, 0, 0 FROM log
UNION ALL SELECT 'health', count(*), count(api), count(gateway), 0 FROM health
UNION ALL SELECT 'monitor', count(*), 0, count(gateway), count(hostname) FROM monitor
"""
SQL["day_sequence"] = """
WITH spans AS (
  SELECT user_id, date_trunc('day', min(ts)) AS a, date_trunc('day', max(ts)) AS b FROM events GROUP BY user_id),
covered AS (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY)) AS moment FROM spans)
SELECT strftime(moment, '%Y.%m.%d') AS day, count(*) AS applications FROM covered GROUP BY 1
"""

# --- count -------------------------------------------------------------------


def counted(where: str) -> str:
    return f"WITH {REQ} SELECT count(*) AS count FROM req WHERE {where}"


SQL["count_all"] = counted("true")
SQL["count_today"] = counted("day = '2024.01.30'")
SQL["count_range"] = counted(TEN_DAYS)
SQL["count_root_query"] = counted(f"{TEN_DAYS} AND {ROOT} AND endpoint = 'click' AND tenant = 'acme'")
SQL["count_expression"] = counted(f"{TEN_DAYS} AND (status >= 400 OR response_time > 100)")

# --- date histogram ----------------------------------------------------------


def axis(time_range: time.TimeRange, interval: int) -> str:
    ends = f"{floor(time_range.start, interval)}, {floor(time_range.end, interval)}"
    return f"axis AS (SELECT unnest(generate_series({ends}, {interval})) AS timestamp)"


SQL["hist_count"] = f"""
WITH {REQ}, {axis(q.PAST_DATA, q.HOUR)},
n AS (SELECT {bucket()} AS timestamp, count(*) AS n FROM req WHERE {within(q.PAST_DATA)} GROUP BY 1)
SELECT timestamp, coalesce(n, 0) AS count FROM axis LEFT JOIN n USING (timestamp)
"""


def metric_points(ordinal: int, kind: str, field: str, where: str, interval: int = q.HOUR) -> str:
    column = field.replace("-", "_")
    return f"""
SELECT * FROM (SELECT CAST({ordinal} AS INTEGER) AS ordinal, {bucket(interval)} AS timestamp, '{kind}' AS aggregation,
  '{field}' AS field, '{kind}_{field}' AS key, CAST(trunc({kind}({column})) AS BIGINT) AS value
FROM req WHERE {where} GROUP BY 2) WHERE value IS NOT NULL"""


def term_points(ordinal: int, field: str, where: str, interval: int = q.HOUR) -> str:
    column = field.replace("-", "_")
    return f"""
SELECT CAST({ordinal} AS INTEGER) AS ordinal, timestamp, 'field' AS aggregation, '{field}' AS field, key, value FROM (
  SELECT {bucket(interval)} AS timestamp, CAST({column} AS VARCHAR) AS key, count(*) AS value
  FROM req WHERE {where} AND {column} IS NOT NULL GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY timestamp ORDER BY value DESC, key) <= 10"""


def points(*parts: str) -> str:
    return f"WITH {REQ} " + "\nUNION ALL ".join(parts)


SQL["hist_avg"] = points(
    metric_points(0, "avg", "response-time", f"{TEN_DAYS} AND {ROOT}"),
    metric_points(1, "avg", "api-response-time", f"{TEN_DAYS} AND {ROOT}"),
)
SQL["hist_min"] = points(metric_points(0, "min", "response-time", f"{TEN_DAYS} AND {ROOT}"))
SQL["hist_max"] = points(metric_points(0, "max", "response-time", f"{TEN_DAYS} AND {ROOT}"))
SQL["hist_field"] = points(term_points(0, "application", TEN_DAYS))
SQL["hist_multi"] = points(
    metric_points(0, "avg", "response-time", TEN_DAYS),
    term_points(1, "application", TEN_DAYS),
    metric_points(2, "max", "api-response-time", TEN_DAYS),
    term_points(3, "status", TEN_DAYS),
)
SQL["hist_legacy_app"] = f"""
WITH {REQ}, p AS ({term_points(0, "application", f"{TEN_DAYS} AND api = 'api-2'")})
SELECT timestamp, key AS application, value AS documents FROM p
"""
SERIES_WHERE = f"{within(q.PAST_DATA)} AND endpoint = 'error'"
SQL["hist_series"] = f"""
WITH {REQ}, {axis(q.PAST_DATA, 6 * q.HOUR)}, p AS (
{metric_points(0, "avg", "response-time", SERIES_WHERE, 6 * q.HOUR)}
UNION ALL {term_points(2, "endpoint", SERIES_WHERE, 6 * q.HOUR)}),
size AS (SELECT CAST(count(*) AS INTEGER) AS axis FROM axis)
SELECT (SELECT axis FROM size) AS axis, ordinal AS slot,
  CASE aggregation WHEN 'field' THEN 'by_' ELSE 'avg_' END || field AS name, key,
  string_agg(timestamp || ':' || value, ' ' ORDER BY timestamp) AS points
FROM p GROUP BY ordinal, aggregation, field, key
UNION ALL SELECT (SELECT axis FROM size), 1, NULL, NULL, NULL
"""

# --- group by ----------------------------------------------------------------


def top(view: str, name: str, column: str, where: str, limit: int) -> str:
    return f"""
WITH {view}, n AS (
  SELECT {column} AS key, count(*) AS value FROM {name} WHERE {where} AND {column} IS NOT NULL GROUP BY 1)
SELECT key, value, CAST(row_number() OVER (ORDER BY value DESC, key) AS INTEGER) AS rank
FROM n ORDER BY value DESC, key LIMIT {limit}"""


def field_top(field: str, where: str) -> str:
    return f"SELECT '{field}' AS field, key, value, rank FROM ({top(REQ, 'req', field, where, 20)})"


def mean_top(field: str, mean_of: str, direction: str, where: str) -> str:
    return f"""
WITH {REQ}, n AS (
  SELECT {field} AS key, avg({mean_of}) AS mean FROM req WHERE {where} AND {field} IS NOT NULL
  GROUP BY 1 HAVING avg({mean_of}) IS NOT NULL)
SELECT '{field}' AS field, key, CAST(trunc(mean) AS BIGINT) AS value,
  CAST(row_number() OVER (ORDER BY mean {direction}, key) AS INTEGER) AS rank
FROM n ORDER BY mean {direction}, key LIMIT 20"""


def ranges(field: str, bounds, where: str) -> str:
    rows = ", ".join(f"('{float(a)}-{float(b)}', {a}, {b}, {i})" for i, (a, b) in enumerate(bounds, 1))
    column = field.replace("-", "_")
    return f"""
WITH {REQ}, r(key, a, b, rank) AS (VALUES {rows}), d AS (SELECT {column} AS x FROM req WHERE {where})
SELECT '{field}' AS field, key, count(x) AS value, CAST(rank AS INTEGER) AS rank
FROM r LEFT JOIN d ON x >= a AND x < b GROUP BY key, rank"""


SQL["group_terms"] = field_top("application", f"{TEN_DAYS} AND {ROOT}")
SQL["group_terms_avg_desc"] = mean_top("application", "response_time", "DESC", TEN_DAYS)
SQL["group_terms_avg_asc"] = mean_top("endpoint", "api_response_time", "ASC", f"{TEN_DAYS} AND {ROOT}")
SQL["group_terms_uri"] = field_top("transaction", TEN_DAYS).replace("SELECT transaction AS", 'SELECT "transaction" AS')
SQL["group_ranges"] = ranges("status", q.STATUS_RANGES, f"{TEN_DAYS} AND {ROOT}")
SQL["group_ranges_overlap"] = ranges("response-time", q.OVERLAPPING, TEN_DAYS)
SQL["raw_terms"] = top(HEALTH, "health", "api", TEN_DAYS, 10)
SQL["raw_search"] = f"""
WITH {REQ}, hits AS (SELECT id, ms, response_time FROM req WHERE response_time BETWEEN 50 AND 60)
SELECT id, response_time, (SELECT count(*) FROM hits) AS total FROM hits ORDER BY ms DESC, id DESC LIMIT 25
"""

# --- request logs ------------------------------------------------------------

METHOD = "CASE method_code WHEN '0' THEN 'CONNECT' WHEN '1' THEN 'DELETE' WHEN '2' THEN 'GET' END"


def log_columns(method: str) -> str:
    return f"""id, "transaction", gateway, ms AS timestamp, uri, {method} AS method, status,
  CAST(response_time AS BIGINT) AS response_time, CAST(coalesce(api_response_time, 0) AS BIGINT) AS api_response_time,
  CAST(request_content_length AS BIGINT) AS request_content_length,
  CAST(coalesce(response_content_length, 0) AS BIGINT) AS response_content_length,
  local_address, remote_address, tenant, application, api, plan, api_key, endpoint, message"""


SQL["tabular_page"] = f"""
WITH {REQ}, hits AS (SELECT * FROM req WHERE {TEN_DAYS} AND {ROOT})
SELECT {log_columns(METHOD)}, (SELECT count(*) FROM hits) AS total
FROM hits ORDER BY ms DESC, id DESC LIMIT 25 OFFSET 50
"""
SQL["tabular_deep_page"] = f"""
WITH {REQ}, hits AS (SELECT * FROM req WHERE {within(q.PAST_DATA)})
SELECT id, ms AS timestamp, (SELECT count(*) FROM hits) AS total
FROM hits ORDER BY ms DESC, id DESC LIMIT 9000 OFFSET 9000
"""
SQL["tabular_all_pages"] = f"""
WITH {REQ}, hits AS (SELECT * FROM req WHERE {TEN_DAYS} AND {ROOT}),
placed AS (SELECT *, row_number() OVER (ORDER BY ms DESC, id DESC) AS n FROM hits)
SELECT CAST((n - 1) // {q.PAGE // 4} + 1 AS INTEGER) AS page, id, ms AS timestamp, CAST(status AS INTEGER) AS status,
  (SELECT count(*) FROM hits) AS total
FROM placed
"""
SQL["tabular_page_of_many"] = f"""
WITH {REQ}, hits AS (SELECT * FROM req WHERE {TEN_DAYS} AND {ROOT})
SELECT id, ms AS timestamp, CAST(status AS INTEGER) AS status, (SELECT count(*) FROM hits) AS total
FROM hits ORDER BY ms DESC, id DESC LIMIT 20 OFFSET 40
"""
SQL["tabular_total"] = f"WITH {REQ} SELECT count(*) AS total FROM req WHERE {TEN_DAYS} AND {ROOT}"
SQL["tabular_without_payloads"] = f"""
WITH {REQ} SELECT {log_columns("method_code")} FROM req WHERE {TEN_DAYS} AND application = 'app-7'
ORDER BY ms DESC, id DESC LIMIT 10
"""
SQL["decode_method"] = f"WITH {REQ} SELECT {METHOD} AS method, count(*) AS documents FROM req GROUP BY 1"
SQL["request_by_ids"] = f"""
WITH {REQ}, {LOG}
SELECT r.id, r.day, {METHOD} AS method, CAST(coalesce(r.api_response_time, 0) AS BIGINT) AS api_response_time,
  l.uri, l.body, l.status
FROM req r LEFT JOIN log l ON l.id = r.id AND l.day = r.day
WHERE r.id IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer)
"""
SQL["request_missing_ids"] = f"""
WITH {REQ} SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS id FROM orders
WHERE CAST(o_orderkey AS VARCHAR) NOT IN (SELECT id FROM req)
"""
SQL["request_day_with_log"] = f"""
WITH {REQ}, {LOG}
SELECT r.id, r.day, r.ms AS timestamp, r."transaction", r.message, l.uri AS logged_uri, l.header_user AS logged_user,
  true AS no_proxy_request
FROM req r LEFT JOIN log l ON l.id = r.id AND l.day = r.day
"""
SQL["headers_map"] = f"""
WITH {LOG} SELECT 'X-Size' AS name, header_size AS size, count(*) AS documents FROM log GROUP BY 2
"""

# --- health checks -----------------------------------------------------------


def windows(now: int) -> str:
    intervals = {"1M": "1 MONTH", "1w": "7 DAY", "1d": "1 DAY", "1h": "1 HOUR", "1m": "1 MINUTE"}
    moment = f"make_timestamp({now} * 1000)"
    rows = ", ".join(f"('{label}', epoch_ms({moment} - INTERVAL {span}))" for label, span in intervals.items())
    return f'w("range", "from") AS (VALUES {rows})'


def top_health(field: str, where: str) -> str:
    return f"""t AS (
  SELECT {field} AS key, CAST(row_number() OVER (ORDER BY count(*) DESC, {field}) AS INTEGER) AS rank
  FROM health WHERE {where} GROUP BY {field} QUALIFY rank <= 10)"""


def window_join(field: str, where: str) -> str:
    return f"""FROM t CROSS JOIN w LEFT JOIN (SELECT * FROM health WHERE {where}) h
  ON h.{field} = t.key AND h.ms >= w."from" GROUP BY key, rank, "range", "from\""""


def available(field: str, api: str) -> str:
    where = f"{MONTH_DAYS} AND api = '{api}'"
    return f"""
WITH {HEALTH}, {windows(q.NOW)}, {top_health(field, where)}
SELECT key, rank, "range", "from", CASE WHEN count(h.available) = 0 THEN 100.0::DOUBLE
  ELSE (count(*) FILTER (WHERE h.available))::DOUBLE / count(h.available) * 100 END AS percent
{window_join(field, where)}"""


def response_time(field: str, api: str, month: str, now: int) -> str:
    where = f"{month} AND api = '{api}'"
    return f"""
WITH {HEALTH}, {windows(now)}, {top_health(field, where)}, v AS (
SELECT key, rank, "range", "from", coalesce(CAST(trunc(avg(h.response_time)) AS BIGINT), 0) AS value
{window_join(field, where)})
SELECT * FROM v WHERE key IN (SELECT key FROM v WHERE value <> 0)"""


SQL["availability_endpoint"] = available("endpoint", "api-1")
SQL["availability_gateway"] = available("gateway", "api-2")
SQL["avg_response_time"] = response_time("endpoint", "api-1", MONTH_DAYS, q.NOW)
SQL["avg_response_time_gateway"] = response_time("gateway", "api-3", FEBRUARY_DAYS, q.MID_FEBRUARY)

def health_hours(api: str) -> str:
    return f"""b AS (
  SELECT {bucket()} AS timestamp, * FROM health WHERE {MONTH_DAYS} AND api = '{api}')"""


# The axis reaches over the data and the bounds.
HEALTH_AXIS = f"""ends AS (
  SELECT least(min(timestamp), {floor(q.TEN_DAYS.start, q.HOUR)}) AS a,
    greatest(max(timestamp), {floor(q.TEN_DAYS.end, q.HOUR)}) AS z FROM b),
axis AS (SELECT unnest(generate_series(a, z, {q.HOUR})) AS timestamp FROM ends)"""

SQL["health_hist_count"] = f"""
WITH {HEALTH}, {health_hours("api-1")}, {HEALTH_AXIS}
SELECT axis.timestamp, count(b.id) AS count FROM axis LEFT JOIN b USING (timestamp) GROUP BY 1
"""
SQL["health_hist_axis"] = f"""
WITH {HEALTH}, {health_hours("api-2")}, {HEALTH_AXIS}
SELECT CAST(row_number() OVER (ORDER BY timestamp) - 1 AS INTEGER) AS position, timestamp FROM axis
"""


def health_points(ordinal: int, kind: str, field: str, key: str, value: str) -> str:
    return f"""
SELECT CAST({ordinal} AS INTEGER) AS ordinal, timestamp, '{kind}' AS aggregation, '{field}' AS field, '{key}' AS key,
  CAST({value} AS DOUBLE) AS value FROM b GROUP BY timestamp"""


def health_series(*parts: str) -> str:
    return f"WITH {HEALTH}, {health_hours('api-1')} " + "\nUNION ALL ".join(parts)


SQL["health_hist_avg"] = health_series(
    health_points(0, "avg", "response-time", "avg_response-time", "trunc(avg(response_time))")
)
SQL["health_hist_avail"] = health_series(
    health_points(0, "field", "available", "by_available", "(count(*) FILTER (WHERE available))::DOUBLE / count(*) * 100")
)
SQL["health_hist_minmax"] = health_series(
    health_points(0, "min", "response-time", "min_response-time", "min(response_time)"),
    health_points(1, "max", "response-time", "max_response-time", "max(response_time)"),
)

SIX_HOURS = 6 * q.HOUR


def health_slot(slot: int, kind: str) -> str:
    return f"""
SELECT (SELECT n FROM size) AS axis, CAST({slot} AS INTEGER) AS slot, '{kind}_response-time' AS name,
  '{kind}_response-time' AS key, string_agg(timestamp || ':' || value || '.0', ' ' ORDER BY timestamp) AS points
FROM (SELECT {bucket(SIX_HOURS)} AS timestamp, {kind}(response_time) AS value FROM h GROUP BY 1)"""


SQL["health_hist_series"] = f"""
WITH {HEALTH}, h AS (SELECT * FROM health WHERE {MONTH_DAYS} AND api = 'api-1'),
size AS (SELECT CAST((
    greatest(max({bucket(SIX_HOURS)}), {floor(q.TEN_DAYS.end, SIX_HOURS)})
    - least(min({bucket(SIX_HOURS)}), {floor(q.TEN_DAYS.start, SIX_HOURS)})) // {SIX_HOURS} + 1 AS INTEGER) AS n
  FROM h)
{health_slot(0, "max")} UNION ALL {health_slot(2, "min")}
UNION ALL SELECT (SELECT n FROM size), 1, NULL, NULL, NULL
"""

FIRST_STEP = """CASE event_id % 3 WHEN 0 THEN '/' || endpoint WHEN 1 THEN '/probe' END AS uri,
  CASE WHEN event_id % 3 < 2 THEN 'GET' END AS method, CASE WHEN event_id % 3 < 2 THEN step_status END AS status"""
HEALTH_ROW = "id, gateway, ms AS timestamp, endpoint, CAST(response_time AS BIGINT) AS response_time, available, state"

SQL["health_logs_page"] = f"""
WITH {HEALTH}, hits AS (SELECT * FROM health WHERE {MONTH_DAYS} AND api = 'api-1')
SELECT {HEALTH_ROW}, available AS success, {FIRST_STEP}, (SELECT count(*) FROM hits) AS total
FROM hits ORDER BY ms DESC, id DESC LIMIT 30 OFFSET 30
"""
SQL["health_by_ids"] = f"""
WITH {HEALTH} SELECT {HEALTH_ROW}, available AS success,
  CAST(CASE event_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS INTEGER) AS steps
FROM health WHERE id IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer)
"""
SQL["health_steps"] = f"""
WITH {HEALTH}, n(position) AS (VALUES (0), (1))
SELECT id, CAST(position AS INTEGER) AS position, available AS success,
  CASE WHEN NOT available THEN 'too slow' END AS message, {FIRST_STEP},
  CASE WHEN event_id % 3 = 0 THEN props END AS body
FROM health CROSS JOIN n WHERE event_id % 3 < 2 AND position <= event_id % 3
"""

# --- monitoring --------------------------------------------------------------

# How often ``size`` each counter of the monitor view is.
FACTORS = {
    "os_mem_free_in_bytes": 3, "os_mem_free_percent": 1, "os_mem_total_in_bytes": 10,
    "os_mem_used_in_bytes": 7, "os_mem_used_percent": 2,
    "jvm_process_max_file_descriptors": 80, "jvm_process_open_file_descriptors": 81,
    "jvm_uptime_in_millis": 70, "jvm_thread_count": 71, "jvm_thread_peak_count": 72,
    "jvm_heap_committed_in_bytes": 20, "jvm_heap_max_in_bytes": 21, "jvm_heap_used_in_bytes": 22,
    "jvm_heap_used_percent": 23, "jvm_non_heap_committed_in_bytes": 24, "jvm_non_heap_used_in_bytes": 25,
    "jvm_gc_collectors_old_collection_count": 60, "jvm_gc_collectors_old_collection_time_in_millis": 61,
    "jvm_gc_collectors_young_collection_count": 62, "jvm_gc_collectors_young_collection_time_in_millis": 63,
    **{
        f"jvm_mem_pool_{pool}_{counter}": factor * times
        for pool, factor in (("old", 30), ("survivor", 40), ("young", 50))
        for counter, times in (
            ("used_in_bytes", 1), ("peak_used_in_bytes", 2), ("max_in_bytes", 4), ("peak_max_in_bytes", 5),
        )
    },
}

SNAPSHOT = ", ".join(f"size * {factor} AS {name}" for name, factor in FACTORS.items())


def snapshots(where: str) -> str:
    return f"""
WITH {MONITOR}
SELECT gateway AS gateway_id, ms AS timestamp, hostname, event_id % 100 AS os_cpu_percent, ms AS jvm_timestamp,
  {SNAPSHOT},
  value AS load_1m, value / 2 AS load_5m, value / 4 AS load_15m
FROM monitor WHERE strftime(make_timestamp(ms * 1000), '%Y.%m.%d') = '2024.01.30' AND {where}
QUALIFY row_number() OVER (PARTITION BY gateway ORDER BY ms DESC, id DESC) = 1"""


SQL["latest_snapshot"] = snapshots("gateway = 'gw-1'")
SQL["latest_per_gateway"] = snapshots("true")

# --- ingestion ---------------------------------------------------------------

SQL["bulk_parse"] = SQL["bulk_ingest"] = SQL["stream_ingest"] = f"""
WITH {REQ}
SELECT id, day, ms AS timestamp, api, endpoint, method_code AS method,
  CAST(CASE WHEN endpoint = 'error' THEN 599 ELSE status END AS SMALLINT) AS status, response_time, api_response_time
FROM req
"""

SQL["stream_ingest_many_files"] = f"""
SELECT r.*, CAST(n AS INTEGER) AS max_files FROM ({SQL["stream_ingest"]}) r CROSS JOIN (VALUES (2), (1000)) t(n)
"""
SQL["bulk_ingest_rejects"] = """
SELECT CASE WHEN event_id % 11 = 0 THEN 'no usable action' WHEN event_id % 13 = 0 THEN 'unknown type'
  WHEN event_id % 17 = 0 THEN 'unreadable document' WHEN event_id % 19 = 0 THEN 'bad timestamp'
  ELSE 'stored' END AS reason, count(*) AS records
FROM events GROUP BY 1
"""

# --- edges -------------------------------------------------------------------

SQL["count_query_or_not"] = counted(
    f"{TEN_DAYS} AND (endpoint = 'click' OR (tenant IS DISTINCT FROM 'acme' AND gateway = 'gw-1') OR status = 404)"
)
SQL["count_query_wildcard"] = counted("application LIKE 'app-1_%' AND message IS NOT NULL AND uri LIKE '/%r%'")
SQL["count_query_range"] = counted(
    f"{TEN_DAYS} AND response_time >= 20 AND response_time < 80 AND (status >= 300 OR status > 100)"
)
SQL["hist_response"] = SQL["hist_series"]
SIX = 6 * q.HOUR
SQL["hist_chunks"] = f"""
WITH {REQ}, p AS (
{metric_points(0, "avg", "response-time", SERIES_WHERE, SIX)}
UNION ALL {term_points(2, "endpoint", SERIES_WHERE, SIX)})
SELECT ordinal AS slot, key, timestamp // {SIX * q.CHUNK} * {SIX * q.CHUNK} AS chunk_start,
  string_agg(timestamp || ':' || value, ' ' ORDER BY timestamp) AS points
FROM p GROUP BY ordinal, key, chunk_start
UNION ALL SELECT 1, NULL, NULL, NULL
"""
SQL["hist_axis_chunks"] = f"""
WITH {axis(q.PAST_DATA, SIX)}
SELECT timestamp // {SIX * q.CHUNK} * {SIX * q.CHUNK} AS chunk_start, CAST(count(*) AS INTEGER) AS buckets, max(timestamp) AS last
FROM axis GROUP BY 1
"""
SQL["hist_nothing_found"] = f"""
WITH {axis(q.PAST_DATA, 6 * q.HOUR)}
SELECT (SELECT CAST(count(*) AS INTEGER) FROM axis) AS axis, CAST(slot AS INTEGER) AS slot,
  CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS key, CAST(NULL AS VARCHAR) AS points
FROM (VALUES (0), (1)) t(slot)
"""
SQL["hist_not_a_number"] = f"""
WITH {REQ} SELECT {bucket()} AS timestamp, CAST(trunc(avg(response_time)) AS BIGINT) AS value
FROM req WHERE {TEN_DAYS} GROUP BY 1
HAVING count(*) FILTER (CAST(id AS BIGINT) % 97 = 0 OR CAST(id AS BIGINT) % 89 = 0) = 0
"""
SQL["health_hist_response"] = SQL["health_hist_series"]
DATED = HEALTH.replace("epoch_us(ts) // 1000 AS ms", "CASE WHEN event_id % 7 > 0 THEN epoch_us(ts) // 1000 END AS ms")
SQL["health_hist_undated"] = f"""
WITH {DATED}, {health_hours("api-1").replace(" AND api", " AND ms IS NOT NULL AND api")}, {HEALTH_AXIS}
SELECT axis.timestamp, count(b.id) AS count FROM axis LEFT JOIN b USING (timestamp) GROUP BY 1
"""
ZERO = HEALTH.replace(
    "CAST(trunc(value) AS INTEGER) AS response_time",
    "CASE WHEN event_type = 'click' THEN 0 ELSE CAST(trunc(value) AS INTEGER) END AS response_time",
)
SQL["avg_response_time_zero"] = SQL["avg_response_time"].replace(HEALTH, ZERO)
CUT = HEALTH.replace("event_type AS endpoint", "event_type || '-' || (event_id % 4) AS endpoint")
SQL["availability_cut"] = SQL["availability_endpoint"].replace(HEALTH, CUT)
UNDATED = HEALTH.replace("epoch_us(ts) // 1000 AS ms", "CASE WHEN event_id % 10 > 0 THEN epoch_us(ts) // 1000 END AS ms")
SQL["health_logs_all_pages"] = f"""
WITH {UNDATED}, hits AS (SELECT * FROM health WHERE {MONTH_DAYS}),
placed AS (SELECT *, row_number() OVER (ORDER BY ms DESC NULLS LAST, id DESC) AS n FROM hits)
SELECT CAST((n - 1) // {q.PAGE} + 1 AS INTEGER) AS page, id, ms AS timestamp, (SELECT count(*) FROM hits) AS total
FROM placed
"""

# --- the operations over an ingested store -----------------------------------

SQL["store_count"] = SQL["count_root_query"]
SQL["store_histogram"] = SQL["hist_series"]
SQL["store_group_by"] = SQL["group_terms"]
SQL["store_tabular"] = SQL["tabular_page"]
SQL["store_find_requests"] = SQL["request_by_ids"]
LISTED = "(" + ", ".join(f"'{i}'" for i in q.STORED_IDS) + ")"
SQL["store_find_requests_listed"] = SQL["request_by_ids"].replace("(SELECT CAST(c_custkey AS VARCHAR) FROM customer)", LISTED)
SQL["store_availability"] = SQL["availability_endpoint"]
SQL["store_response_time"] = SQL["avg_response_time"]
SQL["store_health_histogram"] = f"""
WITH {HEALTH}, h AS (SELECT * FROM health WHERE {MONTH_DAYS} AND api = 'api-1'),
size AS (SELECT CAST((
    greatest(max({bucket(SIX_HOURS)}), {floor(q.TEN_DAYS.end, SIX_HOURS)})
    - least(min({bucket(SIX_HOURS)}), {floor(q.TEN_DAYS.start, SIX_HOURS)})) // {SIX_HOURS} + 1 AS INTEGER) AS n
  FROM h)
{health_slot(0, "max")} UNION ALL {health_slot(1, "min")}
"""
SQL["store_health_logs"] = SQL["health_logs_page"]
SQL["store_find_health"] = SQL["health_by_ids"].replace("(SELECT CAST(c_custkey AS VARCHAR) FROM customer)", LISTED)
SQL["store_latest"] = SQL["latest_per_gateway"]
SQL["store_all_types"] = SQL["scan_all_types"]
SQL["store_missing_days"] = SQL["scan_named_days"]

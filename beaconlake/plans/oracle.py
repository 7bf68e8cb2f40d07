"""The SQL each query is checked against: a second statement of its meaning over the given tables."""

from __future__ import annotations

from beaconlake.functions.attributes import UNITS
from beaconlake.functions.checks import RETENTION_DAYS
from beaconlake.plans.inputs import EPOCH_2024, GAUGE_UNITS, NOW_MS

DAY = 86_400_000

# Counterparts of the derived input tables in `beaconlake.plans.inputs`.
EV = """ev AS (
  SELECT '/app/' || event_type AS log_group, 'stream-' || (user_id % 8) AS log_stream,
         epoch_us(ts) // 1000 AS timestamp_ms, epoch_us(ts) // 1000 + event_id % 5000 AS ingestion_time_ms,
         lpad(CAST(event_id + 1 AS VARCHAR), 19, '0') AS event_id,
         event_type || ' user=' || user_id || ' props=' || props AS message
  FROM events)"""
MD = """md AS (
  SELECT '/app/metrics' AS namespace, event_type AS metric_name, epoch_us(ts) // 1000 AS timestamp_ms, value,
         CASE user_id % 4 WHEN 0 THEN 'None' WHEN 1 THEN 'Milliseconds' WHEN 2 THEN 'Bytes' ELSE 'Count' END AS unit,
         'svc-' || (user_id % 10) AS svc, 'ns-' || (user_id % 3) AS ns
  FROM events)"""
SERIES = """'{"service.name":"' || svc || '","service.namespace":"' || ns || '"}'"""
REG = f"""reg AS (
  SELECT log_group, CAST(NULL AS VARCHAR) AS log_stream, CAST(NULL AS BIGINT) AS retention_in_days,
         min(timestamp_ms) AS created_ms
  FROM ev WHERE log_group <> '/app/signup' GROUP BY log_group
  UNION ALL
  SELECT '/crm/' || lower(c_mktsegment), NULL,
         CASE WHEN starts_with(lower(c_mktsegment), 'b') THEN 30 END, {EPOCH_2024} + min(c_custkey)
  FROM customer GROUP BY lower(c_mktsegment)
  UNION ALL
  SELECT '/app/' || event_type, 'stream-' || (user_id % 8), NULL, min(epoch_us(ts) // 1000)
  FROM events WHERE user_id < 5 GROUP BY ALL)"""
GROUP_NAMES = """inv AS (
  SELECT c_custkey AS seq, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_nationkey < 5 THEN '/crm/' || lower(c_mktsegment)
         WHEN c_nationkey < 8 THEN '/app/error' ELSE '/nation/' || c_nationkey END AS log_group
  FROM customer)"""
STREAM_NAMES = """inv AS (
  SELECT event_id AS seq, CASE WHEN event_type <> 'signup' THEN '/app/' || event_type END AS log_group,
         CASE WHEN value >= 1 THEN 'stream-' || (user_id % 8) END AS log_stream
  FROM events)"""
_DAYS = ", ".join(str(d) for d in RETENTION_DAYS)
SETTINGS = f"""st AS (
  SELECT c_custkey AS seq, CASE WHEN c_acctbal >= 0 THEN '/crm/' || lower(c_mktsegment) END AS log_group,
         CAST(list_extract([{_DAYS}], c_nationkey % {len(RETENTION_DAYS)} + 1) AS BIGINT) AS retention_in_days
  FROM customer)"""
_UNIT_LIST = ", ".join("NULL" if u is None else f"'{u}'" for u in GAUGE_UNITS)
_UNIT_CASES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in UNITS.items())
TRANSLATED = (
    f"CASE coalesce(unit, '') {_UNIT_CASES} ELSE CASE WHEN unit LIKE '{{%}}' THEN 'Count' ELSE 'None' END END"
)
GAUGE = f"""gauge AS (
  SELECT event_id AS seq, event_type AS name, CASE WHEN value >= 1 THEN value END AS double_value, ts,
         list_extract([{_UNIT_LIST}], user_id % 15 + 1) AS unit, 'svc-' || (user_id % 10) AS service,
         'z ' || (user_id % 3) AS zone, 'h~' || (user_id % 7) || '*' AS host
  FROM events)"""
DATA = f"""dt AS (
  SELECT seq, '/app/metrics' AS namespace, name AS metric_name, epoch_us(ts) // 1000000 AS timestamp_seconds,
         double_value AS value, {TRANSLATED} AS unit, service, zone, host
  FROM gauge WHERE double_value IS NOT NULL),
sized AS (
  SELECT *, 200 + octet_length(encode(metric_name)) + octet_length(encode(unit))
         + 360 + 12 + 4 + 4 + octet_length(encode(service)) + octet_length(encode(zone))
         + octet_length(encode(host)) AS bytes
  FROM dt)"""
PUT = f"""pe AS (
  SELECT doc_id AS seq, '/docs/' || lang AS log_group, 'ingest' AS log_stream,
         {EPOCH_2024} + doc_id * 3600000 AS timestamp_ms, text AS message
  FROM documents)"""


def _log_plan(count: int = 10_000, size: int = 1_048_576, span: int = DAY) -> str:
    """Greedy batches of `pe`, one row of each destination per step."""
    return f"""{PUT},
ranked AS (
  SELECT *, octet_length(encode(message)) + 26 AS bytes,
         row_number() OVER (PARTITION BY log_group ORDER BY timestamp_ms, seq) AS n
  FROM pe),
walk AS (
  SELECT log_group, n, seq, 0 AS batch_no, 0 AS index_in_batch, timestamp_ms AS first_ms,
         CAST(bytes AS BIGINT) AS total
  FROM ranked WHERE n = 1
  UNION ALL
  SELECT r.log_group, r.n, r.seq,
         w.batch_no + CASE WHEN fits THEN 0 ELSE 1 END, CASE WHEN fits THEN w.index_in_batch + 1 ELSE 0 END,
         CASE WHEN fits THEN w.first_ms ELSE r.timestamp_ms END,
         CAST(CASE WHEN fits THEN w.total ELSE 0 END + r.bytes AS BIGINT)
  FROM walk w JOIN (SELECT * FROM ranked) r ON r.log_group = w.log_group AND r.n = w.n + 1,
       LATERAL (SELECT w.index_in_batch + 1 < {count} AND w.total + r.bytes <= {size}
                       AND r.timestamp_ms <= w.first_ms + {span} AS fits) f),
planned AS (
  SELECT pe.*, w.batch_no, w.index_in_batch FROM walk w JOIN pe USING (seq))"""


def _metric_plan(count: int = 1_000, size: int = 800_000) -> str:
    """Greedy batches of `sized`, one row of each metric per step."""
    return f"""{GAUGE}, {DATA},
ranked AS (SELECT *, row_number() OVER (PARTITION BY metric_name ORDER BY seq) AS n FROM sized),
walk AS (
  SELECT metric_name, n, seq, 0 AS batch_no, 0 AS index_in_batch, CAST(bytes AS BIGINT) AS total
  FROM ranked WHERE n = 1
  UNION ALL
  SELECT r.metric_name, r.n, r.seq,
         w.batch_no + CASE WHEN fits THEN 0 ELSE 1 END, CASE WHEN fits THEN w.index_in_batch + 1 ELSE 0 END,
         CAST(CASE WHEN fits THEN w.total ELSE 0 END + r.bytes AS BIGINT)
  FROM walk w JOIN ranked r ON r.metric_name = w.metric_name AND r.n = w.n + 1,
       LATERAL (SELECT w.index_in_batch + 1 < {count} AND w.total + r.bytes <= {size} AS fits) f),
planned AS (SELECT sized.*, w.batch_no, w.index_in_batch FROM walk w JOIN sized USING (seq))"""


def _otlp(where: str = "", tail: str = "") -> str:
    return f"""WITH {EV}
SELECT make_timestamp(timestamp_ms * 1000) AS time_unix_nano,
       make_timestamp(ingestion_time_ms * 1000) AS observed_time_unix_nano,
       CAST(NULL AS VARCHAR) AS trace_id, CAST(NULL AS VARCHAR) AS span_id, CAST(NULL AS VARCHAR) AS service_name,
       CAST(NULL AS VARCHAR) AS service_namespace, CAST(NULL AS VARCHAR) AS service_instance_id,
       CAST(NULL AS INTEGER) AS severity_number, CAST(NULL AS VARCHAR) AS severity_text,
       CAST(NULL AS VARCHAR) AS event_name, message AS body,
       '{{"cloud.provider":"aws","cloud.region":"us-east-1","aws.log.group.names":["' || log_group
         || '"],"aws.log.stream.names":["' || log_stream || '"]}}' AS resource_attributes,
       CAST(NULL AS VARCHAR) AS scope_name, CAST(NULL AS VARCHAR) AS scope_version,
       CAST(NULL AS VARCHAR) AS scope_attributes,
       '{{"aws.cloudwatch.log.event_id":"' || event_id || '"}}' AS log_attributes,
       CAST(NULL AS INTEGER) AS dropped_attributes_count, CAST(NULL AS INTEGER) AS flags
FROM ev {where} {tail}"""


_EV_COLUMNS = "log_group, log_stream, timestamp_ms, ingestion_time_ms, event_id, message"


def _events(where: str = "", tail: str = "") -> str:
    return f"WITH {EV} SELECT {_EV_COLUMNS} FROM ev {where} {tail}"


def _attached_logs() -> str:
    """The rows of all log views, each with the view's name."""
    rows = _otlp(f"JOIN (SELECT DISTINCT log_group FROM reg WHERE log_stream IS NULL) USING (log_group) WHERE timestamp_ms >= {NOW_MS - 30 * DAY} AND timestamp_ms < {NOW_MS}")
    return rows.replace(f"WITH {EV}", f"WITH {EV}, {REG}", 1).replace("SELECT make_timestamp", "SELECT 'logs.' || log_group AS relation, make_timestamp", 1)


_BUCKET = f"timestamp_ms // {6 * 3_600_000} * {6 * 3_600_000}"


def _plain(aggregate: str) -> str:
    return f"WITH {MD} SELECT metric_name, {_BUCKET} AS bucket_ms, {aggregate} AS value FROM md GROUP BY ALL"


def _bounded(aggregate: str) -> str:
    return f"""WITH {MD}, b AS (SELECT metric_name, {_BUCKET} AS bucket_ms, value FROM md),
q AS (
  SELECT metric_name, bucket_ms, quantile_cont(value, 0.9) AS q90, quantile_cont(value, 0.25) AS q25,
         quantile_cont(value, 0.75) AS q75
  FROM b GROUP BY ALL)
SELECT metric_name, bucket_ms, {aggregate} AS value FROM b JOIN q USING (metric_name, bucket_ms) GROUP BY ALL"""


_RECONCILED = f"""{_log_plan()},
counted AS (SELECT log_group, batch_no, count(*) AS n FROM planned GROUP BY ALL),
outcome AS (
  SELECT p.seq, p.log_group, p.log_stream, p.timestamp_ms, p.batch_no, p.index_in_batch,
         CASE WHEN p.log_group = '/docs/en' THEN NULL
              WHEN p.log_group = '/docs/es' AND p.batch_no % 2 = 1 THEN 'unreadable_response'
              WHEN p.log_group = '/docs/de' AND c.n < 3 THEN 'entity_rejected'
              WHEN p.log_group = '/docs/fr' AND p.index_in_batch <= 1 THEN 'expired'
              WHEN p.log_group IN ('/docs/fr', '/docs/es') AND p.index_in_batch <= 2 THEN 'too_old'
              WHEN p.log_group = '/docs/de' AND p.index_in_batch >= c.n - 1 THEN 'too_new'
              ELSE 'ok' END AS status
  FROM planned p JOIN counted c USING (log_group, batch_no))"""

_LOG_BODIES = f"""bodies AS (
  SELECT doc_id, {EPOCH_2024} + doc_id * 1000 AS stamp, text, source,
         CASE WHEN n_chars < 1000 THEN '/app/error' ELSE '/app/absent' END AS log_group,
         CASE lang WHEN 'de' THEN 'an event has no text as message' WHEN 'fr' THEN 'the body is not a JSON object'
                   WHEN 'es' THEN 'the body names no log group or no log stream' END AS reason
  FROM documents),
received AS (
  SELECT log_group, 'stream-1' AS log_stream, stamp AS timestamp_ms, CAST({NOW_MS} AS BIGINT) AS ingestion_time_ms,
         lpad(CAST(doc_id AS VARCHAR), 19, '0') || '0000000000' AS event_id, text AS message
  FROM bodies WHERE reason IS NULL
  UNION ALL
  SELECT log_group, 'stream-1', stamp + 1, {NOW_MS}, lpad(CAST(doc_id AS VARCHAR), 19, '0') || '0000000001', source
  FROM bodies WHERE reason IS NULL)"""

_METRIC_BODIES = f"""
  SELECT '/app/metrics' AS namespace, event_type AS metric_name,
         CASE WHEN event_type = 'click' THEN {NOW_MS} ELSE epoch_us(ts) // 1000000 * 1000 END AS timestamp_ms,
         value, 'None' AS unit, '{{"service name":"svc/' || (user_id % 10) || '"}}' AS dimensions
  FROM events WHERE event_type IN ('click', 'signup')
  UNION ALL
  SELECT '/app/metrics', 'second', {NOW_MS}, CAST(user_id AS DOUBLE), 'Bytes', '{{}}'
  FROM events WHERE event_type = 'click'"""

_DESTINATIONS = f"""{EV}, {REG},
grp AS (SELECT DISTINCT log_group FROM reg WHERE log_stream IS NULL),
str AS (SELECT DISTINCT log_group, log_stream FROM reg WHERE log_stream IS NOT NULL)"""
_PROBLEM = """CASE WHEN e.log_group NOT IN (SELECT log_group FROM grp) THEN 'the log group is not registered'
       WHEN (e.log_group, e.log_stream) NOT IN (SELECT (log_group, log_stream) FROM str)
       THEN 'the log stream is not registered' END AS problem"""

_GROUP_OUTCOMES = f"""{EV}, {REG}, {GROUP_NAMES},
have AS (SELECT DISTINCT log_group FROM reg WHERE log_stream IS NULL),
judged AS (
  SELECT seq, log_group, log_group IN (SELECT log_group FROM have) AS known,
         seq = min(seq) OVER (PARTITION BY log_group) AS first_row
  FROM inv)"""
_STREAM_OUTCOMES = f"""{EV}, {REG}, {STREAM_NAMES},
have AS (SELECT DISTINCT log_group, log_stream FROM reg WHERE log_stream IS NOT NULL),
judged AS (
  SELECT i.seq, i.log_group, i.log_stream, h.log_group IS NOT NULL AS known,
         i.seq = min(i.seq) OVER (PARTITION BY i.log_group, i.log_stream) AS first_row
  FROM inv i LEFT JOIN have h USING (log_group, log_stream))"""
_CREATED = "CASE WHEN {name} IS NULL THEN NULL WHEN NOT known AND first_row THEN 'created' ELSE 'exists' END"
_DELETED = "CASE WHEN log_group IS NULL THEN NULL WHEN known AND first_row THEN 'deleted' ELSE 'absent' END"

_TOKENS = """pg AS (
  SELECT user_id AS request_id, event_id AS page_no, 't-' || CAST(floor(value) AS BIGINT) AS token_in,
         CASE WHEN k = 0 THEN '' ELSE 't-' || k END AS next_token, event_type AS body
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events))"""

_ALARMS = """sup AS (
  SELECT *, CASE WHEN s_acctbal < 2000 THEN 'ALARM' WHEN s_acctbal < 4000 THEN 'INSUFFICIENT_DATA' ELSE 'OK' END AS status,
         CASE WHEN s_nationkey >= 10 THEN 'arn:' || (s_suppkey // 2) END AS arn, s_nationkey % 3 AS box,
         'balance < ' || CAST(floor(s_acctbal) AS BIGINT) || ' A' AS reason,
         '2024-01-' || lpad(CAST(s_nationkey + 1 AS VARCHAR), 2, '0') AS day,
         CASE WHEN s_nationkey < 10 THEN 'true' WHEN s_nationkey < 20 THEN 'false' END AS enabled
  FROM supplier),
first AS (
  SELECT *, row_number() OVER (
           PARTITION BY coalesce(arn, box || s_name)
           ORDER BY CASE status WHEN 'ALARM' THEN 0 ELSE 1 END, s_suppkey // 50, box, s_suppkey) AS place
  FROM sup WHERE status <> 'OK')"""

_TRADE = """trade AS (
  SELECT s_nationkey AS seller, c_nationkey AS buyer, count(*) AS total,
         count(*) FILTER (l_returnflag = 'R') AS errors, count(*) FILTER (l_returnflag = 'A') AS faults,
         count(*) FILTER (l_linestatus = 'O') AS throttled, CAST(sum(l_quantity) AS BIGINT) AS quantity
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey
  GROUP BY ALL),
svc AS (
  SELECT n_nationkey AS id, n_name AS name, '{"AccountId":"00' || n_nationkey || '","Root":'
         || CASE WHEN n_regionkey = 0 THEN 'true' ELSE 'false' END || ',"State":"active","Names":["' || n_name
         || '"],"StartTime":1704067200}' AS attributes
  FROM nation WHERE n_nationkey < 24)"""

_SPLIT = f"CASE WHEN timestamp_ms < {EPOCH_2024 + 6 * DAY} THEN 'too_old' WHEN timestamp_ms > {EPOCH_2024 + 22 * DAY} THEN 'too_new' END"


def _escaped(text: str) -> str:
    return f"replace(replace(replace(url_encode({text}), '+', '%20'), '%7E', '~'), '*', '%2A')"


def _roll(where: str = "") -> str:
    bucket = f"timestamp_ms // {DAY} * {DAY}"
    return f"""WITH {MD},
rolled AS (SELECT namespace, metric_name, {SERIES} AS dimensions_key, {bucket} AS bucket_ms, round(sum(value), 9) AS sum,
       round(avg(value), 9) AS average, max(value) AS maximum, min(value) AS minimum,
       CAST(count(value) AS DOUBLE) AS sample_count
FROM md GROUP BY ALL)
SELECT * FROM rolled {where}"""


SQL: dict[str, str] = {
    "logs_scan": _otlp(f"WHERE log_group = '/app/error' AND timestamp_ms >= {NOW_MS - 30 * DAY} AND timestamp_ms < {NOW_MS}"),
    "max_rows": _otlp(
        f"WHERE log_group = '/app/error' AND contains(message, 'user=1') AND timestamp_ms >= {NOW_MS - 7 * DAY}"
        f" AND timestamp_ms < {NOW_MS}",
        "ORDER BY timestamp_ms DESC, event_id DESC LIMIT 100",
    ),
    "where_group": _events("WHERE log_group = '/app/click'"),
    "where_time": _events(f"WHERE timestamp_ms >= {EPOCH_2024 + 3 * DAY} AND timestamp_ms < {EPOCH_2024 + 20 * DAY}"),
    "where_pattern": _events("WHERE contains(message, 'user=12 props')"),
    "where_stream_prefix": _events("WHERE starts_with(log_stream, 'stream-3')"),
    "where_streams": _events("WHERE log_stream IN ('stream-1', 'stream-6', 'stream-9')"),
    "otlp_logs": _otlp(),
    "body_fields": f"""WITH {EV}
        SELECT message AS body, '{{"aws.cloudwatch.log.event_id":"' || event_id || '"}}' AS log_attributes,
               CAST(json_extract(regexp_extract(message, 'props=(.*)$', 1), '$.k') AS BIGINT) AS k FROM ev""",
    "order_events": _events("", "ORDER BY timestamp_ms DESC, event_id DESC"),
    "event_page": f"""WITH {EV}
        SELECT {_EV_COLUMNS}, (SELECT count(*) FROM ev) > 2000 AS has_more
        FROM ev ORDER BY timestamp_ms, event_id LIMIT 500 OFFSET 1500""",
    "event_page_deep": """WITH e AS (
          SELECT epoch_us(date_trunc('day', ts)) // 1000 AS timestamp_ms, lpad(CAST(user_id % 5 AS VARCHAR), 19, '0') AS event_id FROM events)
        SELECT timestamp_ms, event_id, (SELECT count(*) FROM e) > 800 AS has_more
        FROM e ORDER BY timestamp_ms, event_id LIMIT 200 OFFSET 600""",
    "event_page_after": f"""WITH {EV},
        rest AS (SELECT * FROM ev WHERE (timestamp_ms, event_id) < ({EPOCH_2024 + 10 * DAY}, '{"0" * 19}'))
        SELECT {_EV_COLUMNS}, (SELECT count(*) FROM rest) > 500 AS has_more
        FROM rest ORDER BY timestamp_ms DESC, event_id DESC LIMIT 500""",
    "event_positions": f"""WITH {EV}
        SELECT log_group, timestamp_ms, event_id,
               row_number() OVER (PARTITION BY log_group ORDER BY timestamp_ms, event_id) - 1 AS position FROM ev""",
    "union_logs": f"""WITH {EV}, {PUT}
        SELECT log_group, log_stream, timestamp_ms, message FROM ev
        UNION ALL SELECT log_group, log_stream, timestamp_ms, message FROM pe""",
    "logs_for_groups": _events("WHERE log_group IN ('/app/error', '/app/view', '/app/none')"),
    "dedup_groups": f"WITH {EV} SELECT log_group, min(CAST(event_id AS BIGINT)) AS position FROM ev GROUP BY ALL",
    "readback_concat": f"""WITH RECURSIVE {_log_plan()}
        SELECT log_group, log_stream, batch_no, string_agg(message, '|' ORDER BY index_in_batch) AS bodies
        FROM planned GROUP BY ALL""",
    "decode_log_pages": f"""WITH {EV}
        SELECT event_id AS request_id, 0 AS page_no, 0 AS pos, log_stream, timestamp_ms, ingestion_time_ms, event_id,
               message FROM ev
        UNION ALL SELECT event_id, 0, 1, '', -1, -1, '', log_group FROM ev WHERE log_group = '/app/view'""",
    "log_stats": f"""WITH {EV}
        SELECT log_group, strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%d') AS day, count(*) AS events,
               max(timestamp_ms) AS last_ms, count(DISTINCT log_stream) AS streams
        FROM ev WHERE contains(message, 'user=1') GROUP BY ALL""",
    "decode_group_pages": """SELECT s_nationkey AS page_no, 'p' || s_nationkey AS next_token, '/supplier/' || s_suppkey AS log_group
        FROM supplier WHERE s_suppkey % 3 <> 0""",
    "count_distinct_approx": "SELECT '/app/' || event_type AS log_group, true AS within FROM events GROUP BY 1",
    "count_distinct": """SELECT '/app/' || event_type AS log_group, count(DISTINCT user_id) AS users,
        count(DISTINCT user_id % 8) AS streams FROM events GROUP BY ALL""",
    "where_metric": f"""WITH {MD} SELECT namespace, metric_name, timestamp_ms, value, unit FROM md
        WHERE metric_name = 'view' AND timestamp_ms > {EPOCH_2024 + DAY} AND timestamp_ms <= {EPOCH_2024 + 25 * DAY}
              AND ns = 'ns-1' AND unit = 'Bytes'""",
    "period_bucket": f"""WITH {MD} SELECT metric_name, timestamp_ms, timestamp_ms // 300000 * 300000 AS bucket_ms,
        -(timestamp_ms // 60000) * 60000 AS negative_bucket_ms FROM md""",
    "metric_sum": _plain("round(sum(value), 9)"),
    "metric_avg": _plain("round(avg(value), 9)"),
    "metric_max": _plain("max(value)"),
    "metric_min": _plain("min(value)"),
    "metric_count": _plain("CAST(count(value) AS DOUBLE)"),
    "metric_percentile": _plain("round(quantile_cont(value, 0.9), 9)"),
    "metric_trimmed_mean": _bounded("round(avg(value) FILTER (value <= q90), 9)"),
    "metric_trimmed_count": _bounded("CAST(count(*) FILTER (value <= q90) AS DOUBLE)"),
    "metric_trimmed_sum": _bounded("round(sum(value) FILTER (value <= q90), 9)"),
    "metric_winsorized": _bounded("round(avg(least(value, q90)), 9)"),
    "metric_iqm": _bounded("round(avg(value) FILTER (value >= q25 AND value <= q75), 9)"),
    "metric_percentile_approx": f"WITH {MD} SELECT DISTINCT metric_name, {_BUCKET} AS bucket_ms, true AS within FROM md",
    "metric_rollup": _roll(),
    "metric_rollup_all": f"""WITH {MD},
b AS (SELECT namespace, metric_name, {SERIES} AS dimensions_key, timestamp_ms // {DAY} * {DAY} AS bucket_ms, value FROM md),
q AS (
  SELECT namespace, metric_name, dimensions_key, bucket_ms, quantile_cont(value, 0.9) AS q90, quantile_cont(value, 0.25) AS q25,
         quantile_cont(value, 0.75) AS q75
  FROM b GROUP BY ALL)
SELECT namespace, metric_name, dimensions_key, bucket_ms, round(sum(value), 9) AS sum, round(avg(value), 9) AS average,
       max(value) AS maximum, min(value) AS minimum, CAST(count(value) AS DOUBLE) AS sample_count, round(any_value(q90), 9) AS p90,
       round(avg(value) FILTER (value <= q90), 9) AS tm90, CAST(count(*) FILTER (value <= q90) AS DOUBLE) AS tc90,
       round(sum(value) FILTER (value <= q90), 9) AS ts90, round(avg(least(value, q90)), 9) AS wm90,
       round(avg(value) FILTER (value >= q25 AND value <= q75), 9) AS iqm
FROM b JOIN q USING (namespace, metric_name, dimensions_key, bucket_ms) GROUP BY ALL""",
    "metric_rollup_sketches": f"""WITH {MD} SELECT metric_name, timestamp_ms // {DAY} * {DAY} AS bucket_ms, round(sum(value), 9) AS sum,
       round(avg(value), 9) AS average, max(value) AS maximum, min(value) AS minimum, CAST(count(value) AS DOUBLE) AS sample_count,
       true AS p50_within, true AS p90_within, true AS p99_within, true AS distinct_within
FROM md GROUP BY ALL""",
    "metric_cardinality": f"WITH {MD} SELECT count(DISTINCT (namespace, metric_name, svc, ns)) AS series FROM md",
    "otlp_gauge": f"""WITH {MD}, b AS (
          SELECT timestamp_ms // 3600000 * 3600000 AS bucket_ms, max(value) AS value FROM md
          WHERE metric_name = 'purchase' AND ns = 'ns-2' AND timestamp_ms > {NOW_MS - 30 * DAY} AND timestamp_ms <= {NOW_MS}
          GROUP BY ALL)
        SELECT make_timestamp(bucket_ms * 1000) AS time_unix_nano, CAST(NULL AS TIMESTAMP) AS start_time_unix_nano,
               'purchase' AS name, CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS unit,
               CAST(NULL AS BIGINT) AS int_value, value AS double_value, CAST(NULL AS VARCHAR) AS service_name,
               'ns-2' AS service_namespace, CAST(NULL AS VARCHAR) AS service_instance_id,
               '{{"cloud.provider":"aws","cloud.region":"us-east-1"}}' AS resource_attributes,
               CAST(NULL AS VARCHAR) AS scope_name, CAST(NULL AS VARCHAR) AS scope_version,
               CAST(NULL AS VARCHAR) AS scope_attributes,
               '{{"namespace":"/app/metrics","statistic":"Maximum","period":3600,"query_id":"m1","label":"purchase",'
                 || '"status_code":"Complete","dimensions":{{"service.namespace":"ns-2"}}}}' AS metric_attributes,
               CAST(NULL AS INTEGER) AS flags, CAST(NULL AS VARCHAR) AS exemplars_json FROM b""",
    "metrics_scan": f"""WITH {MD}
        SELECT make_timestamp(timestamp_ms // {DAY} * {DAY} * 1000) AS time_unix_nano, 'error' AS name, 'Count' AS unit,
               round(quantile_cont(value, 0.5), 9) AS double_value
        FROM md WHERE metric_name = 'error' AND unit = 'Count' AND timestamp_ms > {NOW_MS - 30 * DAY}
             AND timestamp_ms <= {NOW_MS} GROUP BY ALL""",
    "metric_order": f"""WITH {MD} SELECT metric_name, timestamp_ms // 3600000 * 3600000 AS bucket_ms, max(value) AS value
        FROM md GROUP BY ALL ORDER BY bucket_ms DESC""",
    "decode_metric_pages": """SELECT event_id AS request_id, 0 AS page_no, 0 AS result_no, p.pos,
          make_timestamp((epoch_us(ts) // 1000000 + p.pos) * 1000000) AS time_unix_nano,
          CASE p.pos WHEN 0 THEN value ELSE CAST(user_id AS DOUBLE) END AS value, event_type AS label,
          'Complete' AS status_code, '' AS messages
        FROM events, (VALUES (0), (1)) p(pos)""",
    "tabulate_results": """SELECT event_id AS response_no,
          CASE WHEN event_type = 'error' THEN 'last one' ELSE 'svc-' || (user_id % 10) END AS service_name,
          CASE WHEN value >= 5 THEN CAST(value AS VARCHAR) END AS events,
          CASE WHEN event_type = 'click' THEN CAST(json_extract(props, '$.k') AS VARCHAR) END AS k,
          CASE WHEN event_type = 'view' THEN '' END AS empty FROM events""",
    "tabulate_wide": "SELECT event_id AS response_no, " + ", ".join(
        f"CASE WHEN ({k} - event_id * 7 % 400 + 400) % 400 < 20 THEN CAST(({k} - event_id * 7 % 400 + 400) % 400 AS VARCHAR) END AS f{k:03d}"
        for k in range(400)
    ) + " FROM events",
    "result_statistics": """SELECT event_id AS response_no, user_id AS records_matched,
        user_id + 100 AS records_scanned FROM events""",
    "accept_pages": f"""WITH {_TOKENS},
        ends AS (SELECT request_id, min(page_no) AS e FROM pg WHERE next_token IN ('', token_in) GROUP BY ALL)
        SELECT pg.* FROM pg LEFT JOIN ends USING (request_id) WHERE e IS NULL OR page_no <= e""",
    "accept_pages_seen": f"""WITH {_TOKENS},
        again AS (SELECT *, min(page_no) OVER (PARTITION BY request_id, next_token) AS first_page FROM pg),
        ends AS (SELECT request_id, min(page_no) AS e FROM again WHERE next_token = '' OR page_no > first_page GROUP BY ALL)
        SELECT pg.* FROM pg LEFT JOIN ends USING (request_id) WHERE e IS NULL OR page_no <= e""",
    "order_pages": """WITH RECURSIVE numbered(request_id, n, after) AS (
  SELECT 'event/' || (event_id % 5), event_id // 5, event_id // 5 + 1 FROM events
  UNION ALL SELECT 'customer/' || (c_custkey % 50), c_custkey // 50,
    CASE WHEN c_custkey // 50 = 2 AND c_custkey % 2 = 0 THEN 1 ELSE c_custkey // 50 + 1 END FROM customer
  UNION ALL SELECT 'order/' || o_orderkey, n, (n + 1) % 3 FROM orders, range(3) r(n) WHERE n <> 1 OR o_orderkey % 3 <> 0
  UNION ALL SELECT 'supplier/' || s_suppkey, 0, CASE WHEN s_suppkey % 2 = 0 THEN 0 ELSE 7 END FROM supplier
  UNION ALL SELECT 'supplier/' || s_suppkey, 8, 8 FROM supplier),
p AS (
  SELECT request_id, split_part(request_id, '/', 1) AS kind, n, after, count(*) OVER (PARTITION BY request_id) AS pages
  FROM numbered),
walk AS (
  SELECT *, CAST(0 AS BIGINT) AS page_no FROM p WHERE n = 0
  UNION ALL
  SELECT p.*, w.page_no + 1 FROM walk w JOIN p ON p.request_id = w.request_id AND p.n = w.after
  WHERE w.after > 0 AND w.after <> w.n AND w.page_no + 1 < w.pages)
SELECT request_id, CASE WHEN n > 0 THEN kind || '-' || n ELSE '' END AS token_in,
  CASE WHEN after > 0 THEN kind || '-' || after ELSE '' END AS next_token, min(page_no) AS page_no
FROM walk GROUP BY ALL""",
    "open_alarms": f"""WITH {_ALARMS}
        SELECT arn AS alarm_arn, s_name AS alarm_name,
               CASE box WHEN 0 THEN 'MetricAlarm' WHEN 1 THEN 'CompositeAlarm' ELSE 'LogAlarm' END AS alarm_type, status,
               CAST(NULL AS TIMESTAMP) AS state_transitioned_at,
               CAST(day || ' 01:02:03.456' AS TIMESTAMP) AS state_updated_at, CAST(NULL AS VARCHAR) AS description,
               reason, CAST(NULL AS VARCHAR) AS reason_data, CAST(enabled AS BOOLEAN) AS actions_enabled,
               '["act-' || s_nationkey || '"]' AS alarm_actions, CAST(NULL AS VARCHAR) AS namespace,
               CAST(NULL AS VARCHAR) AS metric_name,
               CASE WHEN s_nationkey < 5 THEN NULL WHEN s_nationkey < 8 THEN '{{}}'
                    ELSE '{{"nation":"n&' || s_nationkey || '","kind":"supplier"}}' END AS dimensions,
               '{{' || CASE WHEN enabled IS NULL THEN '' ELSE '"ActionsEnabled":"' || enabled || '",' END
                 || '"AlarmActions":{{"member":["act-' || s_nationkey || '",""]}},'
                 || CASE WHEN arn IS NULL THEN '' ELSE '"AlarmArn":"' || arn || '",' END
                 || '"AlarmName":"' || s_name || '",'
                 || CASE WHEN s_nationkey < 5 THEN '' WHEN s_nationkey < 8 THEN '"Dimensions":"",'
                    ELSE '"Dimensions":{{"member":[{{"Name":"nation","Value":"n&' || s_nationkey
                         || '"}},{{"Name":"kind","Value":"supplier"}}]}},' END
                 || '"StateReason":"' || reason || '","StateUpdatedTimestamp":"' || day
                 || 'T01:02:03.456Z","StateValue":"' || status || '"}}' AS configuration
        FROM first WHERE place = 1""",
    "service_dependencies": f"""WITH {_TRADE}
        SELECT 'cloudwatch' AS provider, s.name AS source_service,
               coalesce(t.name, 'alias ' || n.n_name) AS target_service, 'nation' AS source_type,
               CASE WHEN t.id IS NULL THEN 'external' ELSE 'nation' END AS target_type,
               CASE n.n_regionkey WHEN 0 THEN 'queue' WHEN 1 THEN 'stream' ELSE 'synchronous' END AS edge_type,
               CAST(NULL AS VARCHAR) AS environment, TIMESTAMP '2024-01-01' AS window_start,
               TIMESTAMP '2024-01-31' AS window_end,
               CASE WHEN seller <> buyer THEN total END AS request_count,
               CASE WHEN seller <> buyer THEN errors END AS error_count,
               CASE WHEN seller <> buyer THEN faults END AS fault_count,
               CASE WHEN seller <> buyer THEN throttled + 1 END AS throttle_count,
               CASE WHEN seller <> buyer THEN CAST(quantity AS DOUBLE) END AS total_response_time_seconds,
               s.attributes AS source_attributes, t.attributes AS target_attributes,
               CASE WHEN buyer >= 20 THEN '{{"Aliases":[{{"Name":"alias ' || n.n_name || '","Type":"external"}}]}}' END
                 AS edge_attributes
        FROM trade JOIN svc s ON s.id = seller JOIN nation n ON n.n_nationkey = buyer LEFT JOIN svc t ON t.id = buyer""",
    "attach": _attached_logs(),
    "describe_groups": f"""WITH {EV}, {REG} SELECT log_group, retention_in_days, created_ms FROM reg
        WHERE log_stream IS NULL AND starts_with(log_group, '/crm/') ORDER BY log_group""",
    "describe_streams": f"""WITH {EV}, {REG}, n AS (
          SELECT log_stream, CAST(NULL AS BIGINT) AS f, CAST(NULL AS BIGINT) AS l FROM reg
          WHERE log_group = '/app/signup' AND log_stream IS NOT NULL
          UNION ALL SELECT log_stream, min(timestamp_ms), max(timestamp_ms) FROM ev WHERE log_group = '/app/signup' GROUP BY ALL)
        SELECT log_stream, min(f) AS first_ms, max(l) AS last_ms FROM n GROUP BY ALL ORDER BY log_stream""",
    "stream_bounds": f"""WITH {EV} SELECT log_group, log_stream, min(timestamp_ms) AS first_ms,
        max(timestamp_ms) AS last_ms FROM ev GROUP BY ALL""",
    "known_destination": f"WITH {_DESTINATIONS} SELECT e.*, {_PROBLEM} FROM ev e",
    "absent_names": f"""WITH {EV}, {REG}, {GROUP_NAMES}, have AS (SELECT DISTINCT log_group FROM reg WHERE log_stream IS NULL)
        SELECT seq, i.log_group, h.log_group IS NULL AS is_absent FROM inv i LEFT JOIN have h ON h.log_group = i.log_group""",
    "create_groups": f"WITH {_GROUP_OUTCOMES} SELECT seq, log_group, {_CREATED.format(name='log_group')} AS outcome FROM judged",
    "create_groups_registry": f"""WITH {_GROUP_OUTCOMES} SELECT * FROM reg
        UNION ALL SELECT log_group, NULL, NULL, {NOW_MS} FROM judged
        WHERE log_group IS NOT NULL AND NOT known AND first_row""",
    "create_streams": f"""WITH {_STREAM_OUTCOMES}
        SELECT seq, log_group, log_stream, {_CREATED.format(name='log_group || log_stream')} AS outcome FROM judged""",
    "create_streams_registry": f"""WITH {_STREAM_OUTCOMES} SELECT * FROM reg
        UNION ALL SELECT log_group, log_stream, NULL, {NOW_MS} FROM judged
        WHERE log_group IS NOT NULL AND log_stream IS NOT NULL AND NOT known AND first_row""",
    "put_retention": f"""WITH {EV}, {REG}, {SETTINGS},
        last AS (SELECT log_group, max_by(retention_in_days, seq) AS days FROM st WHERE log_group IS NOT NULL GROUP BY ALL)
        SELECT log_group, log_stream,
               CASE WHEN log_stream IS NULL THEN coalesce(days, retention_in_days) ELSE retention_in_days END
                 AS retention_in_days, created_ms
        FROM reg LEFT JOIN last USING (log_group)""",
    "put_retention_outcomes": f"""WITH {SETTINGS}
        SELECT seq, log_group, retention_in_days, CASE WHEN log_group IS NOT NULL THEN 'ok' END AS outcome FROM st""",
    "delete_groups": f"WITH {_GROUP_OUTCOMES} SELECT seq, log_group, {_DELETED} AS outcome FROM judged",
    "delete_groups_registry": f"""WITH {_GROUP_OUTCOMES} SELECT * FROM reg
        WHERE log_group NOT IN (SELECT log_group FROM judged WHERE log_group IS NOT NULL AND known)""",
    "delete_groups_events": f"""WITH {_GROUP_OUTCOMES} SELECT * FROM ev
        WHERE log_group NOT IN (SELECT log_group FROM judged WHERE log_group IS NOT NULL AND known)""",
    "auto_create": f"""WITH {_DESTINATIONS} SELECT * FROM reg
        UNION ALL SELECT log_group, NULL, NULL, min(ingestion_time_ms) FROM ev
        WHERE log_group NOT IN (SELECT log_group FROM grp) GROUP BY log_group
        UNION ALL SELECT log_group, log_stream, NULL, min(ingestion_time_ms) FROM ev
        WHERE (log_group, log_stream) NOT IN (SELECT (log_group, log_stream) FROM str) GROUP BY log_group, log_stream""",
    "parse_time": f"""WITH t AS (SELECT event_id, CASE event_type
            WHEN 'view' THEN '-' || user_id || 'm' WHEN 'click' THEN ' -' || user_id || 'W '
            WHEN 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+02:00'
            WHEN 'signup' THEN CAST(event_id AS VARCHAR) ELSE props END AS text,
          CASE event_type WHEN 'view' THEN {NOW_MS} - user_id * 60000
            WHEN 'click' THEN CASE WHEN {NOW_MS} >= user_id * 604800000 THEN {NOW_MS} - user_id * 604800000 END
            WHEN 'error' THEN epoch_us(ts) // 1000 - 7200000 WHEN 'signup' THEN event_id END AS ms
          FROM events)
        SELECT event_id, text, ms,
               CASE WHEN ms IS NULL THEN 'invalid start_time value ''' || text || '''' END AS problem FROM t""",
    "event_time": f"""SELECT event_id, CASE WHEN event_type <> 'view' THEN epoch_us(ts) // 1000
        WHEN value > 5 THEN epoch_us(ts) // 1000 ELSE {NOW_MS} END AS ms FROM events""",
    "metric_time": f"""SELECT event_id, CASE WHEN value > 5 THEN epoch_us(ts) // 1000000 ELSE {NOW_MS // 1000} END AS seconds
        FROM events""",
    "iso_time": f"""WITH {EV} SELECT event_id,
        strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%dT%H:%M:%SZ') AS iso, timestamp_ms // 1000 * 1000 AS ms FROM ev""",
    "ms_to_time": f"""WITH {EV} SELECT event_id,
        CASE WHEN log_group <> '/app/view' THEN make_timestamp(timestamp_ms * 1000) END AS stamp FROM ev""",
    "translate_unit": f"WITH {GAUGE} SELECT seq, unit, {TRANSLATED} AS translated FROM gauge",
    "metric_dimensions": f"""WITH {GAUGE} SELECT seq, '[{{"name":"service.name","value":"' || service
        || '"}},{{"name":"zone","value":"' || zone || '"}},{{"name":"host","value":"' || host || '"}}]' AS dimensions FROM gauge""",
    "dimension_value": f"""WITH {MD} SELECT timestamp_ms, svc AS service, CAST(NULL AS VARCHAR) AS instance,
        {SERIES} AS dimensions_key FROM md""",
    "event_ids": """SELECT doc_id, lpad(CAST(doc_id + 12345678900000 AS VARCHAR), 19, '0') || lpad(CAST(n_chars + 1000000 AS VARCHAR), 10, '0')
        AS event_id FROM documents""",
    "check_names": r"""SELECT doc_id,
          CASE WHEN text = '' THEN 'the log group is missing or empty'
               WHEN octet_length(encode(text)) > 512 THEN 'the log group has over 512 bytes'
               WHEN NOT regexp_full_match(text, '[A-Za-z0-9._/#-]+') THEN 'the log group has a character other than letters, digits and . _ / # -' END
            AS group_problem,
          CASE WHEN text = '' THEN 'the log stream is missing or empty'
               WHEN octet_length(encode(text)) > 512 THEN 'the log stream has over 512 bytes'
               WHEN contains(text, ':') OR contains(text, '*') THEN 'the log stream has a colon or an asterisk' END
            AS stream_problem,
          CASE WHEN lang = 'de' THEN 'the namespace begins with AWS/, which is taken' END AS namespace_problem
        FROM documents""",
    "check_retention": f"""SELECT c_custkey, CASE WHEN c_custkey NOT IN ({_DAYS})
        THEN 'the retention is none of the settings that can be stored' END AS problem FROM customer""",
    "check_message": """SELECT doc_id, CASE WHEN lang = 'es' OR text = '' THEN 'the message is missing or empty'
        WHEN octet_length(encode(text)) * CASE WHEN lang = 'fr' THEN 600 ELSE 1 END > 1048576 - 26
        THEN 'the message does not fit into a batch' END AS problem FROM documents""",
    "validate_put": """SELECT doc_id AS seq, CASE WHEN lang = 'es' THEN 'the message is missing or empty'
        WHEN lang = 'de' AND doc_id % 10 = 0 THEN 'the message does not fit into a batch' END AS problem FROM documents""",
    "plan_valid_batches": """SELECT lang AS log_group, count(*) AS events FROM documents
        WHERE lang IS DISTINCT FROM 'es' AND NOT (lang IS NOT DISTINCT FROM 'de' AND doc_id % 10 = 0) GROUP BY lang""",
    "check_metric": """SELECT event_id, CASE WHEN event_type = 'signup' THEN 'the metric has no name'
        WHEN value > 20 THEN 'the attributes can''t be read as JSON'
        WHEN user_id % 40 + 1 > 30 THEN 'the metric has over 30 dimensions'
        WHEN event_type = 'view' THEN 'the value is infinite or not a number' END AS problem FROM events""",
    "check_metric_age": f"WITH {MD} SELECT metric_name, timestamp_ms, CASE WHEN timestamp_ms < {EPOCH_2024 + 6 * DAY} THEN 'too_old' WHEN timestamp_ms > {EPOCH_2024 + 20 * DAY + 7_200_000} THEN 'too_new' END AS verdict FROM md",
    "to_put_events": f"WITH {PUT} SELECT * FROM pe",
    "plan_log_batches": f"""WITH RECURSIVE {_log_plan()}
        SELECT seq, log_group, log_stream, timestamp_ms, batch_no, index_in_batch FROM planned""",
    "plan_log_batches_by_size": f"""WITH RECURSIVE {_log_plan(100, 40_000, 10**12)}
        SELECT seq, log_group, log_stream, timestamp_ms, batch_no, index_in_batch FROM planned""",
    "to_metric_data": f"""WITH {GAUGE}, {DATA} SELECT seq, namespace, metric_name, timestamp_seconds, value, unit,
        '[{{"name":"service.name","value":"' || service || '"}},{{"name":"zone","value":"' || zone
        || '"}},{{"name":"host","value":"' || host || '"}}]' AS dimensions FROM dt""",
    "datum_bytes": f"WITH {GAUGE}, {DATA} SELECT seq, bytes FROM sized",
    "plan_metric_batches": f"""WITH RECURSIVE {_metric_plan()}
        SELECT seq, namespace, metric_name, timestamp_seconds, value, unit, batch_no, index_in_batch FROM planned""",
    "plan_metric_batches_by_size": f"""WITH RECURSIVE {_metric_plan(60, 30_000)}
        SELECT seq, namespace, metric_name, timestamp_seconds, value, unit, batch_no, index_in_batch FROM planned""",
    "encode_metric_batches": f"""WITH RECURSIVE {_metric_plan()},
        parts AS (SELECT *, 'MetricData.member.' || (index_in_batch + 1) AS m FROM planned)
        SELECT namespace, metric_name, batch_no, count(*) AS data,
          'Action=PutMetricData&Version=2010-08-01&Namespace=%2Fapp%2Fmetrics&' || string_agg(
            m || '.MetricName=' || metric_name || '&' || m || '.Timestamp='
            || replace(strftime(make_timestamp(timestamp_seconds * 1000000), '%Y-%m-%dT%H:%M:%SZ'), ':', '%3A')
            || '&' || m || '.Value=' || regexp_replace(CAST(value AS VARCHAR), '\\.0$', '') || '&' || m || '.Unit=' || unit
            || '&' || m || '.Dimensions.member.1.Name=service.name&' || m || '.Dimensions.member.1.Value=' || {_escaped('service')}
            || '&' || m || '.Dimensions.member.2.Name=zone&' || m || '.Dimensions.member.2.Value=' || {_escaped('zone')}
            || '&' || m || '.Dimensions.member.3.Name=host&' || m || '.Dimensions.member.3.Value=' || {_escaped('host')},
            '&' ORDER BY index_in_batch) AS body
        FROM parts GROUP BY ALL""",
    "reconcile_put": f"WITH RECURSIVE {_RECONCILED} SELECT * FROM outcome",
    "put_status": f"""WITH RECURSIVE {_RECONCILED}
        SELECT d.doc_id AS seq, d.lang, o.status FROM documents d LEFT JOIN outcome o ON o.seq = d.doc_id""",
    "split_late_accepted": _events(f"WHERE {_SPLIT} IS NULL"),
    "split_late": f"WITH {EV} SELECT {_EV_COLUMNS}, {_SPLIT} AS verdict FROM ev WHERE {_SPLIT} IS NOT NULL",
    "decode_put_log_bodies": f"WITH {_LOG_BODIES} SELECT * FROM received",
    "decode_put_log_dead_letters": f"WITH {_LOG_BODIES} SELECT doc_id AS body_seq, reason FROM bodies WHERE reason IS NOT NULL",
    "decode_put_metric_bodies": _METRIC_BODIES,
    "decode_put_metric_dead_letters": """SELECT event_id AS body_seq, CASE event_type
        WHEN 'view' THEN 'the body has an invalid escape' WHEN 'purchase' THEN 'the body names no namespace'
        ELSE 'a data point has no value' END AS reason
        FROM events WHERE event_type IN ('view', 'purchase', 'error')""",
    "metric_round_trip": f"""WITH {GAUGE}, {DATA} SELECT namespace, metric_name, timestamp_seconds * 1000 AS timestamp_ms,
        value, unit, '{{"host":"' || host || '","service.name":"' || service || '","zone":"' || zone || '"}}' AS dimensions
        FROM dt""",
    "append_events": f"""WITH {EV} SELECT {_EV_COLUMNS},
        strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%d') AS event_date FROM ev""",
    "append_metrics": f"""WITH {MD} SELECT namespace, metric_name, timestamp_ms, value, unit, {SERIES} AS dimensions,
        strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%d') AS event_date FROM md""",
    "stream_ingest_logs": f"WITH {_DESTINATIONS}, {_LOG_BODIES} SELECT e.*, {_PROBLEM} FROM received e",
    "stream_ingest_metrics": _METRIC_BODIES,
    # No point is late, so every period comes out, those still open at the end of the input too.
    "stream_metric_rollup": _roll(""),
}
SQL["decode_metric_pages_xml"] = SQL["decode_metric_pages"]
SQL["attach_alarms"] = SQL["open_alarms"]
SQL["attach_edges"] = SQL["service_dependencies"].replace("TIMESTAMP '2024-01-01'", "TIMESTAMP '2024-01-01 00:00:00'")
SQL["read_logs_function"] = _otlp(
    f"WHERE log_group = '/app/error' AND contains(message, 'user=1') AND log_stream IN ('stream-1', 'stream-3') AND timestamp_ms >= {NOW_MS - 20 * DAY} AND timestamp_ms < {NOW_MS}"
)
SQL["read_metrics_function"] = f"""WITH {MD} SELECT make_timestamp(timestamp_ms // 3600000 * 3600000 * 1000) AS time_unix_nano, metric_name AS name,
    'Bytes' AS unit, max(value) AS double_value FROM md WHERE metric_name = 'purchase' AND unit = 'Bytes' AND timestamp_ms > {NOW_MS - 25 * DAY} GROUP BY ALL"""
SQL["read_dependencies_function"] = SQL["service_dependencies"]
SQL["delete_stored_groups"] = f"""WITH {_GROUP_OUTCOMES} SELECT *, strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%d') AS event_date FROM ev
    WHERE log_group NOT IN (SELECT log_group FROM judged WHERE log_group IS NOT NULL AND known)"""
SQL["stream_ingest_created"] = f"""WITH {_DESTINATIONS}, {_LOG_BODIES} SELECT * FROM reg
    UNION ALL SELECT log_group, NULL, NULL, min(ingestion_time_ms) FROM received
    WHERE log_group NOT IN (SELECT log_group FROM grp) GROUP BY log_group
    UNION ALL SELECT log_group, log_stream, NULL, min(ingestion_time_ms) FROM received
    WHERE (log_group, log_stream) NOT IN (SELECT (log_group, log_stream) FROM str) GROUP BY log_group, log_stream"""
SQL["stream_ingest_kept"] = f"WITH {_LOG_BODIES} SELECT * FROM received"
SQL["stream_ingest_redelivered"] = SQL["stream_ingest_logs"]
SQL["stream_log_batches"] = SQL["plan_log_batches"]
SQL["stream_closed_batches"] = f"""WITH RECURSIVE {_log_plan()},
    ends AS (
      SELECT log_group, log_stream, batch_no, count(*) AS events, CAST(sum(octet_length(encode(message)) + 26) AS BIGINT) AS bytes,
             min(timestamp_ms) AS first_ms, max(timestamp_ms) AS last_ms FROM planned GROUP BY ALL),
    next AS (SELECT log_group, batch_no - 1 AS batch_no, octet_length(encode(message)) + 26 AS more FROM planned WHERE index_in_batch = 0)
    SELECT e.*, CASE WHEN events >= 10000 THEN 'events' WHEN bytes + more > 1048576 THEN 'bytes' ELSE 'span' END AS closed_by
    FROM ends e JOIN next USING (log_group, batch_no)"""
SQL["stream_put_outcomes"] = SQL["reconcile_put"]

# Log request bodies as JSON text.
SQL["encode_log_batches"] = f"""WITH RECURSIVE {_log_plan()}
    SELECT log_group, log_stream, batch_no, CAST(count(*) AS INTEGER) AS events,
           '{{"logGroupName":"' || log_group || '","logStreamName":"' || log_stream || '","logEvents":['
             || string_agg('{{"timestamp":' || timestamp_ms || ',"message":' || CAST(to_json(message) AS VARCHAR) || '}}',
                           ',' ORDER BY index_in_batch) || ']}}' AS body
    FROM planned GROUP BY log_group, log_stream, batch_no"""
SQL["write_batches"] = SQL["encode_log_batches"]

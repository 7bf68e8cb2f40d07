"""Landed tables as SQL table functions with named arguments.

    SELECT body FROM read_logs(log_group => '/app/error', filter => 'timeout', start_time => '-2h')

A function is a query over a view of the landed table, which Spark puts in the caller's place. Its arguments then are
constants like any other, so that predicates reach the scan, and no name of a log group is ever listed: one function
serves any number of groups.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconlake import schemas
from beaconlake.functions.times import UNIT_MS
from beaconlake.sources.graph import service_dependencies
from beaconlake.sources.logs import MAX_STREAMS, as_columns, otlp_log_columns

_EVENTS, _POINTS, _EDGES = "landed_log_events", "landed_metric_points", "landed_service_edges"
_DAY = 86_400_000
_MOMENT = "a time has to be now, -15m, -2h or the like, epoch milliseconds or an ISO-8601 text"


def _function(spark: SparkSession, signature: str, returns: str, body: str) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {returns} RETURN {body}")


def _columns(schema) -> str:
    return "TABLE(" + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields) + ")"


def _times(spark: SparkSession, now: int | None) -> None:
    """`landed_ms(text)`: epoch milliseconds by the rules of `parse_time`; another text raises."""
    moment = "unix_millis(current_timestamp())" if now is None else f"{now}L"
    units = " ".join(f"WHEN '{unit}' THEN {ms}L" for unit, ms in UNIT_MS.items())
    word = "lower(trim(moment))"
    back = f"{moment} - CAST(substring({word}, 2, length({word}) - 2) AS BIGINT) * CASE right({word}, 1) {units} END"
    iso = "unix_millis(try_cast(trim(moment) AS TIMESTAMP))"
    _function(
        spark, "landed_ms(moment STRING)", "BIGINT",
        f"""coalesce(CASE WHEN {word} = 'now' THEN {moment}
          WHEN {word} RLIKE '^-[0-9]{{1,9}}[{''.join(UNIT_MS)}]$' THEN CASE WHEN {back} >= 0 THEN {back} END
          WHEN {word} RLIKE '^[0-9]{{1,18}}$' THEN try_cast({word} AS BIGINT)
          WHEN {word} RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}' THEN CASE WHEN {iso} >= 0 THEN {iso} END END,
          CAST(raise_error('{_MOMENT.replace("'", "''")}') AS BIGINT))""",
    )


def _pattern(spark: SparkSession) -> None:
    """`landed_phrase(pattern)`: the substring that a filter pattern stands for, as `pattern_text` has it."""
    text = "trim(pattern)"
    _function(
        spark, "landed_phrase(pattern STRING)", "STRING",
        f"""CASE WHEN left({text}, 1) IN ('{{', '[') THEN raise_error('a filter pattern has to be a term or a quoted phrase')
          WHEN length({text}) >= 2 AND left({text}, 1) = '"' AND right({text}, 1) = '"' THEN substring({text}, 2, length({text}) - 2)
          WHEN {text} LIKE '% %' OR {text} LIKE '%?%' THEN raise_error('a filter pattern has to be a single term or a quoted phrase')
          ELSE {text} END""",
    )


def _guarded(schema, query: str, *rules: tuple[str, str], read: tuple[str, ...] = ()) -> str:
    """`query`, and no row of a second part that raises where a rule's condition holds or a text of `read` can't be read.

    With good arguments the second part is false before anything runs, and Spark leaves it out.
    """
    cases = " ".join(f"WHEN {condition} THEN CAST(raise_error('{reason}') AS BOOLEAN)" for condition, reason in rules)
    unread = " ".join(f"WHEN {text} IS NULL THEN true" for text in read)
    nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()})" for f in schema.fields)
    return f"{query} UNION ALL SELECT {nothing} WHERE CASE {unread} {cases} ELSE false END"


def read_logs(spark: SparkSession, events: DataFrame, region: str = "") -> None:
    """Registers `read_logs(log_group, filter, start_time, end_time, log_stream_prefix, log_streams)`."""
    schemas.require(events, schemas.RAW_EVENTS, "log events")
    dated = "event_date" in events.columns
    raw = [F.col(c).alias(f"raw_{c}") for c in ("log_group", "log_stream", "timestamp_ms", "message", *(["event_date"] if dated else []))]
    events.select(*as_columns(schemas.OTLP_LOGS, otlp_log_columns(region)), *raw).createOrReplaceTempView(_EVENTS)
    low, high = "landed_ms(read_logs.start_time)", "landed_ms(read_logs.end_time)"
    days = f"AND raw_event_date >= date_from_unix_date(CAST({low} DIV {_DAY} AS INT)) AND raw_event_date <= date_from_unix_date(CAST({high} DIV {_DAY} AS INT))"
    _function(
        spark,
        "read_logs(log_group STRING, filter STRING DEFAULT '', start_time STRING DEFAULT '-15m', end_time STRING DEFAULT 'now', "
        "log_stream_prefix STRING DEFAULT '', log_streams ARRAY<STRING> DEFAULT array())",
        _columns(schemas.OTLP_LOGS),
        _guarded(
            schemas.OTLP_LOGS,
            f"""SELECT {', '.join(schemas.OTLP_LOGS.names)} FROM {_EVENTS}
              WHERE raw_log_group = read_logs.log_group AND raw_timestamp_ms >= {low} AND raw_timestamp_ms < {high} {days if dated else ''}
                AND (landed_phrase(read_logs.filter) = '' OR contains(raw_message, landed_phrase(read_logs.filter)))
                AND (read_logs.log_stream_prefix = '' OR startswith(raw_log_stream, read_logs.log_stream_prefix))
                AND (size(read_logs.log_streams) = 0 OR array_contains(read_logs.log_streams, raw_log_stream))""",
            ("read_logs.log_group = ''", "name a log group"),
            (f"{low} > {high}", "the start lies after the end"),
            (f"size(read_logs.log_streams) > {MAX_STREAMS}", f"over {MAX_STREAMS} streams are listed"),
            ("read_logs.log_stream_prefix <> '' AND size(read_logs.log_streams) > 0", "give a stream prefix or a list of streams, not both"),
            read=(low, high, "landed_phrase(read_logs.filter)"),
        ),
    )


_POINTS_READ = T.StructType().add("time_unix_nano", "timestamp_ntz").add("name", "string").add("unit", "string").add("double_value", "double")


def read_metrics(spark: SparkSession, points: DataFrame) -> None:
    """Registers `read_metrics(namespace, metric_name, statistic, period, start_time, end_time, unit)` for the plain
    statistics: time, name, unit and value of each period."""
    schemas.require(points, schemas.RAW_METRICS, "metric data").createOrReplaceTempView(_POINTS)
    low, high = (f"landed_ms(read_metrics.{side}) DIV 1000 * 1000" for side in ("start_time", "end_time"))
    chosen = {"Sum": "total", "Average": "mean", "Maximum": "most", "Minimum": "least", "SampleCount": "n"}
    cases = " ".join(f"WHEN '{name}' THEN {column}" for name, column in chosen.items())
    names = ", ".join(f"'{name}'" for name in chosen)
    period = "greatest(read_metrics.period, 1) * 1000L"
    _function(
        spark,
        "read_metrics(namespace STRING, metric_name STRING, statistic STRING DEFAULT 'Average', period INT DEFAULT 300, "
        "start_time STRING DEFAULT '-1h', end_time STRING DEFAULT 'now', unit STRING DEFAULT '')",
        _columns(_POINTS_READ),
        _guarded(
            _POINTS_READ,
            f"""SELECT CAST(timestamp_millis(bucket_ms) AS TIMESTAMP_NTZ), read_metrics.metric_name, nullif(read_metrics.unit, ''),
                CASE read_metrics.statistic {cases} END
              FROM (SELECT p.timestamp_ms DIV ({period}) * ({period}) AS bucket_ms, sum(p.value) AS total, avg(p.value) AS mean,
                  max(p.value) AS most, min(p.value) AS least, CAST(count(p.value) AS DOUBLE) AS n
                FROM {_POINTS} p
                WHERE p.namespace = read_metrics.namespace AND p.metric_name = read_metrics.metric_name AND p.timestamp_ms > {low}
                  AND p.timestamp_ms <= {high} AND (read_metrics.unit = '' OR p.unit = read_metrics.unit)
                GROUP BY 1)""",
            ("read_metrics.namespace = '' OR read_metrics.metric_name = ''", "name a namespace and a metric"),
            (f"read_metrics.statistic NOT IN ({names})", f"the statistic has to be one of {', '.join(chosen)}"),
            ("read_metrics.period <= 0", "the period has to be positive"),
            (f"{low} >= {high}", "the start does not lie before the end"),
            read=(low, high),
        ),
    )


def read_service_dependencies(spark: SparkSession, pages: DataFrame) -> None:
    """Registers `read_service_dependencies(start_time, end_time)`; its pages are parsed when it is registered."""
    service_dependencies(pages, 0, 1).createOrReplaceTempView(_EDGES)
    low, high = ("landed_ms(read_service_dependencies.start_time)", "landed_ms(read_service_dependencies.end_time)")
    stamp = {name: f"CAST(timestamp_millis({side}) AS TIMESTAMP_NTZ)" for name, side in (("window_start", low), ("window_end", high))}
    _function(
        spark,
        "read_service_dependencies(start_time STRING DEFAULT '-1h', end_time STRING DEFAULT 'now')",
        _columns(schemas.SERVICE_EDGES),
        _guarded(
            schemas.SERVICE_EDGES, f"SELECT {', '.join(stamp.get(n, n) for n in schemas.SERVICE_EDGES.names)} FROM {_EDGES}",
            (f"{low} >= {high}", "the start does not lie before the end"), read=(low, high),
        ),
    )


def register(spark: SparkSession, paths: Mapping[str, str], region: str = "", now: int | None = None) -> list[str]:
    """Registers a function for each landed table of `paths` (`events`, `metrics`, `graph`; any may be missing).

    Gives their names. Relative times count from `now`, by default the moment of each query. The order of rows and how
    many of them are wanted is for the query to say, which Spark then pushes into the scan.
    """
    other = [name for name in paths if name not in ("events", "metrics", "graph")]
    if other:
        raise ValueError(f"unknown path {other[0]}")
    _times(spark, now)
    _pattern(spark)
    made = []
    for name, path in paths.items():
        table = spark.read.parquet(path)
        if name == "events":
            read_logs(spark, table, region)
        elif name == "metrics":
            read_metrics(spark, table)
        else:
            read_service_dependencies(spark, table)
        made.append({"events": "read_logs", "metrics": "read_metrics", "graph": "read_service_dependencies"}[name])
    return made

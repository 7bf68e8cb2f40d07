"""Fixed relation schemas and the check every reader applies to its input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_S, _I, _L, _D, _B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
_TS = T.TimestampNTZType()


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


# Column names and types of the OpenTelemetry-shaped result relations.
OTLP_LOGS = _struct(
    ("time_unix_nano", _TS),
    ("observed_time_unix_nano", _TS),
    ("trace_id", _S),
    ("span_id", _S),
    ("service_name", _S),
    ("service_namespace", _S),
    ("service_instance_id", _S),
    ("severity_number", _I),
    ("severity_text", _S),
    ("event_name", _S),
    ("body", _S),
    ("resource_attributes", _S),
    ("scope_name", _S),
    ("scope_version", _S),
    ("scope_attributes", _S),
    ("log_attributes", _S),
    ("dropped_attributes_count", _I),
    ("flags", _I),
)

OTLP_GAUGE = _struct(
    ("time_unix_nano", _TS),
    ("start_time_unix_nano", _TS),
    ("name", _S),
    ("description", _S),
    ("unit", _S),
    ("int_value", _L),
    ("double_value", _D),
    ("service_name", _S),
    ("service_namespace", _S),
    ("service_instance_id", _S),
    ("resource_attributes", _S),
    ("scope_name", _S),
    ("scope_version", _S),
    ("scope_attributes", _S),
    ("metric_attributes", _S),
    ("flags", _I),
    ("exemplars_json", _S),
)

OPEN_ALARMS = _struct(
    ("alarm_arn", _S),
    ("alarm_name", _S),
    ("alarm_type", _S),
    ("status", _S),
    ("state_transitioned_at", _TS),
    ("state_updated_at", _TS),
    ("description", _S),
    ("reason", _S),
    ("reason_data", _S),
    ("actions_enabled", _B),
    ("alarm_actions", T.ArrayType(_S)),
    ("namespace", _S),
    ("metric_name", _S),
    ("dimensions", _S),
    ("configuration", _S),
)

SERVICE_EDGES = _struct(
    ("provider", _S),
    ("source_service", _S),
    ("target_service", _S),
    ("source_type", _S),
    ("target_type", _S),
    ("edge_type", _S),
    ("environment", _S),
    ("window_start", _TS),
    ("window_end", _TS),
    ("request_count", _L),
    ("error_count", _L),
    ("fault_count", _L),
    ("throttle_count", _L),
    ("total_response_time_seconds", _D),
    ("source_attributes", _S),
    ("target_attributes", _S),
    ("edge_attributes", _S),
)

# Landed input tables.
RAW_EVENTS = _struct(
    ("log_group", _S),
    ("log_stream", _S),
    ("timestamp_ms", _L),
    ("ingestion_time_ms", _L),
    ("event_id", _S),
    ("message", _S),
)

REGISTRY = _struct(
    ("log_group", _S),
    ("log_stream", _S),
    ("retention_in_days", _L),
    ("created_ms", _L),
)

RAW_METRICS = _struct(
    ("namespace", _S),
    ("metric_name", _S),
    ("timestamp_ms", _L),
    ("value", _D),
    ("unit", _S),
    ("dimensions", T.MapType(_S, _S)),
)


def require(df: DataFrame, schema: T.StructType, what: str) -> DataFrame:
    """Return `df` if it carries every column of `schema` with the same type; raise otherwise."""
    have = {field.name: field.dataType for field in df.schema.fields}
    for field in schema.fields:
        if field.name not in have:
            raise ValueError(f"{what}: column {field.name} is missing")
        if have[field.name].simpleString() != field.dataType.simpleString():
            raise ValueError(
                f"{what}: column {field.name} must be {field.dataType.simpleString()}, "
                f"not {have[field.name].simpleString()}"
            )
    return df

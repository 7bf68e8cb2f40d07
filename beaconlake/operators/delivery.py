"""Outgoing logs and metrics: mapping any table to them, request bodies and the outcome of each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake.functions import attributes as A
from beaconlake.functions import checks
from beaconlake.functions.times import event_time, iso_seconds, metric_time, pick

LOG_BATCH = ["log_group", "log_stream", "batch_no"]
METRIC_BATCH = ["namespace", "metric_name", "batch_no"]


def _raise_when(problem: Column) -> Column:
    return F.when(problem.isNull(), True).otherwise(F.raise_error(problem).cast("boolean"))


def _destination(value: str | Column, rule: checks.NameRule) -> Column:
    if isinstance(value, Column):
        return value
    checks.accept(value, rule)
    return F.lit(value)


def _unpacked(df: DataFrame, seq: str, struct: str | None) -> DataFrame:
    """The fields of a struct column (rows without one are not sent), or the table itself."""
    if struct is None:
        return df
    return df.filter(F.col(struct).isNotNull()).select(F.col(seq), f"{struct}.*")


def to_put_events(
    df: DataFrame,
    log_group: str | Column,
    log_stream: str | Column,
    seq: str,
    struct: str | None = None,
    now: int | None = None,
) -> DataFrame:
    """Outgoing events (`seq`, `log_group`, `log_stream`, `timestamp_ms`, `message`) of any log-shaped table.

    The message is `body` or `message`; the time is that of `event_time`. `seq` names the input order. With
    columns as destination, names are checked per row and a bad one raises.
    """
    df = _unpacked(df, seq, struct)
    message = pick(df, ["body", "message"])
    text = F.col(f"`{message.name}`").cast("string") if message is not None else F.lit(None).cast("string")
    events = df.select(
        F.col(seq).alias("seq"),
        _destination(log_group, checks.GROUP).alias("log_group"),
        _destination(log_stream, checks.STREAM).alias("log_stream"),
        event_time(df, now).alias("timestamp_ms"),
        F.coalesce(text, F.lit("")).alias("message"),
    )
    if isinstance(log_group, Column):
        events = events.filter(_raise_when(checks.check_group_name(F.col("log_group"))))
    if isinstance(log_stream, Column):
        events = events.filter(_raise_when(checks.check_stream_name(F.col("log_stream"))))
    return events


def validate_put(events: DataFrame, raise_on_bad: bool = True) -> DataFrame:
    """The events if every message can be sent, else an error; or all events with the reason in `problem`."""
    problem = checks.check_message(F.col("message"))
    return events.filter(_raise_when(problem)) if raise_on_bad else events.withColumn("problem", problem)


def encode_log_batches(planned: DataFrame) -> DataFrame:
    """One JSON request body per batch. A batch is bounded by the limits it was planned with."""
    events = F.array_sort(F.collect_list(F.struct("index_in_batch", "timestamp_ms", "message")))
    grouped = planned.groupBy(*LOG_BATCH).agg(events.alias("_events"))
    body = F.to_json(
        F.struct(
            F.col("log_group").alias("logGroupName"),
            F.col("log_stream").alias("logStreamName"),
            F.transform(
                "_events",
                lambda e: F.struct(e["timestamp_ms"].alias("timestamp"), e["message"].alias("message")),
            ).alias("logEvents"),
        )
    )
    return grouped.select(*LOG_BATCH, F.size("_events").alias("events"), body.alias("body"))


def to_metric_data(df: DataFrame, namespace: str, seq: str, struct: str | None = None, now: int | None = None):
    """Outgoing data points of any gauge-shaped table, in input order `seq`.

    Gives `seq`, `namespace`, `metric_name`, `timestamp_seconds`, `value`, `unit` and `dimensions` (an array, as
    names may repeat). Rows without a usable value are left out; a row without a name, with bad attribute JSON,
    with too many dimensions or with an infinite value raises.
    """
    checks.accept(namespace, checks.NAMESPACE)
    df = _unpacked(df, seq, struct)
    name, value, unit = (pick(df, c) for c in (["name", "metric_name"], ["double_value", "value"], ["unit"]))
    attributes = pick(df, ["metric_attributes", "attributes"])
    if name is None:
        raise ValueError("the input needs a 'name' or 'metric_name' column")
    if value is None:
        raise ValueError("the input needs a 'double_value' or 'value' column")
    metric = F.coalesce(F.col(f"`{name.name}`").cast("string"), F.lit(""))
    number = F.col(f"`{value.name}`").try_cast("double")
    units = F.col(f"`{unit.name}`").cast("string") if unit is not None else F.lit(None).cast("string")
    texts = F.col(f"`{attributes.name}`").cast("string") if attributes is not None else None
    # An empty name raises even without a reading; the other checks apply to what is sent. They sit in the name, which
    # every use of a data point needs, and not in a filter, which would read the attributes once more.
    rows = df.filter(number.isNotNull() | (metric == ""))
    dimensions = A.metric_dimensions(df)
    listed = dimensions
    if texts is not None:
        # A text with few colons has few members, which spares most rows a second look at their dimensions.
        colons = F.length(texts) - F.length(F.replace(texts, F.lit(":"), F.lit("")))
        few = F.coalesce(colons, F.lit(0)) < checks.MAX_DIMENSIONS
        listed = F.when(few, F.array().cast("array<struct<name:string,value:string>>")).otherwise(dimensions)
    problem = checks.check_metric(metric, number, listed, texts)
    return rows.select(
        F.col(seq).alias("seq"),
        F.lit(namespace).alias("namespace"),
        F.when(problem.isNull(), metric).otherwise(F.raise_error(problem).cast("string")).alias("metric_name"),
        metric_time(df, now).alias("timestamp_seconds"),
        number.alias("value"),
        A.translate_unit(units).alias("unit"),
        dimensions.alias("dimensions"),
    )


def datum_bytes() -> Column:
    """Estimated size of a data point in a request body."""
    pairs = F.aggregate(
        "dimensions",
        F.lit(0),
        lambda total, d: total + 120 + F.octet_length(d["name"]) + F.octet_length(d["value"]),
    )
    return F.lit(200) + F.octet_length("metric_name") + F.octet_length("unit") + pairs


def _escaped(text: Column) -> Column:
    """Percent-encoding of everything but unreserved characters."""
    encoded = F.url_encode(text)
    return F.replace(F.replace(F.replace(encoded, F.lit("+"), F.lit("%20")), F.lit("%7E"), F.lit("~")),
                     F.lit("*"), F.lit("%2A"))


def _number(value: Column) -> Column:
    """A decimal text that reads back as the same double."""
    plain = (value == F.floor(value)) & (F.abs(value) < 1e15)
    return F.when(plain, value.cast("long").cast("string")).otherwise(value.cast("string"))


def encode_metric_batches(planned: DataFrame) -> DataFrame:
    """One form-encoded request body per batch. A batch is bounded by the limits it was planned with."""
    data = F.array_sort(
        F.collect_list(
            F.struct("index_in_batch", "metric_name", "timestamp_seconds", "value", "unit", "dimensions")
        )
    )
    grouped = planned.groupBy(*METRIC_BATCH).agg(data.alias("_data"))

    def field(prefix: Column, name: str, text: Column) -> Column:
        return F.concat(prefix, F.lit(f".{name}="), _escaped(text))

    def datum(d: Column, at: Column) -> Column:
        prefix = F.concat(F.lit("MetricData.member."), (at + 1).cast("string"))

        def dimension(pair: Column, place: Column) -> Column:
            inner = F.concat(prefix, F.lit(".Dimensions.member."), (place + 1).cast("string"))
            return F.concat(field(inner, "Name", pair["name"]), F.lit("&"), field(inner, "Value", pair["value"]))

        return F.concat_ws(
            "&",
            field(prefix, "MetricName", d["metric_name"]),
            field(prefix, "Timestamp", iso_seconds(d["timestamp_seconds"] * 1000)),
            field(prefix, "Value", _number(d["value"])),
            field(prefix, "Unit", d["unit"]),
            F.transform(d["dimensions"], dimension),
        )

    # The action and version every request names.
    head = F.concat(F.lit("Action=PutMetricData&Version=2010-08-01&Namespace="), _escaped(F.col("namespace")))
    body = F.concat_ws("&", head, F.transform("_data", datum))
    return grouped.select(*METRIC_BATCH, F.size("_data").alias("data"), body.alias("body"))


def write_batches(encoded: DataFrame, path: str, by: tuple[str, ...] = ("log_group", "log_stream")) -> None:
    """Lands request bodies as JSON lines, one folder per destination; a rerun replaces them."""
    encoded.write.mode("overwrite").partitionBy(*by).json(path)


# The members of one put response.
_RESPONSE = (
    "struct<rejectedLogEventsInfo:struct<expiredLogEventEndIndex:bigint,tooOldLogEventEndIndex:bigint,"
    "tooNewLogEventStartIndex:bigint>,rejectedEntityInfo:struct<errorType:string>>"
)


def read_responses(responses: DataFrame, *kept: str) -> DataFrame:
    """The batch of each response, the columns `kept`, `_unread` for one that can't be read, and its rejections."""
    tree = F.try_parse_json("body")

    def kind(path: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(tree, path, "variant"))

    def other(path: str, *allowed: str) -> Column:
        return F.coalesce(~F.regexp_like(kind(path), F.lit("^(" + "|".join(("VOID", *allowed)) + ")")), F.lit(False))

    unread = tree.isNull() | ~F.schema_of_variant(tree).startswith("OBJECT")
    unread = unread | other("$.rejectedLogEventsInfo", "OBJECT") | other("$.rejectedEntityInfo", "OBJECT")
    for member in ("expiredLogEventEndIndex", "tooOldLogEventEndIndex", "tooNewLogEventStartIndex"):
        unread = unread | other(f"$.rejectedLogEventsInfo.{member}", "BIGINT")
    read = responses.select(*LOG_BATCH, *kept, unread.alias("_unread"), F.from_json("body", _RESPONSE).alias("_r"))
    return read.select(*LOG_BATCH, *kept, "_unread", "_r")


def put_outcome() -> Column:
    """The status of an event at `index_in_batch` from the response `_unread` and `_r` of its batch, NULL without one."""
    at, info = F.col("index_in_batch"), "_r.rejectedLogEventsInfo"
    return (
        F.when(F.col("_unread").isNull(), F.lit(None).cast("string"))
        .when(F.col("_unread"), "unreadable_response")
        .when(F.col("_r.rejectedEntityInfo").isNotNull(), "entity_rejected")
        .when(at <= F.col(f"{info}.expiredLogEventEndIndex"), "expired")
        .when(at <= F.col(f"{info}.tooOldLogEventEndIndex"), "too_old")
        .when(at >= F.col(f"{info}.tooNewLogEventStartIndex"), "too_new")
        .otherwise("ok")
    )


def reconcile_put(planned: DataFrame, responses: DataFrame, raise_on_reject: bool = False) -> DataFrame:
    """Adds `status` to planned events: ok, expired, too_old, too_new, entity_rejected or unreadable_response.

    NULL without a response. `responses` has one `body` per batch; a second answer to a batch raises. Expired and too
    old hold through an index, too new from an index on, and a rejected entity rejects the whole batch. An answer that
    is not a JSON object, or whose rejection members are not objects with whole numbers, says nothing about its events.
    """
    read = read_responses(responses).groupBy(*LOG_BATCH)
    parsed = read.agg(F.count("*").alias("_answers"), F.first(F.struct("_unread", "_r")).alias("a"))
    twice = F.raise_error(F.lit("a batch has more than one response")).cast("boolean")
    unread = F.when(F.col("_answers") > 1, twice).otherwise(F.col("a._unread"))
    parsed = parsed.select(*LOG_BATCH, unread.alias("_unread"), F.col("a._r").alias("_r"))
    outcomes = planned.join(parsed, LOG_BATCH, "left").select(*planned.columns, put_outcome().alias("status"))
    if raise_on_reject:
        rejected = F.when(F.col("status") != "ok", F.concat(F.lit("a batch was partially accepted: "), "status"))
        outcomes = outcomes.filter(_raise_when(rejected))
    return outcomes


def put_status(inputs: DataFrame, outcomes: DataFrame, seq: str = "seq") -> DataFrame:
    """The outcome of every input row, NULL for rows that were not sent."""
    found = outcomes.select(F.col("seq").alias("_seq"), "status")
    return inputs.join(found, F.col(seq) == F.col("_seq"), "left").select(*inputs.columns, "status")


def split_late(
    events: DataFrame, now: int | Column, max_age_ms: int, max_ahead_ms: int, column: str = "timestamp_ms"
) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and the others with `verdict` too_old or too_new."""
    now = F.lit(now).cast("long") if isinstance(now, int) else now
    stamp = F.col(column)
    verdict = F.when(stamp < now - max_age_ms, "too_old").when(stamp > now + max_ahead_ms, "too_new")
    judged = events.withColumn("verdict", verdict)
    return judged.filter(F.col("verdict").isNull()).drop("verdict"), judged.filter(F.col("verdict").isNotNull())

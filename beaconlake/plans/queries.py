"""One query per operator, over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake import storage
from beaconlake.functions import attributes as A
from beaconlake.functions import checks, times
from beaconlake.operators import batching, delivery, ordering, quantiles, registry, sketches, statistics
from beaconlake.plans import inputs
from beaconlake.plans.inputs import EPOCH_2024, NAMESPACE, NOW_MS, table
from beaconlake.sources import alarms, bodies, catalog, graph, logs, metrics, pages, results, table_functions
from beaconlake.streaming import batches, ingest, outcomes, rollup, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

REGION = "us-east-1"
DAY_MS = 86_400_000


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 9) for name in names})


# Scans, predicates and order of log events


@query
def logs_scan(spark, d):
    events = inputs.raw_events(spark, d)
    return logs.logs_scan(events, "/app/error", start="-30d", end="now", region=REGION, now=NOW_MS)


@query
def max_rows(spark, d):
    events = inputs.raw_events(spark, d)
    return logs.logs_scan(
        events, "/app/error", filter="user=1", start="-7d", order="desc", max_rows=100, region=REGION, now=NOW_MS
    )


@query
def where_group(spark, d):
    return logs.where_group(inputs.raw_events(spark, d), "/app/click")


@query
def where_time(spark, d):
    return logs.where_time(inputs.raw_events(spark, d), EPOCH_2024 + 3 * DAY_MS, EPOCH_2024 + 20 * DAY_MS)


@query
def where_pattern(spark, d):
    return logs.where_pattern(inputs.raw_events(spark, d), ' "user=12 props" ')


@query
def where_stream_prefix(spark, d):
    return logs.where_stream_prefix(inputs.raw_events(spark, d), "stream-3")


@query
def where_streams(spark, d):
    return logs.where_streams(inputs.raw_events(spark, d), ["stream-1", "stream-6", "stream-9"])


@query
def otlp_logs(spark, d):
    return logs.to_otlp_logs(inputs.raw_events(spark, d), REGION)


@query
def body_fields(spark, d):
    otlp = logs.to_otlp_logs(inputs.raw_events(spark, d), REGION).select("body", "log_attributes")
    return logs.body_fields(otlp, "k long", F.regexp_extract("body", r"props=(.*)$", 1))


@query
def order_events(spark, d):
    return ordering.order_events(inputs.raw_events(spark, d), ascending=False)


@query
def event_page(spark, d):
    return ordering.event_page(inputs.raw_events(spark, d), limit=500, offset="1500", ascending=True)


@query
def event_page_deep(spark, d):
    """Past what a top-k holds, over events that repeat times and ids; ties differ in the columns that are left out."""
    events = inputs.raw_events(spark, d)
    day = F.col("timestamp_ms") - F.col("timestamp_ms") % DAY_MS
    users = F.regexp_extract("message", r"user=(\d+)", 1).cast("long") % 5
    events = events.withColumns({"timestamp_ms": day, "event_id": F.lpad(users.cast("string"), 19, "0")})
    page = ordering.event_page(events, limit=200, offset=600, ascending=True, top_rows=100)
    return page.select("timestamp_ms", "event_id", "has_more")


@query
def event_page_after(spark, d):
    last = EPOCH_2024 + 10 * DAY_MS
    return ordering.event_page_after(inputs.raw_events(spark, d), last, "0" * 19, limit=500, ascending=False)


@query
def event_positions(spark, d):
    keys = inputs.raw_events(spark, d).select("log_group", "timestamp_ms", "event_id")
    return ordering.with_position(keys, ["log_group"], [F.col("timestamp_ms").asc(), F.col("event_id").asc()])


@query
def union_logs(spark, d):
    events = inputs.raw_events(spark, d)
    sent = inputs.put_events(spark, d).select("log_group", "log_stream", "timestamp_ms", "message")
    return logs.union_logs(events.select("log_group", "log_stream", "timestamp_ms", "message"), sent)


@query
def logs_for_groups(spark, d):
    return logs.logs_for_groups(inputs.raw_events(spark, d), ["/app/error", "/app/view", "/app/none"])


@query
def dedup_groups(spark, d):
    names = inputs.raw_events(spark, d).select("log_group", F.col("event_id").cast("long").alias("position"))
    return ordering.first_of_each(names, "log_group", "position")


@query
def readback_concat(spark, d):
    planned = inputs.planned_logs(spark, d)
    return ordering.read_back(planned, delivery.LOG_BATCH, "message", ["index_in_batch"])


@query
def decode_log_pages(spark, d):
    return logs.decode_log_pages(inputs.log_pages(spark, d))


@query
def decode_group_pages(spark, d):
    landed = pages.with_next_token(inputs.group_pages(spark, d))
    return logs.decode_group_pages(landed).select("page_no", "next_token", "log_group")


@query
def log_stats(spark, d):
    events = inputs.raw_events(spark, d)
    counts = {"events": F.count(F.lit(1)), "last_ms": F.max("timestamp_ms"), "streams": statistics.distinct_count("log_stream", exact=True)}
    by = {"log_group": "log_group", "day": tables.event_date(F.col("timestamp_ms")).cast("string")}
    return statistics.log_stats(events, F.col("message").contains("user=1"), counts, by)


@query
def count_distinct(spark, d):
    events = inputs.raw_events(spark, d)
    user = F.regexp_extract("message", r"user=(\d+)", 1)
    return events.groupBy("log_group").agg(
        statistics.distinct_count(user, exact=True).alias("users"),
        statistics.distinct_count("log_stream", exact=True).alias("streams"),
    )


@query
def count_distinct_approx(spark, d):
    """Whether the sketch is within three times its stated standard error of the exact count."""
    events = inputs.raw_events(spark, d)
    about, exact = statistics.distinct_count("event_id"), F.count_distinct("event_id")
    return events.groupBy("log_group").agg((F.abs(about - exact) <= 3 * 0.05 * exact).alias("within"))


# Metric data points


@query
def where_metric(spark, d):
    points = inputs.raw_metrics(spark, d)
    found = statistics.metric_filter(
        points, NAMESPACE, "view", EPOCH_2024 + DAY_MS, EPOCH_2024 + 25 * DAY_MS, {"service.namespace": "ns-1"}, "Bytes"
    )
    return found.select("namespace", "metric_name", "timestamp_ms", "value", "unit")


@query
def period_bucket(spark, d):
    points = inputs.raw_metrics(spark, d)
    stamp = F.col("timestamp_ms")
    return points.select(
        "metric_name",
        "timestamp_ms",
        statistics.period_bucket(stamp, 300).alias("bucket_ms"),
        statistics.period_bucket(-stamp, 60).alias("negative_bucket_ms"),
    )


def _statistic(name: str, key: str) -> None:
    def run(spark, d):
        points = inputs.raw_metrics(spark, d)
        found = statistics.period_statistic(points, name, 6 * 3600, by=["metric_name"])
        return _rounded(found, "value")

    run.__name__ = key
    query(run)


for _name, _key in {
    "Sum": "metric_sum",
    "Average": "metric_avg",
    "Maximum": "metric_max",
    "Minimum": "metric_min",
    "SampleCount": "metric_count",
    "p90": "metric_percentile",
    "tm90": "metric_trimmed_mean",
    "tc90": "metric_trimmed_count",
    "ts90": "metric_trimmed_sum",
    "wm90": "metric_winsorized",
    "iqm": "metric_iqm",
}.items():
    _statistic(_name, _key)


def _with_ranks(points: DataFrame, found: DataFrame, period: int, shares: dict[str, float]) -> DataFrame:
    """`found` (by metric and period) with how many values are below each of its named columns, and how many up to it."""
    rows = points.withColumn("bucket_ms", statistics.period_bucket(F.col("timestamp_ms"), period))
    joined = rows.select("metric_name", "bucket_ms", "value").join(found, ["metric_name", "bucket_ms"])
    counts = [
        F.count(F.when(F.col("value") < F.col(name) if side == "below" else F.col("value") <= F.col(name), 1)).alias(f"{name}_{side}")
        for name in shares for side in ("below", "upto")
    ]
    return joined.groupBy(*found.columns).agg(F.count(F.lit(1)).alias("values"), F.count_distinct("value").alias("different"), *counts)


@query
def metric_percentile_approx(spark, d):
    """Whether the rank of each value is within the sketch's accuracy of the wanted one."""
    points = inputs.raw_metrics(spark, d)
    found = statistics.period_statistic(points, "p90", 6 * 3600, by=["metric_name"], approx=True)
    ranked = _with_ranks(points, found.withColumnRenamed("value", "p90"), 6 * 3600, {"p90": 0.9})
    within = sketches.rank_within("p90", 0.9, "p90_below", "p90_upto", "values", 1 / quantiles.ACCURACY)
    return ranked.select("metric_name", "bucket_ms", within.alias("within"))


@query
def metric_rollup(spark, d):
    found = statistics.metric_rollup(inputs.raw_metrics(spark, d), 24 * 3600)
    return _rounded(found, "sum", "average")


@query
def metric_rollup_all(spark, d):
    """Every kind of statistic of every series."""
    names = [*statistics.PLAIN, "p90", "tm90", "tc90", "ts90", "wm90", "iqm"]
    found = statistics.metric_rollup(inputs.raw_metrics(spark, d), 24 * 3600, names)
    return _rounded(found, "sum", "average", "p90", "tm90", "ts90", "wm90", "iqm")


@query
def metric_rollup_sketches(spark, d):
    """Minutes stored, merged to five minutes and these to days: plain statistics, and whether the sketches are within
    their errors of the data points."""
    points = inputs.raw_metrics(spark, d)
    path = storage.scratch_path(spark, "sketches")
    sketches.sketch_periods(points, 60, by=["metric_name"]).write.parquet(path)
    merged = sketches.merge_periods(sketches.merge_periods(spark.read.parquet(path), 300), 24 * 3600)
    shares = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
    found = sketches.read_sketches(merged, [*statistics.PLAIN, *shares])
    ranked = _with_ranks(points, found, 24 * 3600, shares)
    near = F.abs(F.col("distinct_values") - F.col("different")) <= sketches.DISTINCT_ERROR * F.col("different") + 1
    return _rounded(ranked, "sum", "average").select(
        "metric_name", "bucket_ms", "sum", "average", "maximum", "minimum", "sample_count",
        *[sketches.rank_within(n, share, f"{n}_below", f"{n}_upto", "values").alias(f"{n}_within") for n, share in shares.items()],
        near.alias("distinct_within"),
    )


@query
def metric_cardinality(spark, d):
    return statistics.metric_cardinality(inputs.raw_metrics(spark, d))


@query
def otlp_gauge(spark, d):
    found = metrics.metrics_scan(
        inputs.raw_metrics(spark, d), NAMESPACE, "purchase", {"service.namespace": "ns-2"}, "Maximum", 3600,
        start="-30d", end="now", region=REGION, now=NOW_MS,
    )
    return found


@query
def metrics_scan(spark, d):
    found = metrics.metrics_scan(
        inputs.raw_metrics(spark, d), NAMESPACE, "error", None, "p50", 24 * 3600, unit="Count",
        start="-30d", end="now", order="desc", now=NOW_MS,
    )
    return _rounded(found.select("time_unix_nano", "name", "unit", "double_value"), "double_value")


@query
def metric_order(spark, d):
    points = statistics.period_statistic(inputs.raw_metrics(spark, d), "Maximum", 3600, by=["metric_name"])
    return metrics.order_points(points, "desc", "bucket_ms")


@query
def decode_metric_pages(spark, d):
    return metrics.decode_metric_pages(inputs.metric_pages(spark, d))


@query
def decode_metric_pages_xml(spark, d):
    return metrics.decode_metric_pages_xml(inputs.metric_pages_xml(spark, d))


# Ragged results, pages, alarms, service graph


@query
def tabulate_results(spark, d):
    return results.tabulate_results(inputs.query_responses(spark, d), keep=["response_no"])


@query
def tabulate_wide(spark, d):
    return results.tabulate_results(inputs.wide_responses(spark, d), keep=["response_no"])


@query
def result_statistics(spark, d):
    return results.result_statistics(inputs.query_responses(spark, d))


@query
def accept_pages(spark, d):
    return pages.accept_pages(inputs.token_pages(spark, d), "previous")


@query
def accept_pages_seen(spark, d):
    return pages.accept_pages(inputs.token_pages(spark, d), "seen")


@query
def order_pages(spark, d):
    return pages.order_pages(inputs.chained_pages(spark, d))


@query
def open_alarms(spark, d):
    found = alarms.open_alarms(inputs.alarm_pages(spark, d))
    return found.withColumn("alarm_actions", F.to_json("alarm_actions"))


@query
def service_dependencies(spark, d):
    return graph.service_dependencies(inputs.graph_pages(spark, d), "2024-01-01", "2024-01-31", now=NOW_MS)


def _attached(spark, d, *names: str):
    """Landed tables attached; the views over them are read by SQL."""
    root = storage.scratch_path(spark, "attach")
    landed = {"events": inputs.raw_events, "registry": inputs.registry, "alarms": inputs.alarm_pages, "graph": inputs.graph_pages}
    for name in names:
        landed[name](spark, d).write.parquet(f"{root}/{name}")
    window = {"start": "2024-01-01", "end": "2024-01-31"}
    more = {"region": REGION} if "events" in names else {}
    return catalog.attach(spark, {name: f"{root}/{name}" for name in names}, now=NOW_MS, **window, **more)


@query
def attach(spark, d):
    """The rows of every log view, with the view's name."""
    names = _attached(spark, d, "events", "registry").names()
    return logs.union_logs(*[spark.sql(f"SELECT '{name}' AS relation, * FROM `{name}`") for name in names])


@query
def attach_alarms(spark, d):
    _attached(spark, d, "alarms")
    return spark.sql(f"SELECT * EXCEPT (alarm_actions), to_json(alarm_actions) AS alarm_actions FROM `{catalog.ALARMS}`")


@query
def attach_edges(spark, d):
    _attached(spark, d, "graph")
    return spark.sql(f"SELECT * FROM `{catalog.EDGES}`")


def _functions(spark, d, name: str, source) -> None:
    """The table function over one landed table, registered."""
    path = storage.scratch_path(spark, f"landed-{name}")
    source(spark, d).write.parquet(path)
    table_functions.register(spark, {name: path}, region=REGION, now=NOW_MS)


@query
def read_logs_function(spark, d):
    _functions(spark, d, "events", inputs.raw_events)
    return spark.sql("""SELECT * FROM read_logs(log_group => '/app/error', filter => '"user=1"', start_time => '-20d',
        log_streams => array('stream-1', 'stream-3'))""")


@query
def read_metrics_function(spark, d):
    _functions(spark, d, "metrics", inputs.raw_metrics)
    return spark.sql(f"""SELECT * FROM read_metrics(namespace => '{NAMESPACE}', metric_name => 'purchase', statistic => 'Maximum',
        period => 3600, start_time => '-25d', unit => 'Bytes')""")


@query
def read_dependencies_function(spark, d):
    _functions(spark, d, "graph", inputs.graph_pages)
    return spark.sql("SELECT * FROM read_service_dependencies(end_time => '2024-01-31', start_time => '2024-01-01T00:00:00Z')")


# Registry


@query
def describe_groups(spark, d):
    return registry.describe_groups(inputs.registry(spark, d), "/crm/")


@query
def describe_streams(spark, d):
    return registry.describe_streams(inputs.registry(spark, d), inputs.raw_events(spark, d), "/app/signup")


@query
def stream_bounds(spark, d):
    return registry.stream_bounds(inputs.raw_events(spark, d))


@query
def known_destination(spark, d):
    return registry.known_destination(inputs.raw_events(spark, d), inputs.registry(spark, d))


@query
def absent_names(spark, d):
    return registry.absent(inputs.group_names(spark, d), inputs.registry(spark, d))


@query
def create_groups(spark, d):
    return registry.create_groups(inputs.registry(spark, d), inputs.group_names(spark, d), NOW_MS)[1]


@query
def create_groups_registry(spark, d):
    return registry.create_groups(inputs.registry(spark, d), inputs.group_names(spark, d), NOW_MS)[0]


@query
def create_streams(spark, d):
    return registry.create_streams(inputs.registry(spark, d), inputs.stream_names(spark, d), NOW_MS)[1]


@query
def create_streams_registry(spark, d):
    return registry.create_streams(inputs.registry(spark, d), inputs.stream_names(spark, d), NOW_MS)[0]


@query
def put_retention(spark, d):
    return registry.put_retention(inputs.registry(spark, d), inputs.retention_settings(spark, d))[0]


@query
def put_retention_outcomes(spark, d):
    return registry.put_retention(inputs.registry(spark, d), inputs.retention_settings(spark, d))[1]


def _deleted(spark, d):
    return registry.delete_groups(inputs.registry(spark, d), inputs.raw_events(spark, d), inputs.group_names(spark, d))


@query
def delete_groups(spark, d):
    return _deleted(spark, d)[2]


@query
def delete_groups_registry(spark, d):
    return _deleted(spark, d)[0]


@query
def delete_groups_events(spark, d):
    return _deleted(spark, d)[1]


@query
def delete_stored_groups(spark, d):
    """What is left of the received table, of which only days that hold a deleted group are written anew."""
    path = storage.scratch_path(spark, "stored")
    tables.append_events(inputs.raw_events(spark, d), path)
    tables.delete_stored_groups(inputs.registry(spark, d), path, inputs.group_names(spark, d))
    found = tables.read_events(spark, path)
    return found.withColumn("event_date", F.col("event_date").cast("string"))


@query
def auto_create(spark, d):
    return registry.auto_create(inputs.registry(spark, d), inputs.raw_events(spark, d))


# Scalar functions


@query
def parse_time(spark, d):
    e = table(spark, d, "events")
    text = (
        F.when(F.col("event_type") == "view", F.concat(F.lit("-"), F.col("user_id").cast("string"), F.lit("m")))
        .when(F.col("event_type") == "click", F.concat(F.lit(" -"), F.col("user_id").cast("string"), F.lit("W ")))
        .when(F.col("event_type") == "error", F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00'"))
        .when(F.col("event_type") == "signup", F.col("event_id").cast("string"))
        .otherwise(F.col("props"))
    )
    read = e.select("event_id", text.alias("text"))
    return read.select(
        "event_id",
        "text",
        times.parse_time(F.col("text"), NOW_MS).alias("ms"),
        times.time_problem(F.col("text"), NOW_MS, "start_time").alias("problem"),
    )


@query
def event_time(spark, d):
    e = table(spark, d, "events")
    early = F.col("event_type") == "view"
    rows = e.select(
        "event_id",
        F.when(~early, times.stamp_ms(F.col("ts")) * 1_000_000 + 999_999).alias("Time_Unix_Nano"),
        F.when(F.col("value") > 5, F.col("ts")).alias("observed_time_unix_nano"),
    )
    return rows.select("event_id", times.event_time(rows, NOW_MS).alias("ms"))


@query
def metric_time(spark, d):
    rows = table(spark, d, "events").select("event_id", F.when(F.col("value") > 5, F.col("ts")).alias("timestamp"))
    return rows.select("event_id", times.metric_time(rows, NOW_MS).alias("seconds"))


@query
def iso_time(spark, d):
    events = inputs.raw_events(spark, d).select("event_id", times.iso_seconds(F.col("timestamp_ms")).alias("iso"))
    return events.select("event_id", "iso", times.iso_ms(F.col("iso")).alias("ms"))


@query
def ms_to_time(spark, d):
    events = inputs.raw_events(spark, d)
    ms = F.when(F.col("log_group") == "/app/view", -F.col("timestamp_ms")).otherwise(F.col("timestamp_ms"))
    return events.select("event_id", times.ms_to_time(ms).alias("stamp"))


@query
def translate_unit(spark, d):
    return inputs.gauges(spark, d).select("seq", "unit", A.translate_unit(F.col("unit")).alias("translated"))


@query
def metric_dimensions(spark, d):
    gauges = inputs.gauges(spark, d)
    return gauges.select("seq", F.to_json(A.metric_dimensions(gauges)).alias("dimensions"))


@query
def dimension_value(spark, d):
    points = inputs.raw_metrics(spark, d)
    return points.select(
        "timestamp_ms",
        A.dimension_value(F.col("dimensions"), "service.name").alias("service"),
        A.dimension_value(F.col("dimensions"), "service.instance.id").alias("instance"),
        A.dimensions_key(F.col("dimensions")).alias("dimensions_key"),
    )


@query
def event_ids(spark, d):
    documents = table(spark, d, "documents")
    return documents.select("doc_id", A.event_id(F.col("doc_id") + 12345678900000, F.col("n_chars") + 1_000_000).alias("event_id"))


@query
def check_names(spark, d):
    documents = table(spark, d, "documents")
    return documents.select(
        "doc_id",
        checks.check_group_name(F.col("text")).alias("group_problem"),
        checks.check_stream_name(F.col("text")).alias("stream_problem"),
        checks.check_namespace(F.concat(F.when(F.col("lang") == "de", "AWS/").otherwise(""), "source")).alias(
            "namespace_problem"
        ),
    )


@query
def check_retention(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey", checks.check_retention(F.col("c_custkey")).alias("problem")
    )


@query
def check_message(spark, d):
    documents = table(spark, d, "documents")
    message = F.when(F.col("lang") == "es", "").otherwise(
        F.when(F.col("lang") == "fr", F.expr("repeat(text, cast(least(600, 1048576 / greatest(octet_length(text), 1) + 2) as int))")).otherwise(F.col("text"))
    )
    return documents.select("doc_id", checks.check_message(message).alias("problem"))


def _put_events(spark, d):
    """Documents as events; Spanish ones are empty, of every tenth French and German one the length is the bound and a byte more."""
    long = F.when(F.col("doc_id") % 10 == 0, F.when(F.col("lang") == "fr", F.repeat(F.lit("x"), F.lit(1_048_550))).when(F.col("lang") == "de", F.repeat(F.lit("x"), F.lit(1_048_551))))
    message = F.when(F.col("lang") == "es", "").otherwise(F.coalesce(long, "text"))
    return table(spark, d, "documents").select(
        F.col("lang").alias("log_group"), F.lit(None).cast("string").alias("log_stream"), F.lit(EPOCH_2024).cast("long").alias("timestamp_ms"),
        F.col("doc_id").alias("seq"), message.alias("message"),
    )


@query
def validate_put(spark, d):
    return delivery.validate_put(_put_events(spark, d), raise_on_bad=False).select("seq", "problem")


@query
def plan_valid_batches(spark, d):
    """Events that can be sent, planned for destinations without a stream name."""
    planned = batching.plan_log_batches(_put_events(spark, d), bad_messages="drop")
    return planned.groupBy("log_group").agg(F.count("batch_no").alias("events"))


@query
def check_metric(spark, d):
    e = table(spark, d, "events")
    size = F.col("user_id") % 40
    pairs = F.transform(
        F.sequence(F.lit(0), size.cast("int")),
        lambda i: F.struct(i.cast("string").alias("name"), F.lit("v").alias("value")),
    )
    name = F.when(F.col("event_type") == "signup", "").otherwise(F.col("event_type"))
    value = F.when(F.col("event_type") == "view", F.lit(float("inf"))).otherwise(F.col("value"))
    attributes = F.when(F.col("value") > 20, F.concat("props", F.lit("}"))).otherwise(F.col("props"))
    rows = e.select("event_id", name.alias("n"), value.alias("v"), pairs.alias("p"), attributes.alias("a"))
    problem = checks.check_metric(F.col("n"), F.col("v"), F.col("p"), F.col("a"))
    return rows.select("event_id", problem.alias("problem"))


@query
def check_metric_age(spark, d):
    points = inputs.raw_metrics(spark, d)
    now = EPOCH_2024 + 20 * DAY_MS
    return points.select(
        "metric_name", "timestamp_ms", checks.check_metric_age(F.col("timestamp_ms"), now).alias("verdict")
    )


# Delivery


@query
def to_put_events(spark, d):
    return inputs.put_events(spark, d)


@query
def plan_log_batches(spark, d):
    return inputs.planned_logs(spark, d).drop("message")


@query
def plan_log_batches_by_size(spark, d):
    planned = batching.plan_log_batches(inputs.put_events(spark, d), max_events=100, max_bytes=40_000, max_span_ms=10**12)
    return planned.drop("message")


@query
def encode_log_batches(spark, d):
    return delivery.encode_log_batches(inputs.planned_logs(spark, d))


@query
def write_batches(spark, d):
    path = storage.scratch_path(spark, "batches")
    delivery.write_batches(delivery.encode_log_batches(inputs.planned_logs(spark, d)), path)
    landed = spark.read.schema("batch_no long, events int, body string, log_group string, log_stream string").json(path)
    return landed.select("log_group", "log_stream", "batch_no", "events", "body")


@query
def to_metric_data(spark, d):
    data = delivery.to_metric_data(inputs.gauges(spark, d), NAMESPACE, "seq", now=NOW_MS)
    return data.withColumn("dimensions", F.to_json("dimensions"))


@query
def datum_bytes(spark, d):
    data = delivery.to_metric_data(inputs.gauges(spark, d), NAMESPACE, "seq", now=NOW_MS)
    return data.select("seq", delivery.datum_bytes().alias("bytes"))


@query
def plan_metric_batches(spark, d):
    return inputs.planned_metrics(spark, d).drop("dimensions")


@query
def plan_metric_batches_by_size(spark, d):
    return inputs.planned_metrics(spark, d, max_data=60, max_bytes=30_000).drop("dimensions")


@query
def encode_metric_batches(spark, d):
    return delivery.encode_metric_batches(inputs.planned_metrics(spark, d))


@query
def reconcile_put(spark, d):
    planned = inputs.planned_logs(spark, d)
    return delivery.reconcile_put(planned, inputs.put_responses(spark, d)).drop("message")


@query
def put_status(spark, d):
    planned = inputs.planned_logs(spark, d)
    outcomes = delivery.reconcile_put(planned, inputs.put_responses(spark, d))
    return delivery.put_status(inputs.log_rows(spark, d).select("seq", "lang"), outcomes)


@query
def split_late_accepted(spark, d):
    return delivery.split_late(inputs.raw_events(spark, d), EPOCH_2024 + 20 * DAY_MS, 14 * DAY_MS, 2 * DAY_MS)[0]


@query
def split_late(spark, d):
    return delivery.split_late(inputs.raw_events(spark, d), EPOCH_2024 + 20 * DAY_MS, 14 * DAY_MS, 2 * DAY_MS)[1]


@query
def decode_put_log_bodies(spark, d):
    return bodies.decode_put_log_bodies(inputs.put_log_bodies(spark, d))[0]


@query
def decode_put_log_dead_letters(spark, d):
    return bodies.decode_put_log_bodies(inputs.put_log_bodies(spark, d))[1].select("body_seq", "reason")


def _flat(points: DataFrame) -> DataFrame:
    return points.withColumn("dimensions", A.dimensions_key(F.col("dimensions")))


@query
def decode_put_metric_bodies(spark, d):
    return _flat(bodies.decode_put_metric_bodies(inputs.put_metric_bodies(spark, d))[0])


@query
def decode_put_metric_dead_letters(spark, d):
    return bodies.decode_put_metric_bodies(inputs.put_metric_bodies(spark, d))[1].select("body_seq", "reason")


@query
def metric_round_trip(spark, d):
    """Encoded metric batches read back: the data points that were sent."""
    sent = delivery.encode_metric_batches(inputs.planned_metrics(spark, d))
    numbered = sent.select(
        (F.crc32("metric_name") * 1_000_000 + F.col("batch_no")).alias("body_seq"),
        F.lit(NOW_MS).alias("received_ms"),
        "body",
    )
    return _flat(bodies.decode_put_metric_bodies(numbered)[0])


@query
def append_events(spark, d):
    path = storage.scratch_path(spark, "events")
    tables.append_events(inputs.raw_events(spark, d), path)
    found = tables.read_events(spark, path)
    return found.withColumn("event_date", F.col("event_date").cast("string"))


@query
def append_metrics(spark, d):
    path = storage.scratch_path(spark, "metrics")
    tables.append_metrics(inputs.raw_metrics(spark, d), path)
    found = tables.read_metrics(spark, path).withColumn("event_date", F.col("event_date").cast("string"))
    return _flat(found)


# Streaming


def _log_intake(spark, d, times: int = 1, **how) -> str:
    """Landed log bodies taken in, `times` times over in as many micro-batches; gives the folder.

    Bodies land in as many files as they are read in. Each landing is a run of its own from the checkpoint, so that a
    micro-batch holds a whole landing, whatever its number of files.
    """
    root = storage.scratch_path(spark, "ingest-logs")
    landed = inputs.put_log_bodies(spark, d)
    inputs.registry(spark, d).write.parquet(f"{root}/registry")
    for _ in range(times):
        landed.write.mode("append").parquet(f"{root}/bodies")
        stream = spark.readStream.schema(ingest.BODIES).parquet(f"{root}/bodies")
        ingest.stream_ingest_logs(stream, f"{root}/registry", f"{root}/out", f"{root}/state", **how).awaitTermination()
    return root


def _taken_in(spark, root: str) -> DataFrame:
    accepted = tables.read_events(spark, f"{root}/out/events").drop("event_date")
    rejected = spark.read.parquet(f"{root}/out/rejected").drop("stream", "batch")
    return logs.union_logs(accepted.withColumn("problem", F.lit(None).cast("string")), rejected)


@query
def stream_ingest_logs(spark, d):
    return _taken_in(spark, _log_intake(spark, d))


@query
def stream_ingest_redelivered(spark, d):
    """Every body comes in two micro-batches and is taken in once."""
    return _taken_in(spark, _log_intake(spark, d, times=2, redelivered="1 hour"))


@query
def stream_ingest_created(spark, d):
    """The registry after an intake that creates what it does not know."""
    root = _log_intake(spark, d, create=True)
    return ingest.read_registry(spark, f"{root}/registry", f"{root}/out")


@query
def stream_ingest_kept(spark, d):
    """The events of that intake, of which none is rejected."""
    root = _log_intake(spark, d, create=True)
    return tables.read_events(spark, f"{root}/out/events").drop("event_date")


def _streamed_batches(spark, d) -> str:
    root = storage.scratch_path(spark, "stream-batches")
    events = inputs.put_events(spark, d)
    # each destination's first half by time lands first, so that a batch stays open from one micro-batch to the next
    middle = events.agg(F.percentile_approx("timestamp_ms", 0.5)).first()[0]
    for part in (F.col("timestamp_ms") <= middle, F.col("timestamp_ms") > middle):
        events.filter(part).write.mode("append").parquet(f"{root}/events")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/events")
        batches.write_log_batches(batches.stream_log_batches(stream, DAY_MS), f"{root}/out", f"{root}/state").awaitTermination()
    return f"{root}/out"


@query
def stream_log_batches(spark, d):
    return spark.read.parquet(f"{_streamed_batches(spark, d)}/planned").drop("stream", "batch")


@query
def stream_closed_batches(spark, d):
    return spark.read.parquet(f"{_streamed_batches(spark, d)}/closed").drop("stream", "batch")


@query
def stream_put_outcomes(spark, d):
    """Planned events and responses as streams; a late pair at the end takes both past the limit."""
    root = storage.scratch_path(spark, "stream-outcomes")
    planned = inputs.planned_logs(spark, d).drop("message")
    sent = planned.withColumn("sent_ms", EPOCH_2024 + F.col("batch_no") * 10)
    answers = inputs.put_responses(spark, d).withColumn("received_ms", EPOCH_2024 + F.col("batch_no") * 10 + 5)
    for name, rows, stamp in (("sent", sent, "sent_ms"), ("answers", answers, "received_ms")):
        last = rows.limit(1).withColumns({"log_group": F.lit("/last"), stamp: F.lit(NOW_MS)})
        rows.unionByName(last).write.parquet(f"{root}/{name}")
    streams = [spark.readStream.schema(x.schema).parquet(f"{root}/{n}") for n, x in (("sent", sent), ("answers", answers))]
    found = outcomes.stream_put_outcomes(*streams).drop("sent_ms")
    writer = found.writeStream.format("parquet").option("checkpointLocation", f"{root}/state").outputMode("append")
    writer.trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    # a filter on the stream would reach its source, and the last pair would move no watermark
    return spark.read.schema(found.schema).parquet(f"{root}/out").filter("log_group <> '/last'")


@query
def stream_ingest_metrics(spark, d):
    root = storage.scratch_path(spark, "ingest-metrics")
    inputs.put_metric_bodies(spark, d).write.parquet(f"{root}/bodies")
    stream = spark.readStream.schema(ingest.BODIES).parquet(f"{root}/bodies")
    ingest.stream_ingest_metrics(stream, f"{root}/out", f"{root}/state").awaitTermination()
    return _flat(tables.read_metrics(spark, f"{root}/out/metrics").drop("event_date"))


@query
def stream_metric_rollup(spark, d):
    root = storage.scratch_path(spark, "rollup")
    points = inputs.raw_metrics(spark, d)
    points.write.parquet(f"{root}/points")
    stream = spark.readStream.schema(points.schema).parquet(f"{root}/points")
    found = rollup.stream_metric_rollup(stream, 24 * 3600, "2 days")
    rollup.write_periods(found, f"{root}/out", f"{root}/state").awaitTermination()
    return _rounded(rollup.read_periods(spark, f"{root}/out"), "sum", "average")

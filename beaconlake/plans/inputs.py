"""The library's input tables, derived by Spark from the given star-schema, event and document tables.

Each function has a counterpart of the same meaning in `beaconlake.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.functions.checks import RETENTION_DAYS
from beaconlake.functions.times import stamp_ms
from beaconlake.operators.batching import plan_log_batches, plan_metric_batches
from beaconlake.operators.delivery import encode_log_batches, to_metric_data, to_put_events
from beaconlake.storage import pin

# The moment the queries count from (2024-01-31 00:00 UTC) and where documents' times begin.
NOW_MS = 1_706_659_200_000
EPOCH_2024 = 1_704_067_200_000
NAMESPACE = "/app/metrics"
POINT_UNITS = ["None", "Milliseconds", "Bytes", "Count"]
GAUGE_UNITS = ["s", "ms", "us", "By", "bytes", "KiBy", "MiBy", "GiBy", "Bi", "%", "1", "", "{req}", "ns", None]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Received log events: one per row of `events`."""
    e = table(spark, sf_dir, "events")
    ms = stamp_ms(F.col("ts"))
    return e.select(
        _text("/app/", F.col("event_type")).alias("log_group"),
        _text("stream-", F.col("user_id") % 8).alias("log_stream"),
        ms.alias("timestamp_ms"),
        (ms + F.col("event_id") % 5000).alias("ingestion_time_ms"),
        F.lpad((F.col("event_id") + 1).cast("string"), 19, "0").alias("event_id"),
        _text(F.col("event_type"), " user=", F.col("user_id"), " props=", F.col("props")).alias("message"),
    )


def raw_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Received data points: one per row of `events`."""
    e = table(spark, sf_dir, "events")
    units = F.array(*[F.lit(u) for u in POINT_UNITS])
    return e.select(
        F.lit(NAMESPACE).alias("namespace"),
        F.col("event_type").alias("metric_name"),
        stamp_ms(F.col("ts")).alias("timestamp_ms"),
        "value",
        F.get(units, (F.col("user_id") % 4).cast("int")).alias("unit"),
        F.create_map(
            F.lit("service.name"),
            _text("svc-", F.col("user_id") % 10),
            F.lit("service.namespace"),
            _text("ns-", F.col("user_id") % 3),
        ).alias("dimensions"),
    )


def _segment_group() -> Column:
    return _text("/crm/", F.lower("c_mktsegment"))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of events (sign-ups were never registered) and of customer segments, and hand-made streams."""
    events = raw_events(spark, sf_dir)
    none, no_stream = F.lit(None).cast("long"), F.lit(None).cast("string").alias("log_stream")
    groups = (
        events.filter(F.col("log_group") != "/app/signup")
        .groupBy("log_group")
        .agg(F.min("timestamp_ms").alias("created_ms"))
        .select("log_group", no_stream, none.alias("retention_in_days"), "created_ms")
    )
    segments = (
        table(spark, sf_dir, "customer")
        .groupBy(_segment_group().alias("log_group"))
        .agg((F.lit(EPOCH_2024) + F.min("c_custkey")).alias("created_ms"))
        .select(
            "log_group",
            no_stream,
            F.when(F.col("log_group").startswith("/crm/b"), F.lit(30).cast("long")).alias("retention_in_days"),
            "created_ms",
        )
    )
    streams = (
        table(spark, sf_dir, "events")
        .filter(F.col("user_id") < 5)
        .groupBy(
            _text("/app/", F.col("event_type")).alias("log_group"),
            _text("stream-", F.col("user_id") % 8).alias("log_stream"),
        )
        .agg(F.min(stamp_ms(F.col("ts"))).alias("created_ms"))
        .select("log_group", "log_stream", none.alias("retention_in_days"), "created_ms")
    )
    # A table of its own in practice, and used more than once by most operators.
    return pin(groups.unionByName(segments).unionByName(streams), "registry")


def group_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inventory of group names with repeats, known names and NULLs: one per customer."""
    name = (
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
        .when(F.col("c_nationkey") < 5, _segment_group())
        .when(F.col("c_nationkey") < 8, F.lit("/app/error"))
        .otherwise(_text("/nation/", F.col("c_nationkey")))
    )
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("seq"), name.alias("log_group"))


def stream_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inventory of stream names in existing groups: one per event, without a group for sign-ups, whose group does
    not exist."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") != "signup", _text("/app/", F.col("event_type"))).alias("log_group"),
        F.when(F.col("value") >= 1, _text("stream-", F.col("user_id") % 8)).alias("log_stream"),
    )


def retention_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retention by customer: segments get several settings, of which the last counts."""
    days = F.array(*[F.lit(d).cast("long") for d in RETENTION_DAYS])
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("seq"),
        F.when(F.col("c_acctbal") >= 0, _segment_group()).alias("log_group"),
        F.get(days, F.col("c_nationkey") % len(RETENTION_DAYS)).alias("retention_in_days"),
    )


def gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gauge rows to send: small values stand for missing readings."""
    e = table(spark, sf_dir, "events")
    units = F.array(*[F.lit(u).cast("string") for u in GAUGE_UNITS])
    return e.select(
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("name"),
        F.when(F.col("value") >= 1, F.col("value")).alias("double_value"),
        F.col("ts").alias("time_unix_nano"),
        F.get(units, (F.col("user_id") % 15).cast("int")).alias("unit"),
        _text("svc-", F.col("user_id") % 10).alias("service_name"),
        _text(
            '{"zone":"z ', F.col("user_id") % 3, '","k":', F.get_json_object("props", "$.k"),
            ',"host":"h~', F.col("user_id") % 7, '*"}',
        ).alias("metric_attributes"),
    )


def log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows to send: whole documents, one hour apart."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("seq"),
        F.col("text").alias("body"),
        (F.lit(EPOCH_2024) + F.col("doc_id") * 3_600_000).alias("timestamp"),
        "lang",
    )


def put_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_put_events(log_rows(spark, sf_dir), _text("/docs/", F.col("lang")), F.lit("ingest"), "seq", now=NOW_MS)


def planned_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_log_batches(put_events(spark, sf_dir))


def planned_metrics(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    return plan_metric_batches(to_metric_data(gauges(spark, sf_dir), NAMESPACE, "seq", now=NOW_MS), **limits)


def put_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per planned batch except the English ones: outcomes follow batch size and language."""
    batches = encode_log_batches(planned_logs(spark, sf_dir)).select("log_group", "log_stream", "batch_no", "events")
    group, events = F.col("log_group"), F.col("events")
    index = F.struct(
        F.when(group == "/docs/fr", F.lit(1)).alias("expiredLogEventEndIndex"),
        F.when(group.isin("/docs/fr", "/docs/es"), F.lit(2)).alias("tooOldLogEventEndIndex"),
        F.when(group == "/docs/de", events - 1).alias("tooNewLogEventStartIndex"),
    )
    entity = F.when((group == "/docs/de") & (events < 3), F.struct(F.lit("InvalidEntity").alias("errorType")))
    body = F.to_json(F.struct(index.alias("rejectedLogEventsInfo"), entity.alias("rejectedEntityInfo")))
    # Answers that can't be read: no JSON, no object, and rejection members of the wrong kind.
    broken = F.array(*map(F.lit, ["<html>", "[]", '{"rejectedLogEventsInfo":7}', '{"rejectedLogEventsInfo":{"expiredLogEventEndIndex":"2"}}', '{"rejectedEntityInfo":[]}']))
    body = F.when((group == "/docs/es") & (F.col("batch_no") % 2 == 1), broken[F.floor(F.col("batch_no") / 2) % 5]).otherwise(body)
    return batches.filter(group != "/docs/en").select("log_group", "log_stream", "batch_no", body.alias("body"))


def group_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page of log groups per nation, a group per supplier; every third name is a number, which is no name."""
    name = F.when(F.col("s_suppkey") % 3 == 0, F.col("s_suppkey").cast("string")).otherwise(_text('"/supplier/', F.col("s_suppkey"), '"'))
    group = _text('{"logGroupName":', name, "}")
    listed = F.array_join(F.array_sort(F.collect_list(group)), ",")
    pages = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("page_no")).agg(listed.alias("groups"))
    return pages.select("page_no", _text('{"logGroups":[', F.col("groups"), '],"nextToken":"p', F.col("page_no"), '"}').alias("body"))


def put_log_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log request per document with two events; some languages break a rule."""
    d = table(spark, sf_dir, "documents")
    stamp = F.lit(EPOCH_2024) + F.col("doc_id") * 1000
    good = F.to_json(
        F.struct(
            _text("/app/", F.when(F.col("n_chars") < 1000, "error").otherwise("absent")).alias("logGroupName"),
            F.when(F.col("lang") == "es", F.lit("")).otherwise(F.lit("stream-1")).alias("logStreamName"),
            F.array(
                F.struct(stamp.alias("timestamp"), F.col("text").alias("message")),
                F.struct((stamp + 1).alias("timestamp"), F.col("source").alias("message")),
            ).alias("logEvents"),
        )
    )
    number = F.to_json(
        F.struct(
            F.lit("/app/error").alias("logGroupName"),
            F.lit("stream-1").alias("logStreamName"),
            F.array(F.struct(stamp.alias("timestamp"), F.col("doc_id").alias("message"))).alias("logEvents"),
        )
    )
    body = F.when(F.col("lang") == "de", number).when(
        F.col("lang") == "fr", F.substring(good, 1, F.length(good) - 1)
    )
    return d.select(
        F.col("doc_id").alias("body_seq"), F.lit(NOW_MS).alias("received_ms"), F.coalesce(body, good).alias("body")
    )


def put_metric_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metric request per event: what is missing or broken in it follows the event's type."""
    e = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    first = _text(
        "MetricData.member.1.MetricName=", kind,
        F.when(kind == "error", "").otherwise(_text("&MetricData.member.1.Value=", F.col("value"))),
        F.when(kind == "click", "").otherwise(
            _text("&MetricData.member.1.Timestamp=",
                  F.replace(F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(":"), F.lit("%3A")))
        ),
        "&MetricData.member.1.Dimensions.member.1.Name=service+name",
        "&MetricData.member.1.Dimensions.member.1.Value=svc%2F", F.col("user_id") % 10,
        F.when(kind == "view", "%zz").otherwise(""),
        "&MetricData.member.1.Dimensions.member.3.Name=lost&MetricData.member.1.Dimensions.member.3.Value=lost",
    )
    # A second data point follows without a gap for clicks and after one for the others.
    second = _text(
        "&MetricData.member.", F.when(kind == "click", "2").otherwise("3"), ".MetricName=second",
        "&MetricData.member.", F.when(kind == "click", "2").otherwise("3"), ".Value=", F.col("user_id"),
        "&MetricData.member.2.Unit=Count&MetricData.member.2.Unit=Bytes",
    )
    name = F.when(kind == "purchase", "").otherwise("%2Fapp%2Fmetrics")
    body = _text("Action=PutMetricData&Version=2010-08-01&Namespace=", name, "&", first, second)
    return e.select(F.col("event_id").alias("body_seq"), F.lit(NOW_MS).alias("received_ms"), body.alias("body"))


def token_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Response pages per user: the tokens come from the events' own numbers and repeat now and then."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("request_id"),
        F.col("event_id").alias("page_no"),
        _text("t-", F.floor("value")).alias("token_in"),
        F.when(k == 0, F.lit("")).otherwise(_text("t-", k)).alias("next_token"),
        F.col("event_type").alias("body"),
    )


def chained_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Response pages that only their tokens put in order.

    Events are five long chains. Customers are 50 chains: every second leads from its third page back to the second, and
    one lacks its first page. Orders are chains of three pages, a third of them without the second. Suppliers are single
    pages, half of which name a page that was not landed, each with a page that names itself and that none leads to.
    """

    def page(rows: DataFrame, kind: str, of: Column, number: Column, following: Column) -> DataFrame:
        token = lambda n: F.when(n > 0, _text(f"{kind}-", n)).otherwise("")
        return rows.select(
            _text(f"{kind}/", of).alias("request_id"), token(number).alias("token_in"), token(following).alias("next_token")
        )

    event, customer, order, supplier = F.col("event_id"), F.col("c_custkey"), F.col("o_orderkey"), F.col("s_suppkey")
    chains = page(table(spark, sf_dir, "events"), "event", event % 5, F.floor(event / 5), F.floor(event / 5) + 1)
    at = F.floor(customer / 50)
    rings = page(table(spark, sf_dir, "customer"), "customer", customer % 50, at, F.when((at == 2) & (customer % 2 == 0), 1).otherwise(at + 1))
    parts = table(spark, sf_dir, "orders").select("o_orderkey", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("n"))
    short = page(parts.filter((F.col("n") != 1) | (order % 3 != 0)), "order", order, F.col("n"), (F.col("n") + 1) % 3)
    suppliers = table(spark, sf_dir, "supplier")
    alone = page(suppliers, "supplier", supplier, F.lit(0), F.when(supplier % 2 == 0, 0).otherwise(7))
    stray = page(suppliers, "supplier", supplier, F.lit(8), F.lit(8))
    return chains.unionByName(rings).unionByName(short).unionByName(alone).unionByName(stray)


def log_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page of log events per event: a full event and one that lacks most members."""
    e = raw_events(spark, sf_dir)
    full = F.struct(
        F.col("event_id").alias("eventId"),
        F.col("ingestion_time_ms").alias("ingestionTime"),
        F.col("log_stream").alias("logStreamName"),
        F.col("message").alias("message"),
        F.col("timestamp_ms").alias("timestamp"),
    )
    nothing = F.lit(None).cast("string")
    bare = F.struct(
        nothing.alias("eventId"),
        nothing.cast("long").alias("ingestionTime"),
        nothing.alias("logStreamName"),
        F.col("log_group").alias("message"),
        nothing.cast("long").alias("timestamp"),
    )
    events = F.when(F.col("log_group") == "/app/view", F.array(full, bare)).otherwise(F.array(full))
    return e.select(
        F.col("event_id").alias("request_id"),
        F.lit(0).alias("page_no"),
        F.to_json(F.struct(events.alias("events"), F.lit("next").alias("nextToken"))).alias("body"),
    )


def metric_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page of metric results per event: two points a second apart, the second an integer."""
    e = table(spark, sf_dir, "events")
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    body = _text(
        '{"MetricDataResults":[{"Id":"m1","Label":"', F.col("event_type"), '","StatusCode":"Complete","Timestamps":[',
        second, ",", second + 1, '],"Values":[', F.col("value"), ",", F.col("user_id"), "]}]}",
    )
    return e.select(F.col("event_id").alias("request_id"), F.lit(0).alias("page_no"), body.alias("body"))


def metric_pages_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same points as XML; the second result member of a page does not count."""
    e = table(spark, sf_dir, "events")
    second = F.col("ts").cast("timestamp")

    def iso(stamp: Column) -> Column:
        return F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'")

    body = _text(
        "<GetMetricDataResponse><GetMetricDataResult><MetricDataResults><member><Id>m1</Id><Label>",
        F.col("event_type"), "</Label><StatusCode>Complete</StatusCode><Timestamps><member>", iso(second),
        "</member><member>", iso(second + F.expr("INTERVAL 1 SECOND")), "</member></Timestamps><Values><member>",
        F.col("value"), "</member><member>", F.col("user_id"), "</member></Values></member><member><Id>m2</Id>",
        "<Timestamps><member>2020-01-01T00:00:00Z</member></Timestamps><Values><member>1</member></Values></member>",
        "</MetricDataResults></GetMetricDataResult></GetMetricDataResponse>",
    )
    return e.select(F.col("event_id").alias("request_id"), F.lit(0).alias("page_no"), body.alias("body"))


def wide_responses(spark: SparkSession, sf_dir: str, fields: int = 400, per_row: int = 20) -> DataFrame:
    """One response per event with `per_row` of `fields` fields, other ones for the next event."""
    at = lambda i: F.format_string("f%03d", ((F.col("event_id") * 7 + i) % fields).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.lit(per_row - 1)), lambda i: F.struct(at(i).alias("field"), i.cast("string").alias("value")))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("response_no"), F.lit("Complete").alias("status"), F.array(pairs).alias("results")
    )


def query_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ad-hoc query response per event: which fields its row has follows the event's type and value."""
    e = table(spark, sf_dir, "events")
    kind = F.col("event_type")

    def pair(name: Column | str, value: Column | str) -> Column:
        name, value = (F.lit(x) if isinstance(x, str) else x.cast("string") for x in (name, value))
        return F.struct(name.alias("field"), value.alias("value"))

    nothing = F.lit(None).cast("string")
    pairs = F.array(
        pair("service_name", _text("svc-", F.col("user_id") % 10)),
        F.when(F.col("value") >= 5, pair("events", F.col("value"))),
        F.when(kind == "click", pair("k", F.get_json_object("props", "$.k"))),
        F.when(kind == "error", pair("service_name", "last one")),
        F.when(kind == "view", pair("empty", nothing)),
        F.when(kind == "signup", pair(nothing, "nameless")),
    )
    row = F.filter(pairs, lambda p: p.isNotNull())
    return e.select(
        F.col("event_id").alias("response_no"),
        F.lit("Complete").alias("status"),
        F.array(row).alias("results"),
        F.struct(
            F.col("user_id").cast("double").alias("recordsMatched"),
            (F.col("user_id") + 100).cast("double").alias("recordsScanned"),
        ).alias("statistics"),
    )


def alarm_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alarm pages of 50 suppliers each: the balance sets the state, pairs of suppliers may share an ARN."""
    s = table(spark, sf_dir, "supplier")
    balance, nation = F.col("s_acctbal"), F.col("s_nationkey")
    status = F.when(balance < 2000, "ALARM").when(balance < 4000, "INSUFFICIENT_DATA").otherwise("OK")
    asked = F.when((balance >= 2000) & (balance < 4000), "INSUFFICIENT_DATA").otherwise("ALARM")
    arn = F.when(nation >= 10, _text("<AlarmArn>arn:", F.floor(F.col("s_suppkey") / 2), "</AlarmArn>")).otherwise("")
    dimensions = F.when(nation < 5, "").when(nation < 8, "<Dimensions></Dimensions>").otherwise(
        _text("<Dimensions><member><Name>nation</Name><Value>n&amp;", nation, "</Value></member>",
              "<member><Name>kind</Name><Value>supplier</Value></member></Dimensions>")
    )
    member = _text(
        "<member>", arn, "<AlarmName>", F.col("s_name"), "</AlarmName><StateValue>", status, "</StateValue>",
        "<StateUpdatedTimestamp>2024-01-", F.lpad((nation + 1).cast("string"), 2, "0"),
        "T01:02:03.456Z</StateUpdatedTimestamp><StateReason> balance &lt; ", F.floor(balance), " &#65; </StateReason>",
        F.when(nation >= 20, "").otherwise(
            _text("<ActionsEnabled>", F.when(nation < 10, "true").otherwise("false"), "</ActionsEnabled>")
        ),
        "<AlarmActions><member>act-", nation, "</member><member></member></AlarmActions>", dimensions, "</member>",
    )
    placed = s.select(
        asked.alias("state"),
        F.floor(F.col("s_suppkey") / 50).alias("page_no"),
        (nation % 3).alias("container"),
        F.struct("s_suppkey", member.alias("xml")).alias("member"),
    )

    def inside(number: int, tag: str) -> Column:
        found = F.array_sort(F.collect_list(F.when(F.col("container") == number, F.col("member"))))
        texts = F.array_join(F.transform(found, lambda m: m["xml"]), "")
        return _text(f"<{tag}>", texts, f"</{tag}>")

    body = _text(
        "<DescribeAlarmsResponse><DescribeAlarmsResult>",
        inside(0, "MetricAlarms"), inside(1, "CompositeAlarms"), inside(2, "LogAlarms"),
        "<NextToken>t", F.col("page_no") + 1, "</NextToken></DescribeAlarmsResult></DescribeAlarmsResponse>",
    )
    asked_for = placed.groupBy("state", "page_no").agg(body.alias("body"))
    # Two empty pages with a token that came before end each state's pages; the one after them does not count.
    late = _text("<MetricAlarms><member><AlarmName>late</AlarmName><StateValue>", F.col("state"), "</StateValue></member></MetricAlarms>")
    after = placed.select("state").distinct().select("state", F.explode(F.sequence(F.lit(10**9).cast("long"), F.lit(10**9 + 2).cast("long"))).alias("page_no"))
    after = after.withColumn("body", _text(
        "<DescribeAlarmsResponse><DescribeAlarmsResult>", F.when(F.col("page_no") == 10**9 + 2, late).otherwise(""),
        "<NextToken>t1</NextToken></DescribeAlarmsResult></DescribeAlarmsResponse>",
    ))
    return asked_for.unionByName(after)


def graph_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Service-graph pages: nations are services, trade between them gives the edges.

    Nation 24 is known only as an alias, nations from 20 on have one, nation 3 appears twice, and trade within a nation has
    no statistics.
    """
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    buyers = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    trade = (
        lines.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("s_nationkey", "c_nationkey")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("errors"),
            F.count(F.when(F.col("l_returnflag") == "A", 1)).alias("faults"),
            F.count(F.when(F.col("l_linestatus") == "O", 1)).alias("throttled"),
            F.sum("l_quantity").cast("long").alias("quantity"),
        )
    )
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("buyer"), F.col("n_name").alias("buyer_name"), F.col("n_regionkey").alias("region")
    )
    edge = _text(
        '{"ReferenceId":', F.col("buyer"),
        F.when(F.col("region") == 0, ',"EdgeType":"queue"').when(F.col("region") == 1, ',"Type":"stream"').otherwise(""),
        F.when(F.col("s_nationkey") == F.col("buyer"), "").otherwise(
            _text(
                ',"SummaryStatistics":{"TotalCount":', F.col("total"), ',"TotalResponseTime":', F.col("quantity"),
                ',"ErrorStatistics":{"TotalCount":', F.col("errors"), ',"ThrottleCount":', F.col("throttled"),
                '},"FaultStatistics":{"TotalCount":', F.col("faults"), ',"ThrottleCount":1}}',
            )
        ),
        F.when(F.col("buyer") < 20, "").otherwise(
            _text(',"Aliases":[{"Name":"alias ', F.col("buyer_name"), '","Type":"external"}]')
        ),
        "}",
    )
    edges = (
        trade.join(nation, F.col("c_nationkey") == F.col("buyer"))
        .groupBy("s_nationkey")
        .agg(F.array_join(F.array_sort(F.collect_list(edge)), ",").alias("edges"))
    )
    sellers = table(spark, sf_dir, "nation").filter(F.col("n_nationkey") < 24)
    service = _text(
        '{"ReferenceId":', F.col("n_nationkey"), ',"Name":"', F.col("n_name"), '","Type":"nation","State":"active",',
        '"Root":', F.when(F.col("n_regionkey") == 0, "true").otherwise("false"), ',"AccountId":"00', F.col("n_nationkey"),
        '","StartTime":', F.lit(EPOCH_2024 // 1000), ',"Names":["', F.col("n_name"), '"],"Edges":[',
        F.coalesce("edges", F.lit("")), "]}",
    )
    services = sellers.join(edges, F.col("n_nationkey") == F.col("s_nationkey"), "left").select(
        (F.col("n_nationkey") % 5).alias("page_no"), F.col("n_nationkey").alias("at"), service.alias("service")
    )
    # An older entry for nation 3 comes first on its page and loses.
    older = sellers.filter(F.col("n_nationkey") == 3).select(
        F.lit(0).alias("page_no"), F.lit(-1).alias("at"), F.lit('{"ReferenceId":3,"Name":"older"}').alias("service")
    )
    listed = F.array_sort(F.collect_list(F.struct("at", "service")))
    # The fifth page names the second again, so that the pages after it, which would rename nation 3, don't count.
    token = F.when(F.col("page_no") == 4, "t1").otherwise(_text("t", F.col("page_no") + 1))
    body = _text(
        '{"Services":[', F.array_join(F.transform(listed, lambda s: s["service"]), ","), '],"NextToken":"', token, '"}'
    )
    late = sellers.filter(F.col("n_nationkey").isin(3, 4)).select(
        (F.col("n_nationkey") + 2).cast("int").alias("page_no"), F.col("n_nationkey").alias("at"),
        F.lit('{"ReferenceId":3,"Name":"late"}').alias("service"),
    )
    pages = services.unionByName(older).unionByName(late).groupBy("page_no").agg(body.alias("body"))
    return pin(pages.select(F.lit("graph").alias("request_id"), "page_no", "body"), "graph-pages")

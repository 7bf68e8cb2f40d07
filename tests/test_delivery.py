import json
import math

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from beaconlake import schemas
from beaconlake.operators import batching, delivery
from beaconlake.sources import bodies

NOW = 1_700_000_000_000


def _bodies(spark, *texts):
    return spark.createDataFrame([(i, NOW, t) for i, t in enumerate(texts)], "body_seq long, received_ms long, body string")


def test_any_table_becomes_events(spark):
    logs = spark.createDataFrame([(0, 5_000_000, "b", "m"), (1, None, None, "m")],
                                 "n long, TIME_UNIX_NANO long, Body string, message string")
    found = delivery.to_put_events(logs, "/g", "s", "n", now=NOW).collect()
    assert [tuple(r) for r in found] == [(0, "/g", "s", 5, "b"), (1, "/g", "s", NOW, "")]
    with pytest.raises(ValueError, match="character other"):
        delivery.to_put_events(logs, "/g g", "s", "n")
    with pytest.raises(ValueError, match="a colon"):
        delivery.to_put_events(logs, "/g", "a*", "n")
    with pytest.raises(Exception, match="over 512"):
        delivery.to_put_events(logs, F.lit("x" * 513), "s", "n").collect()
    with pytest.raises(Exception, match="missing or empty"):
        delivery.validate_put(delivery.to_put_events(logs, "/g", "s", "n", now=NOW)).collect()
    kept = delivery.validate_put(delivery.to_put_events(logs, "/g", "s", "n", now=NOW), raise_on_bad=False)
    assert [r.problem is None for r in kept.orderBy("seq").collect()] == [True, False]


def test_rows_without_a_struct_have_no_status(spark):
    rows = spark.sql("SELECT * FROM VALUES (0, named_struct('message', 'a')), (1, NULL) AS t(n, row)")
    sent = delivery.to_put_events(rows, "/g", "s", "n", struct="row", now=NOW)
    planned = batching.plan_log_batches(delivery.validate_put(sent))
    answers = delivery.encode_log_batches(planned).withColumn("body", F.lit("{}"))
    status = delivery.put_status(rows.select(F.col("n").alias("seq")), delivery.reconcile_put(planned, answers))
    assert {r.seq: r.status for r in status.collect()} == {0: "ok", 1: None}


def _planned(spark, count=12):
    rows = [("/g", "s", i, i, f"m{i}") for i in range(count)]
    events = spark.createDataFrame(rows, "log_group string, log_stream string, timestamp_ms long, seq long, message string")
    return batching.plan_log_batches(events)


@pytest.mark.parametrize(
    "answer, expected",
    [
        ("{}", ["ok"] * 12),
        (
            '{"rejectedLogEventsInfo":{"expiredLogEventEndIndex":1,"tooOldLogEventEndIndex":2,"tooNewLogEventStartIndex":9}}',
            ["expired"] * 2 + ["too_old"] + ["ok"] * 6 + ["too_new"] * 3,
        ),
        ('{"rejectedEntityInfo":{"errorType":"InvalidEntity"}}', ["entity_rejected"] * 12),
    ],
)
def test_rejections(spark, answer, expected):
    planned = _planned(spark)
    answers = spark.createDataFrame([("/g", "s", 0, answer)], "log_group string, log_stream string, batch_no long, body string")
    found = delivery.reconcile_put(planned, answers).orderBy("seq").collect()
    assert [r.status for r in found] == expected
    if expected[0] != "ok":
        with pytest.raises(Exception, match="partially accepted"):
            delivery.reconcile_put(planned, answers, raise_on_reject=True).collect()
    missing = answers.filter("batch_no = 5")
    assert {r.status for r in delivery.reconcile_put(planned, missing).collect()} == {None}


def test_log_bodies_round_trip(spark, tmp_path):
    texts = ['quote " newline\n and é', "tab\t\\", "😀", " "]
    rows = [("/g", "s", 10 - i, i, t) for i, t in enumerate(texts)]
    events = spark.createDataFrame(rows, "log_group string, log_stream string, timestamp_ms long, seq long, message string")
    encoded = delivery.encode_log_batches(batching.plan_log_batches(events, max_events=3))
    path = str(tmp_path / "out")
    delivery.write_batches(encoded, path)
    landed = spark.read.json(path)
    assert landed.count() == 2
    received, dead = bodies.decode_put_log_bodies(
        landed.select(F.col("batch_no").alias("body_seq"), F.lit(NOW).alias("received_ms"), "body")
    )
    assert dead.count() == 0 and received.schema.simpleString() == schemas.RAW_EVENTS.simpleString()
    found = received.orderBy("event_id").collect()
    assert [(r.message, r.timestamp_ms) for r in found] == [(t, 10 - i) for i, t in reversed(list(enumerate(texts)))]
    assert found[0].event_id == "0" * 29 and found[3].event_id == "00000000000000000010000000000"


@pytest.mark.parametrize(
    "body, reason",
    [
        ("x", "not a JSON object"),
        ("[1]", "not a JSON object"),
        ('{"logGroupName":"/g","logEvents":[]}', "no log group or no log stream"),
        ('{"logGroupName":"","logStreamName":"s","logEvents":[]}', "no log group or no log stream"),
        ('{"logGroupName":"/g","logStreamName":"s"}', "no array of events"),
        ('{"logGroupName":"/g","logStreamName":"s","logEvents":{"a":1}}', "no array of events"),
        ('{"logGroupName":"/g","logStreamName":"s","logEvents":[{"numeric time":"1","message":"m"}]}', "timestamp"),
        ('{"logGroupName":"/g","logStreamName":"s","logEvents":[{"timestamp":1,"message":"m"},{"timestamp":1}]}', "message"),
        ('{"logGroupName":"/g","logStreamName":"s","logEvents":[{"timestamp":1,"message":5}]}', "message"),
    ],
)
def test_bad_log_bodies(spark, body, reason):
    good = '{"logGroupName":"/g","logStreamName":"s","logEvents":[{"timestamp":1,"message":"m"}]}'
    received, dead = bodies.decode_put_log_bodies(_bodies(spark, body, good))
    assert [r.message for r in received.collect()] == ["m"]
    assert [r.body_seq for r in dead.collect()] == [0] and reason in dead.first().reason


GAUGES = "n long, name string, double_value string, timestamp long, unit string, service_name string, attributes string"


def test_gauges_become_data_points(spark):
    gauges = spark.createDataFrame(
        [(0, "m", "1.5", 60, "ms", "svc", '{"k":"v","n":1}'), (1, "m", None, 1, None, None, "broken"), (2, "m", "x", 1, "", "", ""),
         (3, "m", "2", None, "{req}", "", None)],
        GAUGES,
    )
    found = delivery.to_metric_data(gauges, "my/ns", "n", now=NOW).orderBy("seq").collect()
    assert [(r.seq, r.value, r.timestamp_seconds, r.unit) for r in found] == [
        (0, 1.5, 60, "Milliseconds"), (3, 2.0, NOW // 1000, "Count"),
    ]
    assert [tuple(d) for d in found[0].dimensions] == [("service.name", "svc"), ("k", "v")]
    sized = delivery.to_metric_data(gauges, "my/ns", "n", now=NOW).select("seq", delivery.datum_bytes().alias("b"))
    assert {r.seq: r.b for r in sized.collect()} == {0: 200 + 1 + 12 + 240 + 12 + 3 + 1 + 1, 3: 200 + 1 + 5}


@pytest.mark.parametrize(
    "row, message",
    [
        ((0, "", "1", 1, "", "", ""), "metric has no name"),
        ((0, None, None, 1, "", "", ""), "metric has no name"),
        ((0, "m", "1", 1, "", "", "{"), "read as JSON"),
        ((0, "m", "Infinity", 1, "", "", ""), "finite"),
        ((0, "m", "1", 1, "", "s", json.dumps({str(i): "v" for i in range(30)})), "over 30 dimensions"),
    ],
)
def test_bad_gauges(spark, row, message):
    with pytest.raises(Exception, match=message):
        delivery.to_metric_data(spark.createDataFrame([row], GAUGES), "ns", "n").collect()


def test_gauge_columns_and_namespace(spark):
    with pytest.raises(ValueError, match="'double_value' or 'value'"):
        delivery.to_metric_data(spark.createDataFrame([(1, "m")], "n long, name string"), "ns", "n")
    with pytest.raises(ValueError, match="'name' or 'metric_name'"):
        delivery.to_metric_data(spark.createDataFrame([(1, 1.0)], "n long, value double"), "ns", "n")
    for namespace in ("AWS/EC2", ""):
        with pytest.raises(ValueError, match="namespace"):
            delivery.to_metric_data(spark.createDataFrame([(1, "m", 1.0)], "n long, name string, value double"), namespace, "n")


def test_metric_bodies_round_trip(spark):
    values = [0.1, 1e300, -2.5e-12, 3.0, 123456789012345680.0, 1 / 3]
    rows = [(i, "a&b=c %~*+é", str(v), i, "s", "x/y", '{"k k":"v&w","k k":"last"}') for i, v in enumerate(values)]
    data = delivery.to_metric_data(spark.createDataFrame(rows, GAUGES), "my/ns", "n")
    encoded = delivery.encode_metric_batches(batching.plan_metric_batches(data, max_data=4))
    texts = [r.body for r in encoded.orderBy("batch_no").collect()]
    assert len(texts) == 2 and texts[0].startswith("Action=PutMetricData&Version=2010-08-01&Namespace=my%2Fns&MetricData.member.1.")
    assert "a%26b%3Dc%20%25~%2A%2B%C3%A9" in texts[0] and "Timestamp=1970-01-01T00%3A00%3A01Z" in texts[0]
    points, dead = bodies.decode_put_metric_bodies(_bodies(spark, *texts))
    assert dead.count() == 0 and points.schema.simpleString() == schemas.RAW_METRICS.simpleString()
    found = points.orderBy("timestamp_ms").collect()
    assert [r.value for r in found] == values and [r.timestamp_ms for r in found] == [i * 1000 for i in range(6)]
    assert {r.metric_name for r in found} == {"a&b=c %~*+é"} and {r.unit for r in found} == {"Seconds"}
    assert found[0].dimensions == {"service.name": "x/y", "k k": "v&w"}


def test_form_bodies(spark):
    m = "MetricData.member."
    good = (
        f"Namespace=first&Namespace=ns&{m}2.MetricName=b&{m}2.Value=2&{m}1.MetricName=a&{m}1.Value=1&{m}1.Value=1.5"
        f"&{m}1.Timestamp=2024-01-01T00%3A00%3A00Z&{m}1.Unit=Count&{m}4.MetricName=d&{m}4.Value=4&novalue"
        f"&{m}1.Dimensions.member.1.Name=x+y&{m}1.Dimensions.member.1.Value=%2F&{m}1.Dimensions.member.2.Name=lost"
        f"&{m}1.Dimensions.member.3.Name=n&{m}1.Dimensions.member.3.Value=v"
    )
    points, dead = bodies.decode_put_metric_bodies(_bodies(spark, good))
    assert dead.count() == 0
    assert [tuple(r) for r in points.orderBy("metric_name").collect()] == [
        ("ns", "a", 1_704_067_200_000, 1.5, "Count", {"x y": "/"}),
        ("ns", "b", NOW, 2.0, "None", {}),
    ]


@pytest.mark.parametrize(
    "body, reason",
    [
        ("", "namespace"),
        ("Namespace=&MetricData.member.1.MetricName=a&MetricData.member.1.Value=1", "namespace"),
        ("Namespace=n", "no data point"),
        ("Namespace=n&MetricData.member.2.MetricName=a&MetricData.member.2.Value=1", "no data point"),
        ("Namespace=n&MetricData.member.1.MetricName=a", "has no value"),
        ("Namespace=n&MetricData.member.1.MetricName=a&MetricData.member.1.Value=1&MetricData.member.2.MetricName=b", "has no value"),
        ("Namespace=n&MetricData.member.1.MetricName=a&MetricData.member.1.Value=x", "not a number"),
        ("Namespace=n&MetricData.member.1.MetricName=a&MetricData.member.1.Value=1&MetricData.member.1.Timestamp=x", "timestamp"),
        ("Namespace=n&MetricData.member.1.MetricName=%zz&MetricData.member.1.Value=1", "escape"),
    ],
)
def test_bad_form_bodies(spark, body, reason):
    points, dead = bodies.decode_put_metric_bodies(_bodies(spark, body))
    assert points.count() == 0 and reason in dead.first().reason


def test_form_bodies_are_judged_row_by_row(spark):
    """A body without text, one that came twice under its number, and numbers that are none; and no shuffle."""
    m = "MetricData.member."
    good = f"Namespace=n&{m}1.MetricName=a&{m}1.Value=1&{m}0.MetricName=x&{m}01.MetricName=y&{m}1.Dimensions.member.0.Name=z"
    rows = [(1, NOW, None), (2, NOW, good), (2, NOW + 1, good), (None, NOW, "a=%")]
    landed = spark.createDataFrame(rows, "body_seq long, received_ms long, body string")
    points, dead = bodies.decode_put_metric_bodies(landed)
    assert sorted(tuple(r) for r in points.collect()) == [("n", "a", NOW + i, 1.0, "None", {}) for i in (0, 1)]
    assert sorted((r.body_seq or 0, r.reason) for r in dead.collect()) == [(0, "the body has an invalid escape"), (1, "the body names no namespace")]
    for found in (points, dead):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("MapInArrow") == 1


def test_form_bodies_are_taken_apart_a_few_at_a_time(monkeypatch):
    """A part ends before the bytes do; a body that is larger is one; and none is lost."""
    texts = [None, "", "Namespace=n" * 3, "x" * 90, "x" * 50, "x" * 50, "x" * 51, "x" * 500, None, "x"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(10)), pa.array([NOW] * 10), pa.array(texts)], ["body_seq", "received_ms", "body"])
    monkeypatch.setattr(bodies, "_PART_BYTES", 101)
    for given in (batch, batch.slice(2), batch.slice(0, 0)):
        read = [*bodies._read_forms(iter([given]))]
        assert all(b.num_rows == 1 or sum(len(t or "") for t in b["body"].to_pylist()) <= 101 for b in read)
        assert [t for b in read for t in b["body"].to_pylist()] == given["body"].to_pylist()
    sizes = [b.num_rows for b in bodies._read_forms(iter([batch]))]
    assert sizes == [3, 1, 2, 1, 1, 2]


def test_late_rows(spark):
    rows = spark.createDataFrame([(89,), (90,), (105,), (106,)], "timestamp_ms long")
    accepted, late = delivery.split_late(rows, 100, 10, 5)
    assert [r[0] for r in accepted.collect()] == [90, 105]
    assert [tuple(r) for r in late.collect()] == [(89, "too_old"), (106, "too_new")]


def test_numbers_read_back(spark):
    values = [0.1, 1e22, 5e-324, -0.5, 1e15, 999999999999999.0]
    texts = spark.createDataFrame([(v,) for v in values], "v double").select(delivery._number(F.col("v"))).collect()
    assert [float(r[0]) for r in texts] == values and not any(math.isnan(float(r[0])) for r in texts)


@pytest.mark.parametrize(
    "body, status",
    [
        ("<html>", "unreadable_response"), (None, "unreadable_response"), ("", "unreadable_response"), ("[1]", "unreadable_response"),
        ('"ok"', "unreadable_response"), ('{"rejectedLogEventsInfo":7}', "unreadable_response"),
        ('{"rejectedLogEventsInfo":[]}', "unreadable_response"), ('{"rejectedEntityInfo":"x"}', "unreadable_response"),
        ('{"rejectedLogEventsInfo":{"tooOldLogEventEndIndex":"0"}}', "unreadable_response"),
        ('{"rejectedLogEventsInfo":{"tooOldLogEventEndIndex":0.5}}', "unreadable_response"),
        ("{}", "ok"), ('{"rejectedLogEventsInfo":null,"rejectedEntityInfo":null}', "ok"),
        ('{"rejectedLogEventsInfo":{"tooOldLogEventEndIndex":0}}', "too_old"), ('{"rejectedEntityInfo":{}}', "entity_rejected"),
    ],
)
def test_answers_that_say_nothing_are_not_taken_for_delivery(spark, body, status):
    planned = spark.createDataFrame([("g", "s", 0, 0, 1)], "log_group string, log_stream string, batch_no int, index_in_batch int, seq long")
    answers = spark.createDataFrame([("g", "s", 0, body)], "log_group string, log_stream string, batch_no int, body string")
    assert [r.status for r in delivery.reconcile_put(planned, answers).collect()] == [status]


def test_two_answers_to_one_batch_raise(spark):
    planned = spark.createDataFrame([("g", "s", 0, 0, 1)], "log_group string, log_stream string, batch_no int, index_in_batch int, seq long")
    answers = spark.createDataFrame([("g", "s", 0, "{}")] * 2, "log_group string, log_stream string, batch_no int, body string")
    with pytest.raises(Exception, match="more than one response"):
        delivery.reconcile_put(planned, answers).collect()

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from beaconlake.functions import attributes, checks, times

NOW = 1_700_000_000_000

TIMES = {
    "now": NOW,
    " NOW ": NOW,
    "-15m": NOW - 900_000,
    "-2H": NOW - 7_200_000,
    "-1w": NOW - 604_800_000,
    "1700000000000": 1_700_000_000_000,
    "0": 0,
    "2024-01-01": 1_704_067_200_000,
    "2024-01-01 10:00": 1_704_103_200_000,
    "2024-01-01T10:00:00.5Z": 1_704_103_200_500,
    "2024-01-01T10:00:00+02": 1_704_096_000_000,
    "2024-01-01T10:00:00 +0530": 1_704_083_400_000,
    "-99999999999999999999w": None,
    "-5x": None,
    "1960-01-01": None,
    "2024-13-01": None,
    "bad": None,
    "": None,
}


def test_time_texts(spark):
    rows = spark.createDataFrame([(t,) for t in TIMES], "t string")
    found = rows.select(
        "t",
        times.parse_time(F.col("t"), NOW).alias("ms"),
        times.time_problem(F.col("t"), NOW, "start_time").alias("problem"),
    ).collect()
    assert {r.t: r.ms for r in found} == TIMES
    assert all((r.problem is None) == (r.ms is not None) for r in found)


def test_time_options_follow_the_same_rules():
    for text, ms in TIMES.items():
        if ms is None:
            with pytest.raises(ValueError, match="start_time"):
                times.time_option(text, NOW, "start_time")
        else:
            assert times.time_option(text, NOW, "start_time") == ms
    assert times.time_option(datetime(2024, 1, 1), NOW, "x") == 1_704_067_200_000


def test_event_and_metric_time(spark):
    rows = spark.createDataFrame([(7_999_999, 5_000_000), (None, 5_000_000), (None, None)],
                                 "Time_Unix_Nano long, observed_time_unix_nano long")
    assert [r[0] for r in rows.select(times.event_time(rows, 99)).collect()] == [7, 5, 99]
    stamps = spark.createDataFrame([(42,), (None,)], "timestamp long")
    assert [r[0] for r in stamps.select(times.event_time(stamps, 9_000)).collect()] == [42, 9_000]
    assert [r[0] for r in stamps.select(times.metric_time(stamps, 9_000)).collect()] == [42, 9]
    nanos = spark.createDataFrame([(3_999_999_999,)], "time_unix_nano long")
    assert nanos.select(times.metric_time(nanos, 0)).first()[0] == 3
    texts = spark.createDataFrame([("2024-01-01T00:00:01.5Z",), ("x",)], "timestamp string")
    assert [r[0] for r in texts.select(times.event_time(texts, 9)).collect()] == [1_704_067_201_500, 9]


def test_ms_to_time_bounds(spark):
    rows = spark.createDataFrame([(-1,), (0,), (1_700_000_000_123,), (10**16,)], "ms long")
    found = [r[0] for r in rows.select(times.ms_to_time(F.col("ms"))).collect()]
    assert found == [None, datetime(1970, 1, 1), datetime(2023, 11, 14, 22, 13, 20, 123000), None]


def test_units(spark):
    given = {
        "s": "Seconds", "ms": "Milliseconds", "us": "Microseconds", "By": "Bytes", "bytes": "Bytes", "KiBy": "Kilobytes",
        "MiBy": "Megabytes", "GiBy": "Gigabytes", "Bi": "Bits", "%": "Percent", "1": "None", "": "None", "{req}": "Count",
        "{": "None", "ns": "None", "S": "None", None: "None",
    }
    rows = spark.createDataFrame([(u,) for u in given], "u string")
    assert {r[0]: r[1] for r in rows.select("u", attributes.translate_unit(F.col("u"))).collect()} == given


def test_metric_dimensions_keep_order_and_repeats(spark):
    rows = spark.createDataFrame(
        [("svc", '{"z":"1","a":5,"b":"x","o":{"q":1},"n":null,"z":"2"}'), ("", "[1]"), (None, None)],
        "service_name string, attributes string",
    )
    found = rows.select(attributes.metric_dimensions(rows).alias("d")).collect()
    assert [tuple(p) for p in found[0].d] == [("service.name", "svc"), ("z", "1"), ("b", "x"), ("z", "2")]
    assert found[1].d == [] and found[2].d == []
    first = rows.select(attributes.first_wins_map(attributes.metric_dimensions(rows)).alias("m")).first().m
    assert first == {"service.name": "svc", "z": "1", "b": "x"}


def test_dimension_keys_ignore_map_order(spark):
    rows = spark.sql("SELECT map('a', '1', 'b', '2') AS x, map('b', '2', 'a', '1') AS y")
    x, y = rows.select(attributes.dimensions_key(F.col("x")), attributes.dimensions_key(F.col("y"))).first()
    assert x == y == '{"a":"1","b":"2"}'


def test_attribute_texts(spark):
    row = spark.range(1).select(
        attributes.resource_attributes("us-east-1", F.lit("/aws/lambda/orders"), F.lit("stream-a")).alias("a"),
        attributes.resource_attributes("", F.lit("g"), F.lit("")).alias("b"),
        attributes.log_attributes(F.lit("ev-7")).alias("c"),
        attributes.log_attributes(F.lit("")).alias("d"),
        attributes.event_id(F.lit(5), F.lit(3)).alias("e"),
    ).first()
    assert row.a == (
        '{"cloud.provider":"aws","cloud.region":"us-east-1","aws.log.group.names":["/aws/lambda/orders"],'
        '"aws.log.stream.names":["stream-a"]}'
    )
    assert row.b == '{"cloud.provider":"aws","aws.log.group.names":["g"]}'
    assert row.c == '{"aws.cloudwatch.log.event_id":"ev-7"}' and row.d is None
    assert row.e == "00000000000000000050000000003"


def _reasons(spark, check, values, kind="string"):
    rows = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in rows.select(check(F.col("v"))).collect()]


def test_name_checks(spark):
    group = _reasons(spark, checks.check_group_name, ["/app/a-b_c.d#1", "", None, "a" * 512, "a" * 513, "a b", "é", "a\n"])
    assert [r is None for r in group] == [True, False, False, True, False, False, False, False]
    stream = _reasons(spark, checks.check_stream_name, ["a b é", "", "a:b", "a*", "é" * 256, "é" * 257])
    assert [r is None for r in stream] == [True, False, False, False, True, False]
    space = _reasons(spark, checks.check_namespace, ["my/ns", "AWS/EC2", "", "a b", "é", "x" * 255, "x" * 256])
    assert [r is None for r in space] == [True, False, False, False, False, True, False]
    days = _reasons(spark, checks.check_retention, [1, 3653, 2, 0, -1], "long")
    assert [r is None for r in days] == [True, True, False, False, False]


def test_message_bounds(spark):
    limit = checks.MAX_BATCH_BYTES - checks.EVENT_OVERHEAD
    found = _reasons(spark, checks.check_message, ["x", "", "y" * limit, "y" * (limit + 1), "é" * (limit // 2 + 1)])
    assert [r is None for r in found] == [True, False, True, False, False]
    text = spark.createDataFrame([('quote " newline\n and é',)], "t string")
    assert text.select(F.octet_length("t")).first()[0] == 23


def test_metric_check(spark):
    def reason(name, value, pairs, text):
        dims = F.array(*[F.struct(F.lit(str(i)).alias("name"), F.lit("v").alias("value")) for i in range(pairs)])
        problem = checks.check_metric(F.lit(name), F.lit(value), dims, F.lit(text))
        return spark.range(1).select(problem).first()[0]

    assert reason("n", 1.0, 30, '{"a":"b","a":"c"}') is None
    assert "name" in reason("", 1.0, 0, "")
    assert "30" in reason("n", 1.0, 31, "")
    assert "JSON" in reason("n", 1.0, 0, '{"a":1}}')
    assert "finite" in reason("n", float("nan"), 0, "") and "finite" in reason("n", float("-inf"), 0, "")


def test_metric_age(spark):
    rows = spark.createDataFrame([(NOW - 14 * 86_400_000,), (NOW - 14 * 86_400_000 - 1,), (NOW + 7_200_001,)], "t long")
    assert [r[0] for r in rows.select(checks.check_metric_age(F.col("t"), NOW)).collect()] == [None, "too_old", "too_new"]

import pytest
from pyspark.sql import functions as F

from beaconlake import schemas
from beaconlake.operators import ordering
from beaconlake.sources import logs
from beaconlake.streaming import tables

NOW = 1_754_900_000_000


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        ("/svc/trip", "main", 1_741_100_000_000 + i * 1000, 1_741_100_000_500, f"{i:019d}", f"entry-{i}")
        for i in range(3)
    ]
    rows += [
        ("/svc/trip", "other", 1_741_100_000_000, -1, "", ""),
        ("/app/else", "main", 1_741_100_000_000, 0, "9", "entry-1"),
    ]
    return spark.createDataFrame(rows, schemas.RAW_EVENTS)


def scan(events, **options):
    return logs.logs_scan(events, "/svc/trip", start=1_741_000_000_000, end=NOW, now=NOW, **options)


def test_round_trip_values(events):
    assert [r.body for r in scan(events, streams=["main"], order="asc").collect()] == ["entry-0", "entry-1", "entry-2"]
    assert [r.body for r in scan(events, streams=["main"]).collect()] == ["entry-2", "entry-1", "entry-0"]
    assert scan(events, filter="entry-1").count() == 1
    assert scan(events, filter=' "entry-1" ', max_rows=5).count() == 1
    assert [r.body for r in scan(events, stream_prefix="ma", max_rows=1).collect()] == ["entry-2"]


def test_missing_values_become_null(events):
    row = scan(events, streams=["other"]).first()
    assert row.body is None and row.log_attributes is None and row.observed_time_unix_nano is None
    assert row.resource_attributes == (
        '{"cloud.provider":"aws","aws.log.group.names":["/svc/trip"],"aws.log.stream.names":["other"]}'
    )
    assert scan(events).schema.simpleString() == schemas.OTLP_LOGS.simpleString()


def test_bounds_are_half_open(events):
    start = 1_741_100_000_000
    assert logs.logs_scan(events, "/app/else", start=start, end=start + 1, now=NOW).count() == 1
    assert logs.logs_scan(events, "/app/else", start=start, end=start, now=NOW).count() == 0
    assert logs.where_time(events, start, 0).count() == 5
    assert logs.where_time(events, 0, 0).count() == 5
    assert logs.where_time(events, start + 1, 0).count() == 2


@pytest.mark.parametrize(
    "options, message",
    [
        ({"start": "now", "end": "-1h"}, "must not be after"),
        ({"start": "yesterday"}, "start_time"),
        ({"stream_prefix": "a", "streams": ["b"]}, "not both"),
        ({"streams": ["s"] * 101}, "over 100"),
        ({"streams": [""]}, "empty name"),
        ({"order": "up"}, "order"),
        ({"max_rows": -1}, "max_rows"),
        ({"filter": "{$.a = 1}"}, "substring"),
        ({"filter": "[a, b]"}, "substring"),
        ({"filter": "two words"}, "single-term"),
        ({"filter": "?term"}, "single-term"),
    ],
)
def test_bad_options(events, options, message):
    with pytest.raises(ValueError, match=message):
        logs.logs_scan(events, "/svc/trip", now=NOW, **options)


def test_wrong_table_is_refused(events):
    with pytest.raises(ValueError, match="message"):
        logs.logs_scan(events.drop("message"), "/svc/trip", now=NOW)
    with pytest.raises(ValueError, match="timestamp_ms must be bigint"):
        logs.logs_scan(events.withColumn("timestamp_ms", F.lit("x")), "/svc/trip", now=NOW)
    with pytest.raises(ValueError, match="name a log group"):
        logs.logs_scan(events, "", now=NOW)


def test_dated_table_is_pruned(spark, events, tmp_path):
    path = str(tmp_path / "events")
    tables.append_events(events, path)
    tables.append_events(events, path)
    read = tables.read_events(spark, path)
    assert read.count() == 10
    found = logs.where_group(logs.where_time(read, 1_741_100_000_000, 1_741_100_001_000), "/svc/trip").select("message")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "PushedFilters: [IsNotNull(timestamp_ms)" in plan
    assert "ReadSchema: struct<log_group:string,timestamp_ms:bigint,message:string>" in plan


def test_pages(spark):
    rows = [("g", "s", i // 4, 0, f"{i:03d}", str(i)) for i in range(25)]
    events = spark.createDataFrame(rows, schemas.RAW_EVENTS)
    seen, offset = [], 0
    while True:
        page = ordering.event_page(events, limit=10, offset=str(offset), ascending=True).collect()
        seen += [int(r.message) for r in page]
        offset += len(page)
        if not page[0].has_more:
            break
    assert seen == list(range(25))
    last, keyed = (None, None), []
    while True:
        page = ordering.event_page_after(events, *last, limit=10, ascending=False).collect()
        keyed += [int(r.message) for r in page]
        last = (page[-1].timestamp_ms, page[-1].event_id)
        if not page[0].has_more:
            break
    assert keyed == list(range(24, -1, -1))
    assert len(ordering.event_page(events, limit=0).collect()) == 1
    for token in ("x", -1):
        with pytest.raises(ValueError, match="token"):
            ordering.event_page(events, offset=token)


def test_deep_pages_are_cut_by_position(spark, monkeypatch):
    rows = [("g", "s", i // 7, 0, f"{i:04d}", str(i)) for i in range(1000)]
    events = spark.createDataFrame(rows, schemas.RAW_EVENTS).repartition(5)
    monkeypatch.setattr(ordering, "TOP_ROWS", 10)
    page = ordering.event_page(events, limit=20, offset=700, ascending=False).orderBy("timestamp_ms", "event_id").collect()
    assert sorted(int(r.message) for r in page) == list(range(280, 300)) and page[0].has_more
    page = ordering.event_page(events, limit=20, offset=990, ascending=True).collect()
    assert sorted(int(r.message) for r in page) == list(range(990, 1000)) and not page[0].has_more


@pytest.mark.parametrize("parts", [1, 3, 11])
def test_positions(spark, parts):
    rows = [(None if i % 3 == 0 else ("hot" if i % 3 == 1 else f"k{i % 5}"), i * 37 % 101, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, t long, i long").repartition(parts)
    found = ordering.with_position(df, ["k"], [F.col("t").desc(), F.col("i").asc()]).toPandas()
    expected = found.sort_values(["t", "i"], ascending=[False, True]).groupby("k", dropna=False).cumcount()
    assert (expected.reindex(found.index) == found.position).all() and len(found) == 2000


def test_decode_pages(spark):
    body = (
        '{"events":[{"eventId":"entry-1","ingestionTime":1700000000123,"logStreamName":"stream-a","message":"hello",'
        '"timestamp":1700000000000},{"message":"bare"}],"nextToken":"token-2"}'
    )
    pages = spark.createDataFrame([(1, body), (2, '{"events":[]}'), (3, "{}")], "page_no int, body string")
    found = logs.decode_log_pages(pages).orderBy("pos").collect()
    assert [tuple(r)[1:] for r in found] == [
        (0, "stream-a", 1_700_000_000_000, 1_700_000_000_123, "entry-1", "hello"),
        (1, "", -1, -1, "", "bare"),
    ]
    for bad in ("[1]", "x", '{"events":[]} x'):
        with pytest.raises(Exception, match="not a JSON object"):
            logs.decode_log_pages(spark.createDataFrame([(1, bad)], "page_no int, body string")).collect()


def test_body_fields_keep_the_body(spark):
    rows = spark.createDataFrame([('{"a":1,"b":"x"}',), ("plain",), (None,)], "body string")
    assert [tuple(r) for r in logs.body_fields(rows, "a long, b string").collect()] == [
        ('{"a":1,"b":"x"}', 1, "x"), ("plain", None, None), (None, None, None),
    ]


@pytest.mark.parametrize("ascending", [True, False])
def test_pages_of_repeated_keys_are_the_same_on_both_paths(spark, ascending):
    rows = [("g", "s", (i // 9) or None, 0, None if i % 4 == 0 else "id", str(i % 7)) for i in range(120)]
    events = spark.createDataFrame(rows, schemas.RAW_EVENTS).repartition(4)
    seen = {0: [], 10_000: []}
    for top in seen:
        for offset in range(0, 121, 25):
            page = ordering.event_page(events, limit=25, offset=offset, ascending=ascending, top_rows=top).collect()
            assert all(r.has_more == (offset + 25 < 120) for r in page)
            seen[top] += sorted(map(str, page))
    assert seen[0] == seen[10_000] and len(seen[0]) == 120


def test_members_that_are_no_text(spark):
    body = '{"events":[{"eventId":5,"logStreamName":{"x":1},"message":5,"timestamp":7},{"message":"m"}]}'
    found = logs.decode_log_pages(spark.createDataFrame([(1, body)], "page_no int, body string")).collect()
    assert [(r.event_id, r.log_stream, r.message, r.timestamp_ms) for r in found] == [("", "", "", 7), ("", "", "m", -1)]


def test_group_pages(spark):
    rows = [(1, '{"logGroups":[{"logGroupName":"/a"},{"logGroupName":7},{},{"logGroupName":"/b"}],"nextToken":"n"}'), (2, "{}")]
    found = logs.decode_group_pages(spark.createDataFrame(rows, "page_no int, body string")).collect()
    assert [(r.page_no, r.pos, r.log_group) for r in found] == [(1, 0, "/a"), (1, 3, "/b")]
    with pytest.raises(Exception, match="not a JSON object"):
        logs.decode_group_pages(spark.createDataFrame([(1, "[]")], "page_no int, body string")).collect()

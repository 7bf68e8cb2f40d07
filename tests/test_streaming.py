import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from beaconlake import schemas
from beaconlake.operators import batching, delivery, registry, statistics
from beaconlake.plans import queries
from beaconlake.streaming import batches, ingest, outcomes, rollup, tables


def _log_body(group, stream, *messages):
    return json.dumps({"logGroupName": group, "logStreamName": stream,
                       "logEvents": [{"timestamp": i * 86_400_000, "message": m} for i, m in enumerate(messages)]})


def test_log_intake(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([("/g", None, None, 1), ("/g", "s", None, 1)], schemas.REGISTRY).write.parquet(f"{root}/reg")

    def land(*rows):
        frame = spark.createDataFrame([(i, 7, b) for i, b in rows], ingest.BODIES)
        frame.coalesce(1).write.mode("append").parquet(f"{root}/in")

    def run():
        stream = spark.readStream.schema(ingest.BODIES).parquet(f"{root}/in")
        ingest.stream_ingest_logs(stream, f"{root}/reg", f"{root}/out", f"{root}/state").awaitTermination()

    land((1, _log_body("/g", "s", "a", "b")), (2, "broken"))
    run()
    land((3, _log_body("/g", "t", "c")), (4, _log_body("/g", "s", "d")))
    run()
    run()
    read = tables.read_events(spark, f"{root}/out/events")
    assert sorted(r.message for r in read.collect()) == ["a", "b", "d"]
    assert sorted(str(r.event_date) for r in read.collect()) == ["1970-01-01", "1970-01-01", "1970-01-02"]
    assert [r.message for r in spark.read.parquet(f"{root}/out/rejected").collect()] == ["c"]
    assert [r.body for r in spark.read.parquet(f"{root}/out/dead").collect()] == ["broken"]


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    rows = spark.createDataFrame([("/g", "s", 1, 1, "1", "m")], schemas.RAW_EVENTS)
    for _ in range(2):
        tables.write_batch(rows, str(tmp_path), 0)
    tables.write_batch(rows, str(tmp_path), 1)
    assert tables.read_events(spark, str(tmp_path)).count() == 2


def test_rollup_equals_the_batch_result(spark, tmp_path):
    root = str(tmp_path)
    rows = [("ns", "m", i * 1000, float(i % 7), "None", {"k": str(i % 3)}) for i in range(2000)]
    points = spark.createDataFrame(rows, schemas.RAW_METRICS)
    points.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(points.schema).parquet(f"{root}/in")
    found = rollup.stream_metric_rollup(stream, 60, "5 minutes")
    writer = found.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{root}/state")
    writer.trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    final = (1999 - 300) * 1000
    batch = statistics.metric_rollup(points, 60).filter(F.col("bucket_ms") + 60_000 <= final)
    got = {tuple(r) for r in spark.read.parquet(f"{root}/out").select(*batch.columns).collect()}
    assert got == {tuple(r) for r in batch.collect()} and got


def test_metric_intake(spark, tmp_path):
    root = str(tmp_path)
    body = "Namespace=ns&MetricData.member.1.MetricName=a&MetricData.member.1.Value=1"
    spark.createDataFrame([(1, 86_400_000, body), (2, 5, "x")], ingest.BODIES).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(ingest.BODIES).parquet(f"{root}/in")
    ingest.stream_ingest_metrics(stream, f"{root}/out", f"{root}/state").awaitTermination()
    row = tables.read_metrics(spark, f"{root}/out/metrics").first()
    assert (row.metric_name, row.value, str(row.event_date)) == ("a", 1.0, "1970-01-02")
    assert spark.read.parquet(f"{root}/out/dead").first().body_seq == 2


def test_two_checkpoints_into_one_folder_keep_both(spark, tmp_path):
    root = str(tmp_path)
    for n in (1, 2):
        body = f"Namespace=ns&MetricData.member.1.MetricName=m{n}&MetricData.member.1.Value=1"
        spark.createDataFrame([(n, 86_400_000, body)], ingest.BODIES).write.parquet(f"{root}/in{n}")
        stream = spark.readStream.schema(ingest.BODIES).parquet(f"{root}/in{n}")
        for _ in range(2):
            ingest.stream_ingest_metrics(stream, f"{root}/out", f"{root}/state{n}").awaitTermination()
    found = tables.read_metrics(spark, f"{root}/out/metrics").collect()
    assert sorted(r.metric_name for r in found) == ["m1", "m2"]


def test_open_periods_of_a_bounded_input_come_out(spark, tmp_path):
    root = str(tmp_path)
    rows = [("ns", "m", i * 1000, float(i % 7), "None", {"k": str(i % 3)}) for i in range(500)]
    points = spark.createDataFrame(rows, schemas.RAW_METRICS)
    points.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(points.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    found = rollup.stream_metric_rollup(stream, 60, "5 hours")
    rollup.write_periods(found, f"{root}/out", f"{root}/state").awaitTermination()
    batch = statistics.metric_rollup(points, 60)
    got = {tuple(r) for r in rollup.read_periods(spark, f"{root}/out").select(*batch.columns).collect()}
    assert got == {tuple(r) for r in batch.collect()} and got


def test_two_checkpoints_into_one_folder_keep_the_periods_of_both(spark, tmp_path):
    root = str(tmp_path)
    for n in (1, 2):
        rows = [("ns", m, i * 1000, float(i * n), "None", {}) for m in (f"m{n}", "both") for i in range(100)]
        points = spark.createDataFrame(rows, schemas.RAW_METRICS)
        points.write.parquet(f"{root}/in{n}")
        stream = spark.readStream.schema(points.schema).parquet(f"{root}/in{n}")
        for _ in range(2):
            found = rollup.stream_metric_rollup(stream, 60, "5 hours")
            rollup.write_periods(found, f"{root}/out", f"{root}/state{n}").awaitTermination()
    got = {(r.metric_name, r.bucket_ms): r for r in rollup.read_periods(spark, f"{root}/out").collect()}
    assert set(got) == {(m, b) for m in ("m1", "m2", "both") for b in (0, 60_000)}
    assert got["m2", 0]["sum"] == 2 * got["m1", 0]["sum"] and got["both", 0]["sum"] == 3 * got["m1", 0]["sum"]
    both = got["both", 0]
    assert both.sample_count == 120 and both.average == both["sum"] / 120 and (both.minimum, both.maximum) == (0.0, 118.0)


def _intake(spark, root, **how):
    stream = spark.readStream.schema(ingest.BODIES).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    ingest.stream_ingest_logs(stream, f"{root}/reg", f"{root}/out", f"{root}/state", **how).awaitTermination()


def _land(spark, root, *rows):
    spark.createDataFrame([(i, ms, b) for i, ms, b in rows], ingest.BODIES).coalesce(1).write.mode("append").parquet(f"{root}/in")


def test_redelivered_bodies_land_once(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([("/g", None, None, 1), ("/g", "s", None, 1)], schemas.REGISTRY).write.parquet(f"{root}/reg")
    a, b = _log_body("/g", "s", "a1", "a2"), _log_body("/g", "s", "b")
    _land(spark, root, (1, 1000, a), (1, 1500, a), (2, 2000, b))
    _intake(spark, root, redelivered="1 hour")
    _land(spark, root, (1, 9000, a))
    _land(spark, root, (3, 9500, a), (2, 9900, b))
    _intake(spark, root, redelivered="1 hour")  # from the checkpoint, as after a restart
    read = tables.read_events(spark, f"{root}/out/events").collect()
    assert sorted(r.message for r in read) == ["a1", "a1", "a2", "a2", "b"]


def test_redelivered_metric_bodies_land_once(spark, tmp_path):
    root = str(tmp_path)
    body = "Namespace=ns&MetricData.member.1.MetricName=a&MetricData.member.1.Value=1"
    for ms in (1000, 2000):
        _land(spark, root, (7, ms, body))
        stream = spark.readStream.schema(ingest.BODIES).parquet(f"{root}/in")
        ingest.stream_ingest_metrics(stream, f"{root}/out", f"{root}/state", redelivered="1 hour").awaitTermination()
    assert tables.read_metrics(spark, f"{root}/out/metrics").count() == 1


def test_intake_creates_what_it_does_not_know(spark, tmp_path):
    """Five lines of an unknown group and stream are all kept, and both are registered once, over batches and replays."""
    root = str(tmp_path)
    spark.createDataFrame([("/g", None, 30, 1), ("/g", "s", None, 1)], schemas.REGISTRY).write.parquet(f"{root}/reg")
    _land(spark, root, (1, 100, _log_body("/agent", "host", "l1", "l2", "l3")), (2, 110, _log_body("/g", "s", "known")))
    _land(spark, root, (3, 200, _log_body("/agent", "host", "l4", "l5")), (4, 210, _log_body("/g", "t", "new stream")), (5, 220, "bad"))
    _intake(spark, root, create=True)
    read = tables.read_events(spark, f"{root}/out/events").collect()
    assert sorted(r.message for r in read) == ["known", "l1", "l2", "l3", "l4", "l5", "new stream"]
    assert spark.read.parquet(f"{root}/out/rejected").count() == 0 and spark.read.parquet(f"{root}/out/dead").count() == 1
    want = {("/g", None, 30, 1), ("/g", "s", None, 1), ("/agent", None, None, 100), ("/agent", "host", None, 100), ("/g", "t", None, 210)}
    found = lambda: sorted(map(str, (tuple(r) for r in ingest.read_registry(spark, f"{root}/reg", f"{root}/out").collect())))
    assert found() == sorted(map(str, want))
    _intake(spark, root, create=True)
    assert found() == sorted(map(str, want))
    # a batch that runs again does not see what its first run created
    (folder,) = [p for p in (tmp_path / "out" / "registry").glob("stream=*/batch=0")]
    seen = ingest.read_registry(spark, f"{root}/reg", f"{root}/out", but=str(folder))
    events = tables.read_events(spark, f"{root}/out/events").drop("event_date").filter("ingestion_time_ms < 200")
    assert {(r.log_group, r.log_stream) for r in registry.unregistered(seen, events).collect()} == {("/agent", None), ("/agent", "host")}


def _events(rng, n):
    rows, at = [], {"/a": 0, "/b": 0, "/c": 5}
    for i in range(n):
        group = rng.choice(["/a", "/a", "/b"]) if i else "/c"
        at[group] += rng.choice([0, 1, 50, 400])
        rows.append((group, None if group == "/b" else "s", at[group], i, "x" * rng.randrange(1, 60)))
    return rows


EVENTS = "log_group string, log_stream string, timestamp_ms long, seq long, message string"
LIMITS = {"max_events": 7, "max_bytes": 400, "max_span_ms": 900}


def _batched(spark, root, linger_ms=86_400_000):
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    found = batches.stream_log_batches(stream, linger_ms, **LIMITS)
    batches.write_log_batches(found, f"{root}/out", f"{root}/state").awaitTermination()


def test_batches_of_a_stream_equal_the_plan(spark, tmp_path):
    root, rng = str(tmp_path), random.Random(11)
    rows = _events(rng, 400)
    cuts = [0, 1, 90, 91, 250, 400]
    land = lambda a, b: spark.createDataFrame(rows[a:b], EVENTS).coalesce(1).write.mode("append").parquet(f"{root}/in")
    for a, b in list(zip(cuts, cuts[1:]))[:3]:
        land(a, b)
    _batched(spark, root)
    for a, b in list(zip(cuts, cuts[1:]))[3:]:
        land(a, b)
    _batched(spark, root)  # restarts from the checkpoint
    _batched(spark, root)
    plan = batching.plan_log_batches(spark.createDataFrame(rows, EVENTS), **LIMITS).collect()
    want = {(r.seq, r.log_group, r.log_stream, r.timestamp_ms, r.batch_no, r.index_in_batch) for r in plan}
    planned = spark.read.parquet(f"{root}/out/planned").drop("stream", "batch").collect()
    assert {(r.seq, r.log_group, r.log_stream, r.timestamp_ms, r.batch_no, r.index_in_batch) for r in planned} == want and len(planned) == 400
    closed = {(r.log_group, r.batch_no): r for r in spark.read.parquet(f"{root}/out/closed").collect()}
    last = {g: max(r.batch_no for r in plan if r.log_group == g) for g in ("/a", "/b", "/c")}
    assert set(closed) == {(r.log_group, r.batch_no) for r in plan if r.batch_no < last[r.log_group]}
    sizes = {s: len(m) + 26 for _, _, _, s, m in rows}
    for (group, number), r in closed.items():
        own = [p for p in plan if p.log_group == group and p.batch_no == number]
        assert (r.events, r.bytes) == (len(own), sum(sizes[p.seq] for p in own))
        assert (r.first_ms, r.last_ms) == (min(p.timestamp_ms for p in own), max(p.timestamp_ms for p in own))
        head = next(p for p in plan if p.log_group == group and p.batch_no == number + 1 and p.index_in_batch == 0)
        why = "events" if r.events == 7 else "bytes" if r.bytes + sizes[head.seq] > 400 else "span"
        assert r.closed_by == why and (why != "span" or head.timestamp_ms > r.first_ms + 900)
    assert {r.closed_by for r in closed.values()} == {"events", "bytes", "span"}


def test_a_timer_closes_a_batch_that_gets_no_more_events(spark, tmp_path):
    root = str(tmp_path)
    land = lambda *rows: spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(f"{root}/in")
    land(("/a", "s", 1, 1, "x"), ("/a", "s", 2, 2, "y"))
    _batched(spark, root, linger_ms=1)
    land(("/b", "s", 1, 3, "z"))
    _batched(spark, root, linger_ms=1)
    land(("/a", "s", 3, 4, "w"))
    _batched(spark, root, linger_ms=1)
    closed = {(r.log_group, r.batch_no): r for r in spark.read.parquet(f"{root}/out/closed").collect()}
    assert closed["/a", 0].closed_by == "timer" and closed["/a", 0].events == 2
    planned = {r.seq: (r.batch_no, r.index_in_batch) for r in spark.read.parquet(f"{root}/out/planned").collect()}
    assert planned == {1: (0, 0), 2: (0, 1), 3: (0, 0), 4: (1, 0)}


def test_messages_that_cannot_be_sent(spark, tmp_path):
    spark.createDataFrame([("/a", "s", 1, 1, ""), ("/a", "s", 2, 2, "y")], EVENTS).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(EVENTS).parquet(f"{tmp_path}/in")
    found = batches.stream_log_batches(stream, 1000, bad_messages="drop")
    batches.write_log_batches(found, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    assert [r.seq for r in spark.read.parquet(f"{tmp_path}/out/planned").collect()] == [2]
    with pytest.raises(ValueError):
        batches.stream_log_batches(stream, 1000, bad_messages="keep")


PLANNED = "log_group string, log_stream string, batch_no long, index_in_batch long, seq long, sent_ms long"
ANSWERS = "log_group string, log_stream string, batch_no long, body string, received_ms long"


def test_outcomes_of_streams(spark, tmp_path):
    """Answers before, in and after the limit, twice, unreadable, and none; over two runs from one checkpoint."""
    root = str(tmp_path)
    ok, old = "{}", json.dumps({"rejectedLogEventsInfo": {"tooOldLogEventEndIndex": 0}})
    minute = 60_000

    def land(name, schema, *rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/{name}")

    def run():
        sent = spark.readStream.schema(PLANNED).parquet(f"{root}/sent")
        answers = spark.readStream.schema(ANSWERS).parquet(f"{root}/answers")
        found = outcomes.stream_put_outcomes(sent, answers, "10 minutes", "1 minute")
        writer = found.writeStream.format("parquet").option("checkpointLocation", f"{root}/state").outputMode("append")
        writer.trigger(availableNow=True).start(f"{root}/out").awaitTermination()

    batch = lambda n, ms, rows=2: [("/g", "s", n, i, 10 * n + i, ms) for i in range(rows)]
    land("sent", PLANNED, *batch(0, minute), *batch(1, minute), *batch(2, minute), *batch(3, minute), *batch(4, minute))
    land("answers", ANSWERS, ("/g", "s", 0, old, 2 * minute), ("/g", "s", 0, ok, 2 * minute + 1), ("/g", "s", 1, "<html>", minute), ("/g", "s", 2, ok, minute - 1), ("/g", "x", 4, ok, 2 * minute))
    run()
    got = {r.seq: r.status for r in spark.read.parquet(f"{root}/out").collect()}
    assert got[10] == got[11] == "unreadable_response" and set(got) == {0, 1, 10, 11} and got[0] in ("too_old", "ok")
    land("sent", PLANNED, *batch(5, 60 * minute, 1))
    land("answers", ANSWERS, ("/g", "s", 3, ok, 12 * minute), ("/g", "s", 5, ok, 60 * minute))
    run()
    run()
    got = {r.seq: r.status for r in spark.read.parquet(f"{root}/out").collect()}
    assert {s: v for s, v in got.items() if s >= 20} == {20: None, 21: None, 30: None, 31: None, 40: None, 41: None, 50: "ok"}


def test_outcomes_equal_the_batch_form(spark, tmp_path):
    rng, root = random.Random(3), str(tmp_path)
    planned = [("/g", "s", b, i, 100 * b + i, 1000 + b * 1000) for b in range(12) for i in range(5)] + [("/end", "s", 0, 0, 9999, 10**9)]
    infos = [{}, {"rejectedLogEventsInfo": {"expiredLogEventEndIndex": 1, "tooNewLogEventStartIndex": 3}}, {"rejectedEntityInfo": {"errorType": "e"}}, []]
    answers = [("/g", "s", b, json.dumps(rng.choice(infos)), 1000 + b * 1000 + 50) for b in range(12) if b % 5] + [("/end", "s", 0, "{}", 10**9)]
    sent, got = spark.createDataFrame(planned, PLANNED), spark.createDataFrame(answers, ANSWERS)
    sent.write.parquet(f"{root}/sent"), got.write.parquet(f"{root}/answers")
    found = outcomes.stream_put_outcomes(spark.readStream.schema(PLANNED).parquet(f"{root}/sent"), spark.readStream.schema(ANSWERS).parquet(f"{root}/answers"))
    writer = found.writeStream.format("parquet").option("checkpointLocation", f"{root}/state").outputMode("append")
    writer.trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    streamed = {r.seq: r.status for r in spark.read.parquet(f"{root}/out").collect()}
    assert streamed == {r.seq: r.status for r in delivery.reconcile_put(sent, got.drop("received_ms")).collect()}


def test_a_group_leaves_only_the_days_that_hold_it(spark, tmp_path):
    path, day = str(tmp_path / "events"), 86_400_000
    rows = [(g, "s", d * day + i, 0, f"{g}{d}{i}", "m") for g, days in (("/gone", (0, 1, 4)), ("/stays", (1, 2, 3))) for d in days for i in range(3)]
    tables.append_events(spark.createDataFrame(rows, schemas.RAW_EVENTS), path)
    known = spark.createDataFrame([("/gone", None, None, 1), ("/gone", "s", None, 1), ("/stays", None, None, 1)], schemas.REGISTRY)
    names = spark.createDataFrame([(0, "/gone"), (1, None), (2, "/none"), (3, "/gone")], "seq long, log_group string")
    files = lambda: {str(f): f.stat().st_mtime_ns for f in (tmp_path / "events").rglob("*.parquet")}
    before = files()
    left, done = tables.delete_stored_groups(known, path, names)
    assert {r.seq: r.outcome for r in done.collect()} == {0: "deleted", 1: None, 2: "absent", 3: "absent"}
    assert [r.log_group for r in left.collect()] == ["/stays"]
    found = tables.read_events(spark, path).collect()
    assert sorted(r.event_id for r in found) == sorted(f"/stays{d}{i}" for d in (1, 2, 3) for i in range(3))
    folders = sorted(p.name for p in (tmp_path / "events").glob("event_date=*"))
    assert folders == ["event_date=1970-01-02", "event_date=1970-01-03", "event_date=1970-01-04"]
    untouched = {f: t for f, t in before.items() if "01-03" in f or "01-04" in f}
    after = files()
    assert untouched and all(after.get(f) == t for f, t in untouched.items())
    tables.delete_stored_groups(left, path, names)
    assert files() == after


def _spread(spark, root, name, files):
    """The smallest given tables, one of them in so many files."""
    given = Path("/root/testdata/sf0.001")
    for path in given.glob("*.parquet"):
        if path.stem != name:
            (root / path.name).symlink_to(path)
    spark.read.parquet(str(given / f"{name}.parquet")).repartition(files).write.parquet(str(root / f"{name}.parquet"))
    return str(root)


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="the given tables are not there")
@pytest.mark.parametrize("times", [1, 2])
def test_bodies_land_in_as_many_files_as_they_are_read_in(spark, tmp_path, times):
    root = queries._log_intake(spark, _spread(spark, tmp_path, "documents", 4), times, **({"redelivered": "1 hour"} if times > 1 else {}))
    assert len(list(Path(root, "bodies").glob("*.parquet"))) == 4 * times
    assert len(list(Path(root, "out/dead").glob("stream=*/batch=*"))) >= times


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="the given tables are not there")
def test_events_to_batch_land_in_as_many_files_as_they_are_read_in(spark, tmp_path):
    out = queries._streamed_batches(spark, _spread(spark, tmp_path, "documents", 4))
    assert len(list(Path(out).parent.joinpath("events").glob("*.parquet"))) > 2
    assert len(list(Path(out, "planned").glob("stream=*/batch=*"))) == 2

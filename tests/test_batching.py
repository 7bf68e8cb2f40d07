import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from beaconlake.functions import checks
from beaconlake.operators import batching
from beaconlake.operators.batching import Limits, assign_batches


def greedy(rows, limits):
    """Plain one-by-one batching of (stamp, seq, size) rows: seq -> (batch, place)."""
    found, number, count, size, first = {}, -1, 0, 0, None
    for stamp, seq, bytes_ in sorted(rows):
        late = limits.span_ms is not None and first is not None and stamp > first + limits.span_ms
        if number < 0 or count >= limits.count or size + bytes_ > limits.size or late:
            number, count, size, first = number + 1, 0, 0, stamp
        found[seq] = (number, count)
        count, size = count + 1, size + bytes_
    return found


def _events(spark, sizes_and_times):
    rows = [("/g", "s", t, i, "x" * n) for i, (n, t) in enumerate(sizes_and_times)]
    return spark.createDataFrame(rows, "log_group string, log_stream string, timestamp_ms long, seq long, message string")


def _batch_sizes(planned):
    found = planned.groupBy("batch_no").count().orderBy("batch_no").collect()
    return [r["count"] for r in found]


def test_ties_keep_input_order(spark):
    planned = batching.plan_log_batches(_events(spark, [(7, 3000), (5, 1000), (7, 3000)])).orderBy("index_in_batch")
    assert [(r.batch_no, r.seq) for r in planned.collect()] == [(0, 1), (0, 0), (0, 2)]


def test_byte_bound(spark):
    half = 524_288 - 26
    assert _batch_sizes(batching.plan_log_batches(_events(spark, [(half, 0), (half, 1)]))) == [2]
    assert _batch_sizes(batching.plan_log_batches(_events(spark, [(half, 0), (half + 1, 1)]))) == [1, 1]


def test_count_bound(spark):
    assert _batch_sizes(batching.plan_log_batches(_events(spark, [(1, 0)] * 10_000))) == [10_000]
    assert _batch_sizes(batching.plan_log_batches(_events(spark, [(1, 0)] * 10_001))) == [10_000, 1]


def test_span_bound(spark):
    day = checks.MAX_SPAN_MS
    assert _batch_sizes(batching.plan_log_batches(_events(spark, [(1, 0), (1, day)]))) == [2]
    assert _batch_sizes(batching.plan_log_batches(_events(spark, [(1, 0), (1, day + 1)]))) == [1, 1]
    top = 2**63 - 1
    assert _batch_sizes(batching.plan_log_batches(_events(spark, [(1, top - 5), (1, top)]))) == [2]


@pytest.mark.parametrize("seed", range(6))
def test_split_destinations_match_plain_batching(spark, seed):
    rng = random.Random(seed)
    limits = Limits(rng.choice([1, 7, 20]), rng.choice([100, 150, 400]), rng.choice([None, 40, 5]))
    rows, seq = [], 0
    for key in [None, "a", "b", "hot"]:
        kind = rng.randrange(4)
        stamp = 0
        for i in range(2500 if key == "hot" else rng.choice([1, 30, 300])):
            stamp += rng.choice([0, 0, 1, 3, 60])
            size = [rng.randint(1, 30), 11, rng.choice([1, 200]), rng.randint(90, 130)][kind]
            rows.append((key, stamp, seq, size))
            seq += 1
    rng.shuffle(rows)
    expected = {}
    for key in {r[0] for r in rows}:
        expected |= greedy([r[1:] for r in rows if r[0] == key], limits)
    df = spark.createDataFrame(rows, "k string, ts long, seq long, size long").repartition(rng.choice([1, 3, 9]))
    for chunk_rows in (rng.choice([20, 25, 64]), 100_000):
        found = assign_batches(df, ["k"], "seq", "size", limits, "ts", chunk_rows).collect()
        assert {r.seq: (r.batch_no, r.index_in_batch) for r in found} == expected


def test_chunk_maps_name_every_next_start():
    rng = np.random.default_rng(0)
    for _ in range(50):
        sizes = rng.integers(1, 40, 60)
        limits = Limits(12, 100)
        frame = batching.pd.DataFrame({"ts": 0, "size": sizes, "halo": [False] * 48 + [True] * 12})
        ends = batching.next_starts(np.zeros(60), sizes, limits)
        segments = batching._chunk_maps(frame, 1, limits, 48)
        for start in range(ends[0] + 1):
            (_, _, follow, step, count, late, late_step), low = next((s, s[0]) for s in segments if s[0] <= start < s[1])
            at, batches, last = start, 0, start
            while at < 48:
                last, batches, at = at, batches + 1, int(ends[at])
            away = start - low
            assert (follow + step * away, count, late + late_step * away) == (at - 48, batches, 48 + last)


def test_maps_of_neighbours_make_one_of_both():
    rng = np.random.default_rng(1)

    def random_map(starts, place):
        cuts = sorted({0, *rng.integers(1, starts, 5).tolist()})
        return np.array([(low, high, int(rng.integers(0, starts - (high - low) + 1)), int(rng.integers(0, 2)), int(rng.integers(1, 9)), place + int(rng.integers(0, 50)), int(rng.integers(0, 2))) for low, high in zip(cuts, [*cuts[1:], starts])])

    def at(maps, start):
        low, _, follow, step, count, late, late_step = next(m for m in maps if m[0] <= start < m[1])
        return follow + step * (start - low), count, late + late_step * (start - low)

    for _ in range(200):
        first, second = random_map(40, 0), random_map(40, 100)
        both = batching._composed(first, second)
        for start in range(40):
            follow, count, _ = at(first.tolist(), start)
            end, more, late = at(second.tolist(), follow)
            assert at(both, start) == (end, count + more, late)


def test_no_task_holds_all_maps_of_a_destination(spark, monkeypatch):
    """One destination of 150 chunks: no call that pairs maps sees more than two of them."""
    limits = Limits(10, 120)
    rng = random.Random(9)
    rows = [("hot", i // 3, i, rng.randint(1, 60)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, ts long, seq long, size long").repartition(4)
    found = assign_batches(df, ["k"], "seq", "size", limits, "ts", 20).collect()
    assert {r.seq: (r.batch_no, r.index_in_batch) for r in found} == greedy([r[1:] for r in rows], limits)


def test_a_chunk_holds_a_batch(spark):
    with pytest.raises(ValueError, match="chunk_rows"):
        batching.plan_log_batches(_events(spark, [(1, 0)]), chunk_rows=10)


def test_destinations_without_a_name_and_messages_that_cannot_be_sent(spark):
    shape = "log_group string, log_stream string, timestamp_ms long, seq long, message string"
    rows = [(None, "s", 5, 1, "a"), ("g", None, 4, 2, "b"), (None, "s", 3, 3, "c"), ("g", None, 2, 4, "")]
    events = spark.createDataFrame(rows, shape)
    planned = batching.plan_log_batches(events, bad_messages="drop").collect()
    assert sorted((r.seq, r.batch_no, r.index_in_batch) for r in planned) == [(1, 0, 1), (2, 0, 0), (3, 0, 0)]
    with pytest.raises(Exception, match="missing or empty"):
        batching.plan_log_batches(events).collect()
    with pytest.raises(Exception, match="no time"):
        batching.plan_log_batches(spark.createDataFrame([("g", "s", None, 1, "a")], shape)).collect()
    long = spark.createDataFrame([("g", "s", 1, 1, "x" * 1_048_550)], shape)
    assert batching.plan_log_batches(long).count() == 1
    with pytest.raises(Exception, match="does not fit"):
        batching.plan_log_batches(long.withColumn("message", F.concat("message", F.lit("x")))).collect()

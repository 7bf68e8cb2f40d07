import random
from collections import defaultdict

import pytest

from beaconlake import schemas
from beaconlake.operators import sketches, statistics

NAMES = [*statistics.PLAIN, "p10", "p50", "p99", "tm90", "tc90", "ts90", "wm90", "iqm"]


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(7)
    rows = []
    for i in range(30_000):
        series = rng.choice("abbbbbbb")
        rows.append(("ns", "m", rng.randrange(20 * 60_000), float(rng.choice([rng.gauss(10, 3), rng.randrange(5), rng.expovariate(0.1)])), "None", {"k": series}))
    rows += [("ns", "m", 5, None, "None", {"k": "none"}), ("ns", "m", 7, None, "None", {"k": "a"}), (None, "m", 9, 4.0, "None", {"k": "a"})]
    return spark.createDataFrame(rows, schemas.RAW_METRICS).repartition(6)


def values(points, period):
    held = defaultdict(list)
    for r in points.collect():
        if r.value is not None:
            held[r.namespace, r.dimensions["k"], r.timestamp_ms // (period * 1000) * period * 1000].append(r.value)
    return {key: sorted(found) for key, found in held.items()}


def test_merged_minutes_are_within_the_sketch_errors(points):
    fine = sketches.sketch_periods(points, 60)
    coarse = sketches.merge_periods(sketches.merge_periods(fine, 300), 600)
    exact = values(points, 600)
    found = [r for r in sketches.read_sketches(coarse, NAMES).collect() if r.sample_count]
    assert len(found) == len(exact)
    for r in found:
        series = r.dimensions_key[6:-2]
        own = exact[r.namespace, series, r.bucket_ms]
        n = len(own)
        assert r.sample_count == n and r.minimum == own[0] and r.maximum == own[-1]
        assert r["sum"] == pytest.approx(sum(own)) and r.average == pytest.approx(sum(own) / n)
        for name, share in (("p10", 0.1), ("p50", 0.5), ("p99", 0.99)):
            low, high = sum(v < r[name] for v in own) / n, sum(v <= r[name] for v in own) / n
            assert low - sketches.RANK_ERROR - 1 / n <= share <= high + sketches.RANK_ERROR + 1 / n
        different = len(set(own))
        assert abs(r.distinct_values - different) <= sketches.DISTINCT_ERROR * different + 1
        if n > 5000:
            kept = own[: int(0.9 * n)]
            assert r.tm90 == pytest.approx(sum(kept) / len(kept), rel=0.05) and r.tc90 == pytest.approx(0.9 * n, rel=0.02)
            assert r.ts90 == pytest.approx(sum(kept), rel=0.06) and r.iqm == pytest.approx(sum(own[n // 4 : 3 * n // 4]) / (n // 2), rel=0.05)
            assert r.wm90 == pytest.approx((sum(kept) + own[int(0.9 * n)] * (n - len(kept))) / n, rel=0.05)


def test_periods_without_values_merge(points):
    stored = sketches.merge_periods(sketches.sketch_periods(points, 60), 600)
    (row,) = [r for r in sketches.read_sketches(stored, NAMES).collect() if r.dimensions_key == '{"k":"none"}']
    assert row.sample_count == 0 and row.distinct_values == 0
    assert all(row[statistics.column_name(n)] is None for n in NAMES if n != "SampleCount")


def test_merging_over_series(points):
    stored = sketches.merge_periods(sketches.sketch_periods(points, 60), 1200, by=["namespace"])
    found = {r.namespace: r for r in sketches.read_sketches(stored, ["SampleCount", "p50"]).collect()}
    own = sorted(v for (ns, _, _), held in values(points, 1200).items() if ns for v in held)
    assert found[None].sample_count == 1 and found["ns"].sample_count == len(own)
    assert abs(sum(v <= found["ns"].p50 for v in own) / len(own) - 0.5) < sketches.RANK_ERROR + 0.06


def test_a_rollup_takes_every_statistic(points):
    names = [*statistics.PLAIN, "p50", "p99.5", "tm90", "tc90", "ts90", "wm90", "iqm"]
    found = {(r.namespace, r.dimensions_key, r.bucket_ms): r for r in statistics.metric_rollup(points, 600, names).collect()}
    for name in names:
        single = statistics.period_statistic(points.withColumn("k", points.dimensions["k"]), name, 600, by=["namespace", "k"]).collect()
        for r in single:
            assert found[r.namespace, f'{{"k":"{r.k}"}}', r.bucket_ms][statistics.column_name(name)] == (None if r.value is None else pytest.approx(r.value, rel=1e-12))
    empty = found["ns", '{"k":"none"}', 0]
    assert empty.sample_count == 0 and empty.p50 is None and empty["sum"] is None

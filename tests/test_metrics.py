import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from beaconlake import schemas
from beaconlake.operators import statistics
from beaconlake.operators.quantiles import group_percentiles
from beaconlake.sources import metrics

NOW = 1_704_100_000_000
BASE = 1_704_067_200_000


@pytest.fixture(scope="module")
def points(spark):
    rows = [("ns", "m", BASE + i * 60_000, float(i), "Count", {"a": "1", "b": str(i % 2)}) for i in range(11)]
    rows.append(("other", "m", BASE + 60_000, 100.0, "Bytes", {}))
    return spark.createDataFrame(rows, schemas.RAW_METRICS)


def test_range_leaves_out_its_start_and_holds_its_end(points):
    found = statistics.metric_filter(points, "ns", "m", BASE, BASE + 300_000)
    assert sorted(r.value for r in found.collect()) == [1, 2, 3, 4, 5]
    assert statistics.metric_filter(points, "", "m").count() == 12
    assert statistics.metric_filter(points, "ns", "m", dimensions={"b": "1"}).count() == 5
    assert statistics.metric_filter(points, "ns", "m", dimensions={"b": "1", "c": "1"}).count() == 0
    assert statistics.metric_filter(points, unit="Bytes").count() == 1


def test_scan(points):
    found = metrics.metrics_scan(
        points, "ns", "m", {"a": "1", "service.name": "x"}, now=NOW, start=BASE, end=BASE + 600_500
    )
    assert found.count() == 0
    found = metrics.metrics_scan(points, "ns", "m", {"a": "1"}, "Sum", 300, "Count", BASE, BASE + 600_500, "desc", 2, now=NOW)
    rows = found.collect()
    assert [r.double_value for r in rows] == [10.0, 35.0]
    assert rows[0].metric_attributes == (
        '{"namespace":"ns","statistic":"Sum","period":300,"query_id":"m1","label":"m","status_code":"Complete",'
        '"dimensions":{"a":"1"}}'
    )
    assert rows[0].unit == "Count" and rows[0].resource_attributes == '{"cloud.provider":"aws"}'
    assert found.schema.simpleString() == schemas.OTLP_GAUGE.simpleString()


@pytest.mark.parametrize(
    "options, message",
    [
        ({"metric_name": ""}, "name a namespace"),
        ({"statistic": "sum"}, "invalid statistic"),
        ({"statistic": "pr"}, "invalid statistic"),
        ({"statistic": "pfoo99"}, "invalid statistic"),
        ({"statistic": "p101"}, "invalid statistic"),
        ({"period": 0}, "period"),
        ({"start": "now", "end": "now"}, "before"),
        ({"dimensions": {"": "x"}}, "a name and a value"),
        ({"dimensions": {str(i): "x" for i in range(31)}}, "30"),
        ({"order": "x"}, "order"),
        ({"max_rows": -1}, "max_rows"),
    ],
)
def test_bad_options(points, options, message):
    given = {"namespace": "ns", "metric_name": "m", "now": NOW, **options}
    with pytest.raises(ValueError, match=message):
        metrics.metrics_scan(points, **given)


def test_statistic_names():
    assert statistics.statistic(" P99.9 ").bounds == (99.9,)
    assert statistics.statistic("TM90").kind == "tm" and statistics.statistic("IQM").bounds == (25.0, 75.0)


def _expected(values, name):
    values = np.sort(values)
    top = np.quantile(values, 0.9)
    low, high = np.quantile(values, [0.25, 0.75])
    kept = values[values <= top]
    middle = values[(values >= low) & (values <= high)]
    return {
        "p90": top, "tm90": kept.mean(), "tc90": float(len(kept)), "ts90": kept.sum(),
        "wm90": np.minimum(values, top).mean(), "iqm": middle.mean(),
    }[name]


@pytest.mark.parametrize("name", ["p90", "tm90", "tc90", "ts90", "wm90", "iqm"])
def test_percentile_statistics_of_a_hot_bucket(spark, name):
    rng = np.random.default_rng(3)
    hot = pd.DataFrame({"g": "hot", "t": 0, "value": rng.lognormal(0, 3, 60_000)})
    small = pd.DataFrame({"g": [f"g{i % 50}" for i in range(700)], "t": 1, "value": rng.integers(0, 9, 700) / 1.0})
    frame = pd.concat([hot, small, pd.DataFrame({"g": ["nil"], "t": [2], "value": [5.0]})])
    rows = spark.createDataFrame(frame).select("g", F.col("t").alias("timestamp_ms"), "value").repartition(6)
    found = statistics.period_statistic(rows, name, 60, by=["g"]).collect()
    assert len(found) == frame.g.nunique()
    for r in found:
        assert math.isclose(r.value, _expected(frame.value[frame.g == r.g].to_numpy(), name), rel_tol=1e-9), r


def test_percentiles_of_many_sizes(spark):
    rng = np.random.default_rng(5)
    frame = pd.concat(
        [pd.DataFrame({"g": n, "v": rng.integers(0, 12, n) * 1.5}) for n in range(1, 60)]
        + [pd.DataFrame({"g": 99, "v": np.full(30_000, 2.0)}), pd.DataFrame({"g": 100, "v": rng.normal(size=30_000)})]
    )
    fractions = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 0.999, 1.0]
    found = group_percentiles(spark.createDataFrame(frame), ["g"], "v", fractions).toPandas().set_index("g").sort_index()
    expected = frame.groupby("g").v.quantile(fractions).unstack().sort_index()
    assert np.allclose(found.to_numpy(), expected.to_numpy(), rtol=1e-12, atol=1e-12)


def test_rollup_shuffles_once(points):
    found = statistics.metric_rollup(points, 300)
    # Three buckets, of which two have both dimension sets, and the other namespace.
    assert found.count() == 6
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SortAggregate" not in plan


def test_negative_times_cut_toward_zero(spark):
    rows = spark.createDataFrame([(-1,), (-60_001,), (59_999,)], "t long")
    assert [r[0] for r in rows.select(statistics.period_bucket(F.col("t"), 60)).collect()] == [0, -60_000, 0]


PAGE = '{{"MetricDataResults":[{{"Id":"m1","Label":"l","StatusCode":"{}","Timestamps":{},"Values":{}}}]{}}}'


def _pages(spark, *bodies):
    return spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "page_no int, body string")


def test_json_pages(spark):
    good = PAGE.format("Complete", "[1704067200, 1704067260.5]", "[1, 2.5]", "")
    partial = PAGE.format("PartialData", "[1704067200]", "[7]", ',"NextToken":"t"')
    rows = metrics.decode_metric_pages(_pages(spark, good, partial)).orderBy("page_no", "pos").collect()
    assert [(r.value, r.status_code, r.label) for r in rows] == [
        (1.0, "Complete", "l"), (2.5, "Complete", "l"), (7.0, "PartialData", "l"),
    ]
    assert str(rows[1].time_unix_nano) == "2024-01-01 00:01:00.500000"


@pytest.mark.parametrize(
    "body, message",
    [
        (PAGE.format("Forbidden", "[1]", "[1]", ""), "Forbidden"),
        (PAGE.format("InternalError", "[]", "[]", ""), "InternalError"),
        (PAGE.format("PartialData", "[1]", "[1]", ""), "PartialData"),
        (PAGE.format("Complete", "[1,2]", "[1]", ""), "mismatched"),
        (PAGE.format("Complete", '["x"]', "[1]", ""), "malformed|mismatched"),
        ('{"a":1}', "no MetricDataResults"),
        ("x", "not a JSON object"),
    ],
)
def test_bad_json_pages(spark, body, message):
    with pytest.raises(Exception, match=message):
        metrics.decode_metric_pages(_pages(spark, body)).collect()


def test_xml_pages(spark):
    member = "<member><Label>l</Label><StatusCode>Complete</StatusCode><Timestamps>{}</Timestamps><Values>{}</Values></member>"
    shell = "<GetMetricDataResponse><GetMetricDataResult><MetricDataResults>{}</MetricDataResults></GetMetricDataResult></GetMetricDataResponse>"
    one = member.format("<member>2024-01-01T00:00:00Z</member>", "<member>1.5</member>")
    rows = metrics.decode_metric_pages_xml(_pages(spark, shell.format(one + one))).collect()
    assert [r.value for r in rows] == [1.5]
    assert metrics.decode_metric_pages_xml(_pages(spark, shell.format(member.format("", "")))).collect() == []
    for bad in [
        shell.format(""),
        shell.format(member.format("<member>2024-01-01T00:00:00Z</member>", "")),
        shell.format(member.format("<member>2024-01-01T00:00:00Z</member>", "<member>x</member>")),
        "<broken>",
    ]:
        with pytest.raises(Exception):
            metrics.decode_metric_pages_xml(_pages(spark, bad)).collect()

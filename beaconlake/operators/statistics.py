"""Period statistics of metric data points."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake.functions.attributes import dimensions_key, has_dimensions
from beaconlake.functions.times import whole
from beaconlake.operators.quantiles import group_percentiles, join_groups
from beaconlake.storage import pin

# Names of the plain statistics.
PLAIN = ["Sum", "Average", "Maximum", "Minimum", "SampleCount"]


@dataclass(frozen=True)
class Statistic:
    """A parsed statistic name: a plain one, or a percentile kind with its bounds in percent."""

    name: str
    kind: str
    bounds: tuple[float, ...] = ()


def statistic(name: str) -> Statistic:
    """`Sum`, `Average`, `Maximum`, `Minimum`, `SampleCount`, `p99`, `tm90`, `tc90`, `ts90`, `wm90` or `iqm`."""
    text = name.strip()
    if text in PLAIN:
        return Statistic(text, "plain")
    lower = text.lower()
    if lower == "iqm":
        return Statistic(text, "iqm", (25.0, 75.0))
    found = re.fullmatch(r"(p|tm|tc|ts|wm)(\d+(?:\.\d+)?)", lower)
    if not found or not 0 <= float(found[2]) <= 100:
        raise ValueError(
            f"invalid statistic '{name}'; use {', '.join(PLAIN)}, iqm, or p/tm/tc/ts/wm and a number from 0 to 100"
        )
    return Statistic(text, found[1], (float(found[2]),))


def period_bucket(ms: Column, period: int) -> Column:
    """Start of the period (in seconds) that holds an epoch millisecond, cut toward zero."""
    if period <= 0:
        raise ValueError("period must be positive")
    return whole(ms, period * 1000) * F.lit(period * 1000).cast("long")


def metric_filter(
    points: DataFrame,
    namespace: str = "",
    metric_name: str = "",
    start_ms: int | None = None,
    end_ms: int | None = None,
    dimensions: Mapping[str, str] | None = None,
    unit: str = "",
) -> DataFrame:
    """Data points after `start_ms` up to and with `end_ms`; empty arguments do not filter.

    Dimensions are a subset match: a point may carry more of them.
    """
    if namespace:
        points = points.filter(F.col("namespace") == namespace)
    if metric_name:
        points = points.filter(F.col("metric_name") == metric_name)
    day = 86_400_000
    dated = "event_date" in points.columns
    if start_ms is not None:
        points = points.filter(F.col("timestamp_ms") > start_ms)
        if dated:
            points = points.filter(F.col("event_date") >= F.date_from_unix_date(F.lit((start_ms + 1) // day)))
    if end_ms is not None:
        points = points.filter(F.col("timestamp_ms") <= end_ms)
        if dated:
            points = points.filter(F.col("event_date") <= F.date_from_unix_date(F.lit(end_ms // day)))
    if unit:
        points = points.filter(F.col("unit") == unit)
    return points.filter(has_dimensions(F.col("dimensions"), dimensions)) if dimensions else points


def _plain(name: str) -> Column:
    value = F.col("value")
    return {
        "Sum": F.sum(value),
        "Average": F.avg(value),
        "Maximum": F.max(value),
        "Minimum": F.min(value),
        "SampleCount": F.count(value).cast("double"),
    }[name]


def _bounded(found: Statistic, limits: Sequence[str] = ("q0", "q1")) -> Column:
    """A percentile-based statistic of rows that carry their group's thresholds in the columns `limits`."""
    value, q0 = F.col("value"), F.col(limits[0])
    if found.kind == "p":
        return F.max(q0)
    if found.kind == "iqm":
        return F.avg(F.when((value >= q0) & (value <= F.col(limits[1])), value))
    if found.kind == "wm":
        return F.avg(F.least(value, q0))
    kept = F.when(value <= q0, value)
    return {"tm": F.avg(kept), "tc": F.count(kept).cast("double"), "ts": F.sum(kept)}[found.kind]


def period_statistic(
    points: DataFrame, name: str, period: int, by: Sequence[str] = (), approx: bool = False
) -> DataFrame:
    """One row per bucket (and `by` columns) with the statistic as `value`; empty buckets give no row.

    `tmNN`, `tcNN` and `tsNN` are mean, count and sum of the values up to the NN-th percentile, `wmNN` the mean
    with larger values set to it, and `iqm` the mean of the values between the quartiles.
    """
    found = statistic(name)
    keys = [*by, "bucket_ms"]
    rows = points.select(*by, period_bucket(F.col("timestamp_ms"), period).alias("bucket_ms"), "value")
    if found.kind == "plain":
        return rows.groupBy(*keys).agg(_plain(found.name).alias("value"))
    fractions = [bound / 100 for bound in found.bounds]
    limits = group_percentiles(rows, keys, "value", fractions, approx)
    if found.kind == "p":
        return limits.select(*keys, F.col("q0").alias("value"))
    return join_groups(rows, pin(limits, "limits"), keys).groupBy(*keys).agg(_bounded(found).alias("value"))


def metric_rollup(points: DataFrame, period: int, names: Sequence[str] = tuple(PLAIN), by: Sequence[str] = ()):
    """Statistics of every series at once: by namespace, metric and dimensions, or by `by` instead.

    Takes every statistic that `statistic` reads. The thresholds of all percentile-based ones come from one pass of exact
    percentiles over all series, and one more pass aggregates everything.
    """
    found = [statistic(name) for name in names]
    keyed = points.withColumn("bucket_ms", period_bucket(F.col("timestamp_ms"), period))
    if not by:
        keyed = keyed.withColumn("dimensions_key", dimensions_key(F.col("dimensions")))
        by = ["namespace", "metric_name", "dimensions_key"]
    keys = [*by, "bucket_ms"]
    rows = keyed.select(*keys, "value")
    bounds = sorted({bound for one in found for bound in one.bounds})
    if bounds:
        limits = pin(group_percentiles(rows, keys, "value", [bound / 100 for bound in bounds]), "limits")
        rows = join_groups(rows, limits, keys, "left")
    at = {bound: f"q{i}" for i, bound in enumerate(bounds)}

    def one(f: Statistic) -> Column:
        return _plain(f.name) if f.kind == "plain" else _bounded(f, [at[bound] for bound in f.bounds])

    return rows.groupBy(*keys).agg(*[one(f).alias(column_name(f.name)) for f in found])


def column_name(name: str) -> str:
    """A statistic's name as a column: `sample_count`, `p99_9`."""
    return re.sub(r"(?<!^)(?=[A-Z])", "_", name).lower().replace(".", "_")


def metric_cardinality(points: DataFrame) -> DataFrame:
    """Number of distinct series: namespace, metric name and dimension set."""
    series = points.select("namespace", "metric_name", dimensions_key(F.col("dimensions")).alias("dimensions_key"))
    return series.distinct().agg(F.count(F.lit(1)).alias("series"))


def log_stats(
    events: DataFrame, where: Column | None, aggregates: Mapping[str, Column], by: Mapping[str, Column | str]
) -> DataFrame:
    """Grouped aggregates over filtered log rows: named group expressions and named aggregates."""
    if where is not None:
        events = events.filter(where)
    groups = [(F.col(e) if isinstance(e, str) else e).alias(name) for name, e in by.items()]
    return events.groupBy(*groups).agg(*[column.alias(name) for name, column in aggregates.items()])


def distinct_count(column: Column | str, exact: bool = False) -> Column:
    """Distinct count as an aggregate: a bounded sketch, or exact."""
    return F.count_distinct(column) if exact else F.approx_count_distinct(column)

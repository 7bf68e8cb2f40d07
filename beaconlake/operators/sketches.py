"""Period statistics kept as mergeable sketches, so that coarser periods need no data points.

A stored row holds, for one series and period, the plain sums and two sketches: of the values' ranks (KLL) and of
the distinct values (HLL). Rows of finer periods merge into those of coarser ones by sums, minima and sketch unions, which
combine before the shuffle, so that a year is read from rows of days and a series of any size is one small row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake.functions.attributes import dimensions_key
from beaconlake.operators.statistics import Statistic, column_name, period_bucket, statistic

SERIES = ["namespace", "metric_name", "dimensions_key"]
#: KLL size and, for that size, twice the rank error that it keeps in 99 of 100 cases.
RANK_SIZE, RANK_ERROR = 400, 2 * 0.0067
#: log2 of HLL registers and five times the relative standard error of its counts.
DISTINCT_BITS, DISTINCT_ERROR = 12, 5 * 1.04 / 2 ** (12 / 2)
#: Values at which a mean over ranks is taken.
_STEPS = 256


def sketch_periods(points: DataFrame, period: int, by: Sequence[str] = ()) -> DataFrame:
    """One row per series (or `by`) and period of `period` seconds: plain sums, `ranks` and `distinct`.

    NULL values count nowhere; a period with nothing else keeps its row, with a count of 0. NaN counts as a value.
    """
    rows = points.withColumn("bucket_ms", period_bucket(F.col("timestamp_ms"), period))
    if not by:
        rows, by = rows.withColumn("dimensions_key", dimensions_key(F.col("dimensions"))), SERIES
    value = F.col("value").cast("double")
    return rows.groupBy(*by, "bucket_ms").agg(
        F.count(value).alias("n"),
        F.sum(value).alias("total"),
        F.min(value).alias("least"),
        F.max(value).alias("most"),
        F.kll_sketch_agg_double(value, F.lit(RANK_SIZE)).alias("ranks"),
        F.hll_sketch_agg(value.cast("string"), F.lit(DISTINCT_BITS)).alias("distinct"),
    )


def merge_periods(stored: DataFrame, period: int, by: Sequence[str] | None = None) -> DataFrame:
    """Stored rows merged to periods of `period` seconds, which must be a multiple of theirs, or over fewer columns.

    `by` are the columns to keep, all but the statistics when not given.
    """
    values = ["bucket_ms", "n", "total", "least", "most", "ranks", "distinct"]
    by = [c for c in stored.columns if c not in values] if by is None else by
    rows = stored.withColumn("bucket_ms", period_bucket(F.col("bucket_ms"), period))
    return rows.groupBy(*by, "bucket_ms").agg(
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.kll_merge_agg_double(F.when(F.col("n") > 0, F.col("ranks"))).alias("ranks"),
        F.hll_union_agg("distinct").alias("distinct"),
    )


def _mean(low: float, high: float) -> Column:
    """Mean of the values between two ranks, from the sketch's values at even steps."""
    ranks = F.array(*[F.lit(low + (high - low) * (i + 0.5) / _STEPS) for i in range(_STEPS)])
    return F.aggregate(F.kll_sketch_get_quantile_double("ranks", ranks), F.lit(0.0), lambda a, v: a + v) / _STEPS


def _read(found: Statistic) -> Column:
    plain = {
        "Sum": F.col("total"), "Average": F.col("total") / F.col("n"), "Maximum": F.col("most"), "Minimum": F.col("least"),
        "SampleCount": F.col("n").cast("double"),
    }
    if found.kind == "plain":
        return plain[found.name]
    share = found.bounds[0] / 100
    if found.kind == "iqm":
        return _mean(0.25, 0.75)
    limit = F.kll_sketch_get_quantile_double("ranks", F.lit(share))
    kept = F.greatest(F.lit(1.0), F.round(F.col("n") * share).cast("double"))
    return {
        "p": limit, "tm": _mean(0.0, share), "tc": kept, "ts": kept * _mean(0.0, share),
        "wm": _mean(0.0, share) * share + limit * (1 - share),
    }[found.kind]


def read_sketches(stored: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named statistics of stored rows, and `distinct_values`; NULL where a period has no value, its count excepted.

    Plain statistics are exact. A percentile is a value whose rank is within RANK_ERROR of the wanted one, the
    percentile-based means, counts and sums follow from the sketch's ranks.
    """
    found = [statistic(name) for name in names]
    values = ["n", "total", "least", "most", "ranks", "distinct"]
    keys = [F.col(c) for c in stored.columns if c not in values]

    def known(one: Statistic) -> Column:
        return _read(one) if one.name in ("Sum", "Maximum", "Minimum", "SampleCount") else F.when(F.col("n") > 0, _read(one))

    columns = [known(one).alias(column_name(one.name)) for one in found]
    return stored.select(*keys, *columns, F.hll_sketch_estimate("distinct").alias("distinct_values"))


def rank_within(value: str, share: float, below: str, upto: str, count: str, error: float = RANK_ERROR) -> Column:
    """Whether a value with `below` smaller and `upto` smaller or equal of `count` values has rank `share` but for `error`.

    One value's worth of rank is allowed, too, as ranks of few values are coarse.
    """
    slack = F.lit(error) + 1 / F.col(count)
    return F.col(value).isNotNull() & (F.col(below) / F.col(count) - slack <= share) & (share <= F.col(upto) / F.col(count) + slack)

"""Continuous period statistics of metric data points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from beaconlake.functions.attributes import dimensions_key
from beaconlake.streaming.tables import write_batch


def stream_metric_rollup(points: DataFrame, period: int, lateness: str) -> DataFrame:
    """Plain statistics per series and period of a stream of data points.

    A period is final once the latest time seen is `lateness` past its end; later points of it are dropped. Periods
    start at multiples of `period` seconds, as in the batch rollup. Written in append mode only final periods come out;
    `write_periods` gives all.
    """
    if period <= 0:
        raise ValueError("period must be positive")
    stamped = points.withColumn("event_time", F.timestamp_millis("timestamp_ms")).withWatermark("event_time", lateness)
    value = F.col("value")
    grouped = stamped.groupBy(
        F.window("event_time", f"{period} seconds").alias("w"),
        "namespace",
        "metric_name",
        dimensions_key(F.col("dimensions")).alias("dimensions_key"),
    ).agg(
        F.sum(value).alias("sum"),
        F.avg(value).alias("average"),
        F.max(value).alias("maximum"),
        F.min(value).alias("minimum"),
        F.count(value).cast("double").alias("sample_count"),
    )
    return grouped.select(
        "namespace",
        "metric_name",
        "dimensions_key",
        F.unix_millis("w.start").alias("bucket_ms"),
        "sum",
        "average",
        "maximum",
        "minimum",
        "sample_count",
    )


def write_periods(periods: DataFrame, out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Writes every period a micro-batch has changed to a folder of that micro-batch, open periods too.

    A micro-batch that runs again replaces its folder, and another stream, or one with a new checkpoint, has folders of
    its own. `read_periods` takes the newest state of each period, so nothing is missing when a bounded input ends
    before its last periods are final.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, out, batch_id, dated=False)

    writer = periods.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_periods(spark: SparkSession, out: str) -> DataFrame:
    """Every period that `write_periods` wrote: of each stream its newest state, added up over streams.

    A stream's state of a period is small, so its newest is a grouped maximum by micro-batch.
    """
    keys = ["namespace", "metric_name", "dimensions_key", "bucket_ms"]
    rows = spark.read.parquet(out)
    state = F.struct("sum", "maximum", "minimum", "sample_count")
    newest = rows.groupBy(*keys, "stream").agg(F.max_by(state, F.col("batch").cast("long")).alias("s")).select(*keys, "s.*")
    return newest.groupBy(*keys).agg(
        F.sum("sum").alias("sum"),
        (F.sum("sum") / F.nullif(F.sum("sample_count"), F.lit(0.0))).alias("average"),
        F.max("maximum").alias("maximum"),
        F.min("minimum").alias("minimum"),
        F.sum("sample_count").alias("sample_count"),
    )

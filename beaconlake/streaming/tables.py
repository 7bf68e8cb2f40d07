"""Received tables on the lake: dated parquet folders that replays cannot double."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake import schemas
from beaconlake.operators.registry import delete_groups
from beaconlake.storage import pin, remove


def event_date(stamp_ms: Column) -> Column:
    """UTC day of an epoch millisecond."""
    return F.date_from_unix_date(F.floor(stamp_ms / 86_400_000).cast("int"))


def _dated(rows: DataFrame) -> DataFrame:
    # Rebalancing groups each day's rows into few files and splits days that are too large for one.
    return rows.withColumn("event_date", event_date(F.col("timestamp_ms"))).hint("rebalance", "event_date")


def append_events(events: DataFrame, path: str) -> None:
    """Appends events to the received table, in one folder per day."""
    rows = schemas.require(events, schemas.RAW_EVENTS, "log events").select(*schemas.RAW_EVENTS.names)
    _dated(rows).write.mode("append").partitionBy("event_date").parquet(path)


def append_metrics(points: DataFrame, path: str) -> None:
    """Appends data points to the received table, unaggregated, in one folder per day."""
    rows = schemas.require(points, schemas.RAW_METRICS, "metric data").select(*schemas.RAW_METRICS.names)
    _dated(rows).write.mode("append").partitionBy("event_date").parquet(path)


def delete_stored_groups(registry: DataFrame, path: str, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New registry and outcomes as of `delete_groups`; the groups' events leave the received table at `path`.

    Only days that hold one of the groups are written anew: their other events are staged in the shared folder first and
    then replace these days' folders, and a day of which nothing is left loses its folder. Other days keep their
    files. After a failure half-way the same call can be made again, and once more changes nothing.
    """
    spark = registry.sparkSession
    events = spark.read.parquet(path)
    left, _, outcomes = delete_groups(registry, events, names)
    gone = pin(outcomes.filter(F.col("outcome") == "deleted").select("log_group").distinct(), "deleted-groups")
    hit = events.join(gone, "log_group", "left_semi").select("event_date").distinct()
    days = [r.event_date for r in hit.collect()]  # one value a day
    if days:
        rest = events.filter(F.col("event_date").isin(days)).join(gone, "log_group", "left_anti").select(events.columns)
        staged = pin(rest, "kept-events")
        kept = {r.event_date for r in staged.select("event_date").distinct().collect()}
        staged.hint("rebalance", "event_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)
        remove(spark, [f"{path}/event_date={day}" for day in days if day not in kept])
    return left, outcomes


def batch_folder(spark: SparkSession, path: str, batch_id: int) -> str:
    """The folder of one micro-batch, named by the stream's id, which its checkpoint keeps over restarts, and its number."""
    stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
    return f"{path}/stream={stream}/batch={batch_id}"


def write_batch(rows: DataFrame, path: str, batch_id: int, dated: bool = True) -> None:
    """Writes one micro-batch to its own folder and replaces what an earlier try left there.

    Another stream into the same `path`, or one with a new checkpoint, has folders of its own.
    """
    target = batch_folder(rows.sparkSession, path, batch_id)
    if dated:
        _dated(rows).write.mode("overwrite").partitionBy("event_date").parquet(target)
    else:
        rows.write.mode("overwrite").parquet(target)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The received events, with `event_date` for pruning."""
    found = spark.read.parquet(path)
    return schemas.require(found, schemas.RAW_EVENTS, path).select(*schemas.RAW_EVENTS.names, "event_date")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The received data points, with `event_date` for pruning."""
    found = spark.read.parquet(path)
    return schemas.require(found, schemas.RAW_METRICS, path).select(*schemas.RAW_METRICS.names, "event_date")

"""Continuous intake of landed request bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from beaconlake import schemas, storage
from beaconlake.operators.registry import known_destination, unregistered
from beaconlake.sources.bodies import (
    decode_put_log_bodies,
    judge_metric_bodies,
    metric_dead_letters,
    metric_points,
)
from beaconlake.streaming.tables import batch_folder, write_batch

BODIES = "body_seq long, received_ms long, body string"


def _start(stream: DataFrame, write, checkpoint: str, once: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _once_each(bodies: DataFrame, redelivered: str | None) -> DataFrame:
    """Bodies without those whose number came before, within the time `redelivered` of when they were received."""
    if redelivered is None:
        return bodies
    stamped = bodies.withColumn("_received_at", F.timestamp_millis("received_ms")).withWatermark("_received_at", redelivered)
    return stamped.dropDuplicatesWithinWatermark(["body_seq"]).drop("_received_at")


def read_registry(spark: SparkSession, registry_path: str, out: str | None = None, but: str | None = None) -> DataFrame:
    """The registry and, with `out`, what intake into it has created, one row per group or stream, the oldest.

    `but` is a folder of one micro-batch that is left out.
    """
    rows = spark.read.schema(schemas.REGISTRY).parquet(registry_path)
    if out is None:
        return rows
    added = spark.read.schema(schemas.REGISTRY).option("recursiveFileLookup", "true")
    created = storage.folders(spark, f"{out}/registry/stream=*/batch=*", but)
    if created:
        rows = rows.unionByName(added.parquet(*created))
    oldest = rows.groupBy("log_group", "log_stream").agg(
        F.min_by("retention_in_days", "created_ms").alias("retention_in_days"), F.min("created_ms").alias("created_ms")
    )
    return oldest.select(*schemas.REGISTRY.names)


def stream_ingest_logs(
    bodies: DataFrame,
    registry_path: str,
    out: str,
    checkpoint: str,
    once: bool = True,
    create: bool = False,
    redelivered: str | None = None,
) -> StreamingQuery:
    """Log bodies to `out/events`, events without a registered destination to `out/rejected`, bad bodies to `out/dead`.

    The registry is read anew for every micro-batch. Each micro-batch replaces its own folders, so a replay after a
    lost driver or executor adds nothing twice. With `create` no event is rejected: groups and streams that are not
    registered are added to `out/registry`, in a folder of the stream and micro-batch, for `read_registry`. With
    `redelivered`, a time such as "1 hour", a body whose number was received before, at most so long ago, is left out,
    over micro-batches and restarts.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        events, dead = decode_put_log_bodies(batch)
        if create:
            events = events.persist()
            own = batch_folder(spark, f"{out}/registry", batch_id)
            known = read_registry(spark, registry_path, out, but=own)
            write_batch(unregistered(known, events), f"{out}/registry", batch_id, dated=False)
            judged = events.withColumn("problem", F.lit(None).cast("string"))
        else:
            judged = known_destination(events, read_registry(spark, registry_path)).persist()
        try:
            write_batch(judged.filter(F.col("problem").isNull()).drop("problem"), f"{out}/events", batch_id)
            write_batch(judged.filter(F.col("problem").isNotNull()), f"{out}/rejected", batch_id, dated=False)
            write_batch(dead, f"{out}/dead", batch_id, dated=False)
        finally:
            (events if create else judged).unpersist()

    return _start(_once_each(bodies, redelivered), write, checkpoint, once)


def stream_ingest_metrics(
    bodies: DataFrame, out: str, checkpoint: str, once: bool = True, redelivered: str | None = None
) -> StreamingQuery:
    """Metric bodies to `out/metrics`, bad bodies to `out/dead`, one folder per micro-batch.

    `redelivered` is that of `stream_ingest_logs`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        judged = judge_metric_bodies(batch).persist()
        try:
            write_batch(metric_points(judged), f"{out}/metrics", batch_id)
            write_batch(metric_dead_letters(judged), f"{out}/dead", batch_id, dated=False)
        finally:
            judged.unpersist()

    return _start(_once_each(bodies, redelivered), write, checkpoint, once)

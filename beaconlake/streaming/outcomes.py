"""Outcomes of delivered events, joined continuously with the responses to their batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconlake.operators.delivery import LOG_BATCH, put_outcome, read_responses


def stream_put_outcomes(planned: DataFrame, responses: DataFrame, limit: str = "10 minutes", lateness: str = "1 minute") -> DataFrame:
    """`status` of each event of a stream as in `reconcile_put`; NULL if its batch got no response within `limit`.

    `planned` has `sent_ms`, `responses` `received_ms`, both epoch milliseconds and at most `lateness` out of order. A
    response counts from the moment the event was sent until `limit` later. Events whose batch is answered come out
    at once, the others when both streams are past the limit, so that the state holds no more than that time's events.
    A second response to a batch that comes while the first is remembered is left out, whatever it says.
    """
    sent = planned.withColumn("_sent_at", F.timestamp_millis("sent_ms")).withWatermark("_sent_at", lateness)
    answers = read_responses(responses, "received_ms").withColumn("_received_at", F.timestamp_millis("received_ms"))
    answers = answers.withWatermark("_received_at", lateness).dropDuplicatesWithinWatermark(LOG_BATCH)
    answers = answers.withColumnsRenamed({c: f"_{c}" for c in LOG_BATCH})
    same = F.expr(f"_received_at >= _sent_at AND _received_at <= _sent_at + INTERVAL {limit}")
    for c in LOG_BATCH:
        same = same & (F.col(c) == F.col(f"_{c}"))
    return sent.join(answers, same, "left_outer").select(*planned.columns, put_outcome().alias("status"))

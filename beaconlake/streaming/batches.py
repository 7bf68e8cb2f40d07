"""Delivery batches of a stream of events: one open batch per destination, closed by its limits or a timer."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from beaconlake.functions import checks
from beaconlake.operators import batching
from beaconlake.operators.batching import Limits, next_starts, sized_events
from beaconlake.streaming.tables import write_batch

# The functions below travel to executors with their code, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(batching)

#: The open batch of a destination: its number and sums, never its events.
_STATE = "batch_no long, events long, bytes long, first_ms long, last_ms long"
_OUTPUT = (
    "log_group string, log_stream string, seq long, timestamp_ms long, batch_no long, index_in_batch long, "
    "events long, bytes long, first_ms long, last_ms long, closed_by string"
)
_COLUMNS = [part.split()[0] for part in _OUTPUT.split(", ")]
_TEXTS = ["log_group", "log_stream", "closed_by"]
_NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


def _rows(key: tuple, **columns) -> pd.DataFrame:
    rows = pd.DataFrame({"log_group": key[0], "log_stream": key[1], **columns}).reindex(columns=_COLUMNS)
    return rows.astype({c: object if c in _TEXTS else "Int64" for c in _COLUMNS})


def _closed(key: tuple, batches: list[tuple]) -> pd.DataFrame:
    """Rows of closed batches, given the state of each and what closed it."""
    number, events, size, first, last, reason = zip(*batches)
    return _rows(key, batch_no=number, events=events, bytes=size, first_ms=first, last_ms=last, closed_by=reason)


def _fitting(state: list[int], stamps: np.ndarray, total: np.ndarray, limits: Limits) -> int:
    """How many of the next events, of running sizes `total`, the open batch takes."""
    most = min(len(stamps), limits.count - state[1], int(np.searchsorted(total, limits.size - state[2], side="right")))
    return max(0, min(most, int(np.searchsorted(stamps, state[3] + limits.span_ms, side="right"))))


def _reason(state: list[int], size: int, limits: Limits) -> str:
    if state[1] >= limits.count:
        return "events"
    return "bytes" if state[2] + size > limits.size else "span"


def _batching(limits: Limits, linger_ms: int) -> Callable:
    def update(key: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        state = list(held.get) if held.exists else [0, 0, 0, 0, 0]
        if held.hasTimedOut:
            if state[1]:
                yield _closed(key, [(*state, "timer")])
                held.update((state[0] + 1, 0, 0, 0, 0))
            return
        # only numbers, and only of this micro-batch
        found = pd.concat([frame[["timestamp_ms", "seq", "size"]] for frame in frames]).sort_values(["timestamp_ms", "seq"])
        stamps, sizes, seqs = (found[c].to_numpy(np.int64) for c in ("timestamp_ms", "size", "seq"))
        total = np.concatenate([[0], np.cumsum(sizes)])
        ends = next_starts(stamps, sizes, limits)
        number, index, closed = np.empty(len(seqs), np.int64), np.empty(len(seqs), np.int64), []
        at = 0
        while at < len(seqs):
            if state[1]:
                end = at + _fitting(state, stamps[at:], total[at + 1 :] - total[at], limits)
                if end == at:
                    closed.append((*state, _reason(state, int(sizes[at]), limits)))
                    state = [state[0] + 1, 0, 0, 0, 0]
                    continue
            else:
                end, state[3] = int(ends[at]), int(stamps[at])
            number[at:end], index[at:end] = state[0], state[1] + np.arange(end - at)
            state[1], state[2], state[4] = state[1] + end - at, state[2] + int(total[end] - total[at]), int(stamps[end - 1])
            at = end
        held.update(tuple(state))
        held.setTimeoutDuration(linger_ms)
        yield _rows(key, seq=seqs, timestamp_ms=stamps, batch_no=number, index_in_batch=index)
        if closed:
            yield _closed(key, closed)

    return update


def stream_log_batches(
    events: DataFrame,
    linger_ms: int,
    max_events: int = checks.MAX_BATCH_EVENTS,
    max_bytes: int = checks.MAX_BATCH_BYTES,
    overhead: int = checks.EVENT_OVERHEAD,
    max_span_ms: int = checks.MAX_SPAN_MS,
    bad_messages: str = "raise",
) -> DataFrame:
    """The batch of each event of a stream, and a row for each batch that is closed.

    Events are taken destination by destination in the order of time and `seq` within a micro-batch, and joined to the
    destination's open batch as `plan_log_batches` would; if their order holds over micro-batches, so does the whole
    plan. Event rows have `seq`, `batch_no` and `index_in_batch`. A batch is closed, with a row of its sums and
    `closed_by`, by the event that would exceed its `events`, `bytes` or `span`, or by a `timer` once no event has come for
    `linger_ms` of processing time. The state of a destination is five numbers.
    """
    sized = sized_events(events, overhead, bad_messages).select(
        "log_group", "log_stream", "timestamp_ms", "seq", F.col("_size").alias("size")
    )
    return sized.groupBy("log_group", "log_stream").applyInPandasWithState(
        _batching(Limits(max_events, max_bytes, max_span_ms), linger_ms), _OUTPUT, _STATE, "append", GroupStateTimeout.ProcessingTimeTimeout
    )


def write_log_batches(batches: DataFrame, out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Event rows to `out/planned` and closed batches to `out/closed`, one folder per micro-batch.

    A micro-batch that runs again replaces its folders, and the state is that of the checkpoint. With `once`, timers that
    are due run out with the next data.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            planned = batch.filter(F.col("closed_by").isNull())
            write_batch(planned.select(*_COLUMNS[:6]), f"{out}/planned", batch_id, dated=False)
            closed = batch.filter(F.col("closed_by").isNotNull())
            write_batch(closed.select(*_COLUMNS[:2], "batch_no", *_COLUMNS[6:]), f"{out}/closed", batch_id, dated=False)
        finally:
            batch.unpersist()

    writer = batches.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    if not once:
        return writer.start()
    # with timers there would always be one more micro-batch to run, and a bounded run would not end
    conf = batches.sparkSession.conf
    before = conf.get(_NO_DATA)
    conf.set(_NO_DATA, "false")
    try:
        return writer.trigger(availableNow=True).start()
    finally:
        conf.set(_NO_DATA, before)

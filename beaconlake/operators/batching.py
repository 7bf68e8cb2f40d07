"""Exact greedy batches per destination, spread over tasks even when one destination holds most rows.

A batch takes the next events in order until one would break a limit, so where a batch starts depends on all
batches before it. Destinations of up to one chunk of rows are cut whole, each in one task.

Larger ones are split: their ordered rows are cut into chunks of equal row count. A batch spans at most
`limits.count` rows, so a chunk plus the first rows of the next one is enough to tell, for every row at which a
batch could start, where the first batch of the next chunk would then start. These maps are short, and two of neighbouring
runs of chunks make one of both. Pairing them up, and going down again from the whole to its halves, gives each chunk's
first batch in rounds as many as twice the logarithm of the chunks, in each of which a task holds two maps of a
destination. Then all chunks are cut in parallel.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconlake.functions import checks
from beaconlake.operators.delivery import datum_bytes
from beaconlake.operators.ordering import with_position
from beaconlake.storage import pin

# The functions below travel to executors with their code, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_ROWS = 250_000


@dataclass(frozen=True)
class Limits:
    """What one batch may hold: rows, bytes and, if any, milliseconds from its first to its last row."""

    count: int
    size: int
    span_ms: int | None = None


def next_starts(stamps: np.ndarray, sizes: np.ndarray, limits: Limits) -> np.ndarray:
    """For each row, the row after the last one of a batch that starts there."""
    rows = len(sizes)
    here = np.arange(rows)
    total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    fits = np.searchsorted(total, total[:-1] + limits.size, side="right") - 1
    ends = np.minimum(fits, here + limits.count)
    if limits.span_ms is not None:
        most = np.iinfo(np.int64).max
        latest = np.where(stamps <= most - limits.span_ms, stamps + limits.span_ms, most)
        ends = np.minimum(ends, np.searchsorted(stamps, latest, side="right"))
    return np.clip(ends, here + 1, rows)


def _runs(frames: Iterable[pd.DataFrame], keys: Sequence[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """Sorted frames cut into one frame per key, also where a key crosses frames."""
    held: list[pd.DataFrame] = []
    current: tuple | None = None
    for frame in frames:
        if frame.empty:
            continue
        shifted = frame[list(keys)].shift()
        fresh = ((frame[list(keys)] != shifted) & ~(frame[list(keys)].isna() & shifted.isna())).any(axis=1).to_numpy()
        fresh[0] = True
        cuts = [*np.flatnonzero(fresh), len(frame)]
        for start, stop in zip(cuts, cuts[1:]):
            part = frame.iloc[start:stop]
            key = tuple(None if pd.isna(value) else value for value in part.iloc[0][list(keys)])
            if current is not None and key != current:
                yield current, pd.concat(held, ignore_index=True)
                held = []
            current = key
            held.append(part)
    if current is not None:
        yield current, pd.concat(held, ignore_index=True)


#: A segment of the map from the first batch start in some chunks to that in the chunk after them: its lowest and the end
#: of its starts, the start that follows and its step per row, the batches that start in the chunks, and the position of
#: the last of these starts and its step per row.
_SEGMENT = ["low", "high", "follow", "step", "count", "late", "late_step"]


def _chunk_maps(frame: pd.DataFrame, chunk: int, limits: Limits, chunk_rows: int) -> list[tuple[int, ...]]:
    """The segments of one chunk."""
    rows = int((~frame["halo"]).sum())
    ends = next_starts(frame["ts"].to_numpy(), frame["size"].to_numpy(), limits)[:rows]
    # An open batch that began before the chunk ends no later than one that begins at its first row.
    starts = np.arange(1 if chunk == 0 else min(int(ends[0]), rows - 1) + 1)
    at, batches, last = starts.copy(), np.zeros(len(starts), np.int64), starts.copy()
    moving = np.arange(len(starts))
    while len(moving):  # a step a batch, for all starts at once
        last[moving] = at[moving]
        at[moving], batches[moving] = ends[at[moving]], batches[moving] + 1
        moving = moving[at[moving] < rows]
    following = at - rows
    # a segment goes on while batches agree and both places move on by the same step, 0 or 1 a row
    follow_step, last_step = np.diff(following), np.diff(last)
    smooth = (np.diff(batches) == 0) & (follow_step >= 0) & (follow_step <= 1) & (last_step >= 0) & (last_step <= 1)
    segments: list[tuple[int, ...]] = []
    low = 0
    while low < len(starts):
        step, late_step, high = 0, 0, low + 1
        if low < len(smooth) and smooth[low]:
            step, late_step = int(follow_step[low]), int(last_step[low])
            same = smooth[low:] & (follow_step[low:] == step) & (last_step[low:] == late_step)
            high = low + 1 + (len(same) if same.all() else int(np.argmin(same)))
        segments.append((low, high, int(following[low]), step, int(batches[low]), chunk * chunk_rows + int(last[low]), late_step))
        low = high
    return segments


def _composed(first: np.ndarray, second: np.ndarray) -> list[list[int]]:
    """The segments of two neighbouring runs of chunks, one after the other, from theirs.

    A start that the second run does not have lies past the destination's end and is left out.
    """
    made: list[list[int]] = []
    lows, ends = second[:, 0], int(second[-1, 1])
    for low, high, follow, step, count, _, _ in first.tolist():
        while low < high and follow < ends:
            at = second[int(np.searchsorted(lows, follow, side="right")) - 1].tolist()
            away = follow - at[0]
            upto = min(high, low + at[1] - follow) if step else high
            one = [low, upto, at[2] + at[3] * away, at[3] * step, count + at[4], at[5] + at[6] * away, at[6] * step]
            low, follow = upto, follow + (upto - low) * step
            if made and made[-1][1] == one[0] and not made[-1][3] and not made[-1][6] and made[-1][2:] == one[2:]:
                made[-1][1] = one[1]
            else:
                made.append(one)
    return made


def _halved(entries: DataFrame, maps: DataFrame, names: list[str]) -> DataFrame:
    """What is open where each half of a run of chunks begins, given it for the runs and the maps of the first halves."""
    halves = entries.withColumn("chunk", F.col("chunk") * 2)
    keys = [*names, "chunk"]
    away = F.col("entry") - F.col("low")
    met = halves.join(_aside(maps, keys), _matches(keys) & (F.col("entry") >= F.col("low")) & (F.col("entry") < F.col("high")))
    later = met.select(
        *names, (F.col("chunk") + 1).alias("chunk"), (F.col("follow") + F.col("step") * away).alias("entry"),
        (F.col("base") + F.col("count")).alias("base"), (F.col("late") + F.col("late_step") * away).alias("opened"),
    )
    return halves.unionByName(later)


def _cut(frame: pd.DataFrame, limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """Batch number and place in the batch of a chunk's rows, given its first batch start and what is open."""
    rows = len(frame)
    position = frame["position"].to_numpy()
    entry, base, opened = (int(frame[name].iloc[0]) for name in ("entry", "base", "opened"))
    ends = next_starts(frame["ts"].to_numpy(), frame["size"].to_numpy(), limits)
    starts = []
    at = entry
    while at < rows:
        starts.append(at)
        at = int(ends[at])
    number = np.full(rows, base - 1, dtype=np.int64)
    begun = np.full(rows, opened, dtype=np.int64)
    if starts:
        which = np.searchsorted(starts, np.arange(rows), side="right")
        number = base - 1 + which
        begun = np.where(which > 0, position[np.array(starts)[np.maximum(which, 1) - 1]], opened)
    return number, position - begun


def _long(*columns: str) -> list[T.StructField]:
    return [T.StructField(column, T.LongType()) for column in columns]


def _matches(names: Sequence[str]) -> Column:
    """Join condition of the named columns with their counterparts that start with an underscore."""
    same = F.lit(True)
    for name in names:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    return same


def _aside(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({name: f"_{name}" for name in names})


def _cut_whole(narrow: DataFrame, names: list[str], limits: Limits, result: T.StructType) -> DataFrame:
    """Batches of destinations that are at most one chunk."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, frame in _runs(frames, names):
            ready = frame.assign(position=np.arange(len(frame)), entry=0, base=0, opened=0)
            number, index = _cut(ready, limits)
            yield frame[[*names, "seq"]].assign(batch_no=number, index_in_batch=index)

    return narrow.repartition(*names).sortWithinPartitions(*names, "ts", "seq").mapInPandas(cut, result)


def _cut_split(narrow: DataFrame, names: list[str], limits: Limits, chunk_rows: int, result: T.StructType) -> DataFrame:
    """Batches of destinations of several chunks."""
    placed = with_position(narrow, names, [F.col("ts").asc(), F.col("seq").asc()])
    placed = placed.withColumn("chunk", F.floor(F.col("position") / chunk_rows).cast("long"))
    key_fields = [field for field in placed.schema.fields if field.name in names]
    order = [*names, "chunk", "position"]
    shape = T.StructType([*key_fields, *_long("chunk", *_SEGMENT)])

    def maps(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for key, frame in _runs(frames, [*names, "chunk"]):
            found = _chunk_maps(frame, int(key[-1]), limits, chunk_rows)
            yield pd.DataFrame([(*key, *one) for one in found], columns=[*names, "chunk", *_SEGMENT])

    def paired(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for key, frame in _runs(frames, [*names, "pair"]):
            odd = frame["chunk"].to_numpy() % 2 == 1
            if odd.any() and not odd.all():
                made = _composed(frame.loc[~odd, _SEGMENT].to_numpy(), frame.loc[odd, _SEGMENT].to_numpy())
                yield pd.DataFrame([(*key, *one) for one in made], columns=[*names, "chunk", *_SEGMENT])

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, frame in _runs(frames, [*names, "chunk"]):
            number, index = _cut(frame, limits)
            yield frame[[*names, "seq"]].assign(batch_no=number, index_in_batch=index)

    # The first rows of a chunk also end the chunk before, where they only help to find the next start.
    overlap = (F.col("position") % chunk_rows < limits.count) & (F.col("chunk") > 0)
    own = F.struct(F.col("chunk").alias("chunk"), F.lit(False).alias("halo"))
    before = F.struct((F.col("chunk") - 1).alias("chunk"), F.lit(True).alias("halo"))
    widened = placed.select(
        *names, "position", "ts", "size", F.inline(F.when(overlap, F.array(own, before)).otherwise(F.array(own)))
    )
    mapped = widened.repartition(*names, "chunk").sortWithinPartitions(*order).mapInPandas(maps, shape)
    levels = [pin(mapped, "chunk-maps")]
    chunks = levels[0].agg(F.max("chunk")).first()[0] + 1
    while 1 << len(levels) < chunks:
        halves = levels[-1].withColumn("pair", F.floor(F.col("chunk") / 2).cast("long"))
        both = halves.repartition(*names, "pair").sortWithinPartitions(*names, "pair", "chunk", "low")
        levels.append(pin(both.mapInPandas(paired, shape), "chunk-maps"))
    entries = placed.select(*names).distinct().select(*names, *[F.lit(0).cast("long").alias(c) for c in ("chunk", "entry", "base", "opened")])
    for level in reversed(levels):
        entries = pin(_halved(entries, level, names), "chunk-entries")
    keys = [*names, "chunk"]
    ready = placed.join(_aside(entries, keys), _matches(keys)).select(
        *keys, "position", "ts", "seq", "size", "entry", "base", "opened"
    )
    return ready.repartition(*keys).sortWithinPartitions(*order).mapInPandas(cut, result)


def assign_batches(
    rows: DataFrame,
    keys: Sequence[str],
    seq: str,
    size: str,
    limits: Limits,
    stamp: str | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Keys and `seq` of each row with its `batch_no` in the destination and `index_in_batch`, both from 0.

    Order is by `stamp` (if any), then `seq`, which must be unique within a destination. Counts the rows of each
    destination first, to know which ones to split.
    """
    if chunk_rows < limits.count:
        raise ValueError("chunk_rows must be at least the row limit of a batch")
    names = [f"k{i}" for i in range(len(keys))]
    narrow = rows.select(
        *[F.col(key).alias(name) for key, name in zip(keys, names)],
        (F.col(stamp) if stamp else F.lit(0)).cast("long").alias("ts"),
        F.col(seq).alias("seq"),
        F.col(size).cast("long").alias("size"),
    )
    kept = [field for field in narrow.schema.fields if field.name in (*names, "seq")]
    result = T.StructType([*kept, *_long("batch_no", "index_in_batch")])
    large = narrow.groupBy(*names).count().filter(F.col("count") > chunk_rows).select(*names)
    large = pin(large, "large")
    if large.isEmpty():
        found = _cut_whole(narrow, names, limits, result)
    else:
        large = _aside(large, names)
        found = _cut_whole(narrow.join(large, _matches(names), "left_anti"), names, limits, result).unionByName(
            _cut_split(narrow.join(large, _matches(names), "left_semi"), names, limits, chunk_rows, result)
        )
    return found.select(
        *[F.col(name).alias(key) for key, name in zip(keys, names)],
        F.col("seq").alias(seq),
        "batch_no",
        "index_in_batch",
    )


def _planned(sized: DataFrame, keys: list[str], limits: Limits, stamp: str | None, chunk_rows: int, dear: bool) -> DataFrame:
    """`sized` without `_size`, planned. NULL is a destination like any other.

    What the plan needs is worked out once and written, as counting and planning both read it: only the numbers of
    rows that cost little to read again for the join back, all columns of `dear` ones.
    """
    narrow = [c for c in dict.fromkeys([*keys, stamp, "seq", "_size"]) if c]
    written = pin(sized if dear else sized.select(*narrow), "sized")
    found = assign_batches(written, keys, "seq", "_size", limits, stamp, chunk_rows).alias("f")
    rows = written if dear else sized.drop("_size")
    same = F.col("r.seq") == F.col("f.seq")
    for key in keys:
        same = same & F.col(f"r.{key}").eqNullSafe(F.col(f"f.{key}"))
    joined = rows.alias("r").join(found, same)
    return joined.select(*[F.col(f"r.{c}") for c in rows.columns if c != "_size"], "batch_no", "index_in_batch")


def _refused(problem: Column, value: Column) -> Column:
    """`value` where there is no problem, else an error that tells it."""
    return F.when(problem.isNull(), value).otherwise(F.raise_error(problem).cast("long"))


def sized_events(events: DataFrame, overhead: int, bad_messages: str) -> DataFrame:
    """Events with `_size`, their bytes in a batch; those that can't be sent raise or are left out."""
    if bad_messages not in ("raise", "drop"):
        raise ValueError("bad_messages must be 'raise' or 'drop'")
    message = checks.check_message(F.col("message"))
    if bad_messages == "drop":
        events = events.filter(message.isNull())
    problem = F.coalesce(message, F.when(F.col("timestamp_ms").isNull(), F.lit("an event has no time")))
    return events.withColumn("_size", _refused(problem, (F.octet_length("message") + overhead).cast("long")))


def plan_log_batches(
    events: DataFrame,
    max_events: int = checks.MAX_BATCH_EVENTS,
    max_bytes: int = checks.MAX_BATCH_BYTES,
    overhead: int = checks.EVENT_OVERHEAD,
    max_span_ms: int = checks.MAX_SPAN_MS,
    chunk_rows: int = CHUNK_ROWS,
    bad_messages: str = "raise",
) -> DataFrame:
    """Adds `batch_no` and `index_in_batch` to `log_group`, `log_stream`, `timestamp_ms`, `seq` and `message`.

    A message that can't be sent, being NULL, empty or too long, raises; with `bad_messages="drop"` such events are left
    out, for a caller that keeps them by `validate_put`. An event without a time raises.

    Events of a destination go by time, ties by `seq`. A batch closes before an event that would be one too many,
    exceed the bytes (message plus overhead) or lie more than the span after the batch's first event.
    """
    sized = sized_events(events, overhead, bad_messages)
    limits = Limits(max_events, max_bytes, max_span_ms)
    return _planned(sized, ["log_group", "log_stream"], limits, "timestamp_ms", chunk_rows, dear=False)


def plan_metric_batches(
    data: DataFrame,
    max_data: int = checks.MAX_BATCH_DATA,
    max_bytes: int = checks.MAX_DATA_BYTES,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Adds `batch_no` and `index_in_batch` to data points, in input order (`seq`) per namespace and metric."""
    sized = data.withColumn("_size", datum_bytes())
    return _planned(sized, ["namespace", "metric_name"], Limits(max_data, max_bytes), None, chunk_rows, dear=True)

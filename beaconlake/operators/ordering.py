"""Event order, pages of it, and exact row positions without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconlake.storage import pin

MAX_PAGE = 10_000
# Rows that a top-k may hold per task; pages that end further in are found by position. Both give the same page.
TOP_ROWS = 20_000


def _event_order(ascending: bool) -> list[Column]:
    columns = [F.col("timestamp_ms"), F.col("event_id")]
    return [c.asc() if ascending else c.desc() for c in columns]


def order_events(events: DataFrame, ascending: bool = True) -> DataFrame:
    """By time, then event id, both in the same direction."""
    return events.orderBy(*_event_order(ascending))


def with_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "position", tasks: int | None = None
) -> DataFrame:
    """Adds the 0-based place of each row within its key, for a total order within the key.

    Rows are range-sorted over all tasks, so a key of any size is spread; only one count per (task, key) meets
    in a window. The sorted rows are written to the shared folder because the task boundaries must not move between
    counting and numbering: pass narrow rows. `tasks` is the number of parts of the sort, by default
    `spark.sql.shuffle.partitions`.
    """
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(key).asc() for key in keys] + list(order)
    ranged = df.repartitionByRange(tasks, *by).sortWithinPartitions(*by)
    # The id holds the task in its upper bits and the row within the task in the lower 33.
    placed = pin(ranged.withColumn("_at", F.monotonically_increasing_id()), "positions")
    placed = placed.withColumn("_task", F.shiftright("_at", 33))
    runs = placed.groupBy(*keys, "_task").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *[F.col(key).alias(f"_k{i}") for i, key in enumerate(keys)],
        F.col("_task").alias("_t"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    same = F.col("_task") == F.col("_t")
    for i, key in enumerate(keys):
        same = same & F.col(key).eqNullSafe(F.col(f"_k{i}"))
    return placed.join(runs, same).select(*df.columns, (F.col("_at") + F.col("_shift")).alias(name))


def _page_of(rows: DataFrame, limit: int, order: Sequence[Column]) -> DataFrame:
    """At most limit + 1 ordered rows cut to `limit`, each saying whether more follow."""
    whole = Window.partitionBy()
    ranked = rows.withColumn("_n", F.row_number().over(whole.orderBy(*order)))
    more = (F.count(F.lit(1)).over(whole) > limit).alias("has_more")
    return ranked.select(*rows.columns, "_n", more).filter(F.col("_n") <= limit).drop("_n")


def event_page(
    events: DataFrame, limit: int = MAX_PAGE, offset: int | str = 0, ascending: bool = False, tasks: int | None = None,
    top_rows: int | None = None,
) -> DataFrame:
    """One page of the ordered events, with `has_more`; the limit is held within 1 and 10,000.

    Events of equal time and id go by a hash of all their columns, and events equal in all columns are
    interchangeable, so that pages neither overlap nor leave a row out, whatever their offset. Pages that end further
    in than the `top_rows` (by default TOP_ROWS) that a top-k may hold are found by `with_position`, in `tasks` parts.
    """
    try:
        offset = int(offset or 0)
    except ValueError:
        raise ValueError("a page token is a whole number") from None
    if offset < 0:
        raise ValueError("a page token is not negative")
    limit = min(max(limit, 1), MAX_PAGE)
    tied = events.withColumn("_tie", F.xxhash64(*(F.to_json(F.struct(c)) for c in events.columns)))
    order = [*_event_order(ascending), F.col("_tie").asc()]
    if offset + limit < (TOP_ROWS if top_rows is None else top_rows):
        return _page_of(tied.orderBy(*order).offset(offset).limit(limit + 1), limit, order).drop("_tie")
    keys = ["timestamp_ms", "event_id", "_tie"]
    place = with_position(tied.select(*keys), [], order, tasks=tasks)
    wanted = place.filter(F.col("position").between(offset, offset + limit)).groupBy(*keys).agg(F.count("*").alias("_times"))
    wanted = wanted.select(*[F.col(key).alias(f"_k{i}") for i, key in enumerate(keys)], "_times")
    same = F.col("_tie") == F.col("_k2")
    for i, key in enumerate(keys[:2]):
        same = same & F.col(key).eqNullSafe(F.col(f"_k{i}"))
    # The keys of one page, at most 10,001. Equal rows are counted by `_times`, so each is needed once.
    found = tied.join(F.broadcast(wanted), same)
    once = found.groupBy(*keys, "_times").agg(*(F.first(c).alias(f"_v{i}") for i, c in enumerate(events.columns)))
    rows = once.select(
        *(F.col(f"_v{i}").alias(c) for i, c in enumerate(events.columns)), "_tie",
        F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))).alias("_copy"),
    )
    return _page_of(rows.drop("_copy"), limit, order).drop("_tie")


def event_page_after(
    events: DataFrame, last_ts: int | None, last_id: str | None, limit: int = MAX_PAGE, ascending: bool = False
) -> DataFrame:
    """The page after a known last event: a filter and a top-k, at the same cost for any page."""
    limit = min(max(limit, 1), MAX_PAGE)
    if last_ts is not None:
        stamp, ident = F.col("timestamp_ms"), F.col("event_id")
        if ascending:
            events = events.filter((stamp >= last_ts) & ((stamp > last_ts) | (ident > last_id)))
        else:
            events = events.filter((stamp <= last_ts) & ((stamp < last_ts) | (ident < last_id)))
    return _page_of(order_events(events, ascending).limit(limit + 1), limit, _event_order(ascending))


def first_of_each(df: DataFrame, key: str, position: str) -> DataFrame:
    """Distinct names, each with the first position it has."""
    return df.groupBy(key).agg(F.min(position).alias(position))


def read_back(rows: DataFrame, batch_keys: Sequence[str], text: str, order: Sequence[str], separator: str = "|"):
    """Texts of each batch joined in order. Batches are bounded by the delivery limits."""
    joined = f"listagg({text}, '{separator}') within group (order by {', '.join(order)})"
    return rows.groupBy(*batch_keys).agg(F.expr(joined).alias("bodies"))

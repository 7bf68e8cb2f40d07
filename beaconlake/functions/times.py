"""Time texts, epoch numbers and timestamps. Timestamps are UTC; sessions must run in UTC."""

from __future__ import annotations

import re
import time
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Milliseconds per relative-time unit, and the last millisecond that fits 64-bit nanoseconds.
UNIT_MS = {"s": 1_000, "m": 60_000, "h": 3_600_000, "d": 86_400_000, "w": 604_800_000}
MAX_NANO_MS = 9_223_372_036_854

# The accepted forms of a time text.
_RELATIVE = r"^-(\d+)([smhdw])$"
_EPOCH = r"^\d+$"
_DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"
_DATE_TIME = r"^\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?$"
_WITH_ZONE = r"^\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)? ?(Z|[+-]\d{2}(:?\d{2})?)$"


def now_ms() -> int:
    return time.time_ns() // 1_000_000


def whole(value: Column, by: int) -> Column:
    """64-bit division that cuts toward zero."""
    return F.call_function("div", value, F.lit(by).cast("long"))


def stamp_ms(stamp: Column) -> Column:
    """Epoch milliseconds of a timestamp column."""
    return whole(F.unix_micros(stamp.cast("timestamp")), 1000)


def ms_to_time(ms: Column) -> Column:
    """Timestamp without zone (UTC) for epoch milliseconds; NULL when negative or past 64-bit nanoseconds."""
    return F.when((ms >= 0) & (ms <= MAX_NANO_MS), F.timestamp_millis(ms).cast("timestamp_ntz"))


def iso_ms(text: Column) -> Column:
    """Epoch milliseconds of an ISO-8601 text, UTC unless it names an offset; NULL when it is not one."""
    zoned = (
        F.when(text.rlike(_WITH_ZONE), text)
        .when(text.rlike(_DATE_TIME), F.concat(text, F.lit("Z")))
        .when(text.rlike(_DATE), F.concat(text, F.lit("T00:00:00Z")))
    )
    with_seconds = F.regexp_replace(zoned, r"^([^T ]+[T ]\d{1,2}:\d{2})(?!:|\d)", "$1:00")
    return stamp_ms(F.try_to_timestamp(with_seconds))


def iso_seconds(ms: Column) -> Column:
    """ISO-8601 text with whole seconds."""
    return F.date_format(F.timestamp_seconds(whole(ms, 1000)), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_time(text: Column, now: int | Column) -> Column:
    """Epoch milliseconds of `now`, `-15m`, epoch milliseconds or an ISO-8601 text; NULL for anything else."""
    now = F.lit(now).cast("long") if isinstance(now, int) else now
    word = F.lower(F.trim(text))
    count = F.regexp_extract(word, _RELATIVE, 1).try_cast("long")
    unit = F.element_at(
        F.create_map(*[F.lit(x) for pair in UNIT_MS.items() for x in pair]),
        F.nullif(F.regexp_extract(word, _RELATIVE, 2), F.lit("")),
    ).cast("long")
    back = F.try_subtract(now, F.try_multiply(count, unit))
    iso = iso_ms(F.trim(text))
    return (
        F.when(word == "now", now)
        .when(word.rlike(_RELATIVE), F.when(back >= 0, back))
        .when(word.rlike(_EPOCH), word.try_cast("long"))
        .otherwise(F.when(iso >= 0, iso))
    )


def time_problem(text: Column, now: int | Column, name: str) -> Column:
    """Why `parse_time` gives NULL for a text, or NULL when it does not."""
    said = F.concat(F.lit(f"invalid {name} value '"), F.coalesce(text, F.lit("NULL")), F.lit("'"))
    return F.when(parse_time(text, now).isNull(), said)


def time_option(value: int | str | datetime, now: int, name: str) -> int:
    """The same rules for one option value; raises on a bad one."""
    if isinstance(value, datetime):
        moment = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
        return time_option(int(moment.timestamp() * 1000), now, name)
    if isinstance(value, int):
        if value < 0:
            raise ValueError(f"invalid {name} value '{value}'")
        return value
    text = value.strip()
    word = text.lower()
    relative = re.match(_RELATIVE, word)
    if word == "now":
        return now
    if relative:
        result = now - int(relative[1]) * UNIT_MS[relative[2]]
        if result >= 0:
            return result
    elif re.match(_EPOCH, word):
        return int(word)
    elif any(re.match(form, text) for form in (_DATE, _DATE_TIME, _WITH_ZONE)):
        try:
            moment = datetime.fromisoformat(text.replace(" +", "+").replace(" Z", "Z"))
        except ValueError:
            moment = None
        if moment is not None:
            return time_option(moment, now, name)
    raise ValueError(
        f"invalid {name} value '{value}'; use now, -15m/-2h/-7d, epoch milliseconds or an ISO-8601 timestamp"
    )


def pick(df: DataFrame, names: Sequence[str]) -> T.StructField | None:
    """The field of the first candidate name present, ignoring case; the leftmost of equal names wins."""
    fields: dict[str, T.StructField] = {}
    for field in df.schema.fields:
        fields.setdefault(field.name.lower(), field)
    return next((fields[name] for name in names if name in fields), None)


def _scaled(field: T.StructField, per_unit: int, unit_micros: int) -> Column:
    """A time field in whole units: integers divided by `per_unit`, temporal values and texts converted."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return whole(column.cast("long"), per_unit)
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return whole(F.unix_micros(column.cast("timestamp")), unit_micros)
    if isinstance(field.dataType, T.StringType):
        ms = iso_ms(F.trim(column))
        return ms if unit_micros == 1000 else whole(ms, unit_micros // 1000)
    return F.lit(None).cast("long")


def event_time(df: DataFrame, now: int | None = None) -> Column:
    """Epoch milliseconds of a log row: its time, else its observed time, else now.

    Integers are nanoseconds in `time_unix_nano` and `observed_time_unix_nano`, milliseconds in `timestamp`.
    """
    main, observed = pick(df, ["time_unix_nano", "timestamp"]), pick(df, ["observed_time_unix_nano"])
    choices = []
    if main is not None:
        choices.append(_scaled(main, 1_000_000 if main.name.lower() == "time_unix_nano" else 1, 1000))
    if observed is not None:
        choices.append(_scaled(observed, 1_000_000, 1000))
    return F.coalesce(*choices, F.lit(now_ms() if now is None else now).cast("long"))


def metric_time(df: DataFrame, now: int | None = None) -> Column:
    """Epoch seconds of a gauge row: its time, else now.

    Integers are nanoseconds in `time_unix_nano` and, unlike in `event_time`, seconds in `timestamp`.
    """
    main = pick(df, ["time_unix_nano", "timestamp"])
    choices = []
    if main is not None:
        per_unit = 1_000_000_000 if main.name.lower() == "time_unix_nano" else 1
        choices.append(_scaled(main, per_unit, 1_000_000))
    return F.coalesce(*choices, F.lit((now_ms() if now is None else now) // 1000).cast("long"))

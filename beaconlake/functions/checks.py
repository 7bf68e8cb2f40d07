"""Checks on outgoing names, sizes and ages: each gives a reason text, or NULL for a good value."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from beaconlake.functions.attributes import is_json

# Limits of the delivery contract.
MAX_BATCH_BYTES = 1_048_576
EVENT_OVERHEAD = 26
MAX_BATCH_EVENTS = 10_000
MAX_SPAN_MS = 86_400_000
MAX_BATCH_DATA = 1_000
MAX_DATA_BYTES = 800_000
MAX_DIMENSIONS = 30
OLDEST_METRIC_MS = 14 * 86_400_000
NEWEST_METRIC_MS = 2 * 3_600_000

# Retention settings that can be stored, in days.
RETENTION_DAYS = [
    1, 3, 5, 7, 14, 30, 60, 90, 120, 150, 180,
    365, 400, 545, 731, 1096, 1827, 2192, 2557, 2922, 3288, 3653,
]



@dataclass(frozen=True)
class NameRule:
    """What a name may be: its most bytes, a pattern of what it may not contain, a prefix that is taken, and what to
    call it in a reason. The same rule judges columns and single values."""

    what: str
    most_bytes: int
    never: str
    why_never: str
    taken: str = ""

    def _reasons(self) -> list[str]:
        return [f"{self.what} is missing or empty", f"{self.what} has over {self.most_bytes} bytes", f"{self.what} begins with {self.taken}, which is taken", f"{self.what} has {self.why_never}"]

    def column(self, name: Column) -> Column:
        """The reason against a name, NULL for a good one."""
        empty, long, taken, never = self._reasons()
        found = F.when(name.isNull() | (name == ""), empty).when(F.octet_length(name) > self.most_bytes, long)
        if self.taken:
            found = found.when(name.startswith(self.taken), taken)
        return found.when(name.rlike(self.never), never)

    def reason(self, name: str | None) -> str | None:
        """The same for one value, without a Spark job."""
        empty, long, taken, never = self._reasons()
        if not name:
            return empty
        if len(name.encode("utf-8", "replace")) > self.most_bytes:
            return long
        if self.taken and name.startswith(self.taken):
            return taken
        return never if re.search(self.never, name) else None


# Bounds, characters and the reserved prefix of names.
GROUP = NameRule("the log group", 512, r"[^A-Za-z0-9._/#-]", "a character other than letters, digits and . _ / # -")
STREAM = NameRule("the log stream", 512, r"[:*]", "a colon or an asterisk")
NAMESPACE = NameRule("the namespace", 255, r"[^\x21-\x7E]", "a character that is not visible ASCII", "AWS/")


def check_group_name(name: Column) -> Column:
    """1 to 512 bytes of letters, digits and `. _ / # -`."""
    return GROUP.column(name)


def check_stream_name(name: Column) -> Column:
    """1 to 512 bytes without `:` and `*`."""
    return STREAM.column(name)


def check_namespace(name: Column) -> Column:
    """1 to 255 bytes of printable ASCII without spaces, outside the reserved prefix."""
    return NAMESPACE.column(name)


def check_retention(days: Column) -> Column:
    """One of the storable retention settings."""
    return F.when(days.isNull() | ~days.isin(RETENTION_DAYS), "the retention is none of the settings that can be stored")


def check_message(message: Column) -> Column:
    """Non-empty and small enough for a batch of its own."""
    return F.when(message.isNull() | (message == ""), "the message is missing or empty").when(
        F.octet_length(message) > MAX_BATCH_BYTES - EVENT_OVERHEAD, "the message does not fit into a batch"
    )


def check_metric(name: Column, value: Column, dimensions: Column, attributes: Column | None = None) -> Column:
    """A named, finite reading with at most 30 dimensions and, if any, valid attribute JSON."""
    reason = F.when(name.isNull() | (name == ""), "the metric has no name")
    if attributes is not None:
        bad = (attributes != "") & ~is_json(attributes)
        reason = reason.when(bad, "the attributes can't be read as JSON")
    return reason.when(F.size(dimensions) > MAX_DIMENSIONS, "the metric has over 30 dimensions").when(
        F.isnan(value) | value.isin(math.inf, -math.inf), "the value is infinite or not a number"
    )


def check_metric_age(ms: Column, now: int | Column) -> Column:
    """Neither older than two weeks nor more than two hours ahead."""
    now = F.lit(now).cast("long") if isinstance(now, int) else now
    return F.when(ms < now - OLDEST_METRIC_MS, "too_old").when(ms > now + NEWEST_METRIC_MS, "too_new")


def accept(value: str, rule: NameRule, what: type[Exception] = ValueError) -> None:
    """Applies a name's rule to one option value and raises the reason against it."""
    reason = rule.reason(value)
    if reason is not None:
        raise what(reason)

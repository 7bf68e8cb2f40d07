"""Open alarms from landed XML pages."""

from __future__ import annotations

import json
import sys
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconlake import schemas
from beaconlake.functions.attributes import filled
from beaconlake.functions.times import iso_ms
from beaconlake.sources.logs import as_columns, explode_once
from beaconlake.sources.pages import accept_pages
from beaconlake.storage import pin

# The functions below travel to executors with their code, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Open states in query order, alarm containers in page order and the type each stands for.
OPEN_STATES = ["ALARM", "INSUFFICIENT_DATA"]
CONTAINERS = {"MetricAlarms": "MetricAlarm", "CompositeAlarms": "CompositeAlarm", "LogAlarms": "LogAlarm"}

# The members of one alarm.
_TEXT_MEMBERS = [
    "AlarmArn", "AlarmName", "AlarmType", "StateValue", "StateTransitionedTimestamp", "StateUpdatedTimestamp",
    "AlarmDescription", "StateReason", "StateReasonData", "ActionsEnabled", "Namespace", "MetricName",
]
_DIMENSION = T.StructType().add("Name", "string").add("Value", "string")
_ALARM = (
    T.StructType([T.StructField(name, T.StringType()) for name in _TEXT_MEMBERS])
    .add("AlarmActions", T.StructType().add("member", T.ArrayType(T.StringType())))
    .add("Dimensions", T.StructType().add("member", T.ArrayType(_DIMENSION)))
)
_ALARMS = T.ArrayType(_ALARM)
_PAGE = T.StructType().add(
    "DescribeAlarmsResult",
    T.StructType([T.StructField(name, T.StructType().add("member", _ALARMS)) for name in CONTAINERS]).add("NextToken", "string"),
)


def open_state(status: Column) -> Column:
    """Whether a status is one of the open ones."""
    return status.isin(OPEN_STATES)


def _as_json(node: ElementTree.Element):
    """An XML element as nested values: texts, objects with sorted keys, arrays for repeated tags."""
    if len(node) == 0:
        return (node.text or "").strip()
    groups: dict[str, list] = {}
    for child in node:
        groups.setdefault(child.tag.rpartition("}")[2], []).append(_as_json(child))
    return {tag: found[0] if len(found) == 1 else found for tag, found in sorted(groups.items())}


def _configurations(page: str, wanted: set[tuple[int, int]]) -> list[list[str | None]]:
    """The wanted alarms of a page, by container and member, as JSON; None for the others."""
    tags = {tag: None for tag in CONTAINERS}
    for node in ElementTree.fromstring(page).iter():
        tag = node.tag.rpartition("}")[2]
        if tag in tags and tags[tag] is None:
            tags[tag] = node
    texts = []
    for number, container in enumerate(tags.values()):
        members = [] if container is None else [n for n in container if n.tag.rpartition("}")[2] == "member"]
        texts.append([json.dumps(_as_json(n), ensure_ascii=False, separators=(",", ":")) if (number, i) in wanted else None for i, n in enumerate(members)])
    return texts


@F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
def _configuration(pages: pd.Series, wanted: pd.Series) -> pd.Series:
    found = [_configurations(page, {(w["container"], w["member"]) for w in places}) if len(places) else [] for page, places in zip(pages, wanted)]
    return pd.Series(found, dtype=object)


def _dimensions(container: Column) -> Column:
    """Dimensions as JSON in page order: NULL without a container, {} when it is empty."""
    named = F.filter(container["member"], lambda m: m["Name"] != "")

    def quoted(text: Column) -> Column:
        as_json = F.to_json(F.array(F.coalesce(text, F.lit(""))))
        return F.substring(as_json, 2, F.length(as_json) - 2)

    pairs = F.transform(named, lambda m: F.concat(quoted(m["Name"]), F.lit(":"), quoted(m["Value"])))
    return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))


def _members(container: str, number: int) -> Column:
    """Alarms of one container with their type and place."""
    return F.transform(
        F.coalesce(F.col(f"r.{container}.member"), F.array().cast(_ALARMS)),
        lambda alarm, at: F.struct(
            F.lit(CONTAINERS[container]).alias("kind"), F.struct(F.lit(number).alias("container"), at.alias("member")).alias("place"), alarm.alias("alarm")
        ),
    )


def read_alarm_pages(pages: DataFrame) -> DataFrame:
    """Landed pages (`state`, `page_no`, `body`) parsed once and written: `next_token` and the typed `members`.

    Malformed XML raises.
    """
    # An empty container would read as a missing one, so it gets one nameless member.
    body = F.regexp_replace(
        "body", r"<Dimensions\s*/>|<Dimensions>\s*</Dimensions>", "<Dimensions><member><Name/></member></Dimensions>"
    )
    page = F.from_xml(body, _PAGE, {"mode": "FAILFAST", "ignoreNamespace": "true"})["DescribeAlarmsResult"]
    parsed = pages.select("state", "page_no", "body", page.alias("r"))
    members = [_members(container, number) for number, container in enumerate(CONTAINERS)]
    read = parsed.select("state", "page_no", "body", F.coalesce("r.NextToken", F.lit("")).alias("next_token"), F.concat(*members).alias("members"))
    return pin(read, "alarm-pages")


def decode_alarm_pages(read: DataFrame, every: bool = False) -> DataFrame:
    """The alarms of parsed pages with their place and `configuration`: those in the open state that their page was asked
    for, or `every` one. The configuration is worked out for these alone, and a page without any is not read for it."""
    status = lambda m: F.trim(m["alarm"]["StateValue"])
    kept = F.col("members") if every else F.filter("members", lambda m: (status(m) == F.col("state")) & open_state(status(m)))
    chosen = read.select("state", "page_no", "body", kept.alias("members"))
    told = chosen.select("state", "page_no", "members", _configuration("body", F.transform("members", lambda m: m["place"])).alias("_texts"))
    rows = explode_once(told, "members", "m", "at")
    return rows.select("state", "page_no", "m.kind", "m.place", "m.alarm", F.col("_texts")[F.col("m.place.container")][F.col("m.place.member")].alias("configuration"))


def _stamp(text: Column) -> Column:
    return F.timestamp_millis(iso_ms(text)).cast("timestamp_ntz")


def open_alarms(pages: DataFrame) -> DataFrame:
    """Alarms whose state is open and the one their page was asked for, one row per alarm.

    An alarm is known by its ARN, else by type and name; the first in the order of state, page and place counts. Of the
    pages asked for one state only those count up to the first without a next token, or with one seen before.
    """
    found = decode_alarm_pages(accept_pages(read_alarm_pages(pages), "seen", request="state"))
    a = F.col("alarm")
    kind = F.coalesce(filled(F.trim(a["AlarmType"])), F.col("kind"))
    name = F.coalesce(a["AlarmName"], F.lit(""))
    key = F.coalesce(filled(a["AlarmArn"]), F.concat(kind, F.lit("\n"), name))
    state_no = F.array_position(F.array(*[F.lit(s) for s in OPEN_STATES]), F.col("state"))
    order = F.struct(state_no.alias("s"), F.col("page_no").alias("p"), F.col("place").alias("i"))
    row = F.struct(a.alias("a"), kind.alias("kind"), F.col("configuration"))
    first = found.groupBy(key.alias("key")).agg(F.min_by(row, order).alias("row")).select("row.*")
    a, text = F.col("a"), lambda member: filled(F.col("a")[member])
    enabled = F.lower(filled(a["ActionsEnabled"]))
    actions = F.coalesce(F.filter(a["AlarmActions"]["member"], lambda m: m != ""), F.array().cast("array<string>"))
    given = {
        "alarm_arn": text("AlarmArn"),
        "alarm_name": text("AlarmName"),
        "alarm_type": filled(F.col("kind")),
        "status": text("StateValue"),
        "state_transitioned_at": _stamp(a["StateTransitionedTimestamp"]),
        "state_updated_at": _stamp(a["StateUpdatedTimestamp"]),
        "description": text("AlarmDescription"),
        "reason": text("StateReason"),
        "reason_data": text("StateReasonData"),
        "actions_enabled": enabled == "true",
        "alarm_actions": actions,
        "namespace": text("Namespace"),
        "metric_name": text("MetricName"),
        "dimensions": _dimensions(a["Dimensions"]),
        "configuration": F.col("configuration"),
    }
    return first.select(as_columns(schemas.OPEN_ALARMS, given))

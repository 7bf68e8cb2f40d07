"""Attribute JSON, metric dimensions, units and event ids as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake.functions.times import pick

# Source unit -> unit of the delivery vocabulary.
UNITS = {
    "s": "Seconds",
    "ms": "Milliseconds",
    "us": "Microseconds",
    "By": "Bytes",
    "bytes": "Bytes",
    "KiBy": "Kilobytes",
    "MiBy": "Megabytes",
    "GiBy": "Gigabytes",
    "Bi": "Bits",
    "%": "Percent",
    "1": "None",
    "": "None",
}

# Attribute keys of the result relations.
PROVIDER_KEY, PROVIDER = "cloud.provider", "aws"
REGION_KEY = "cloud.region"
GROUPS_KEY = "aws.log.group.names"
STREAMS_KEY = "aws.log.stream.names"
EVENT_ID_KEY = "aws.cloudwatch.log.event_id"
SERVICE_KEYS = {
    "service_name": "service.name",
    "service_namespace": "service.namespace",
    "service_instance_id": "service.instance.id",
}


def filled(text: Column) -> Column:
    """The text, or NULL when empty."""
    return F.when(text != "", text)


def is_json(text: Column) -> Column:
    """Whether a text is one JSON value and nothing else; repeated keys are allowed."""
    # Spark's JSON readers stop after the first value, so the text is read as the only element of an array.
    return F.coalesce(F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1, F.lit(False))


def is_json_object(text: Column) -> Column:
    return is_json(text) & F.ltrim(text).startswith("{")


def resource_attributes(region: str, log_group: Column, log_stream: Column) -> Column:
    """Where a log event comes from, as JSON; an unknown region or stream leaves its key out."""
    return F.to_json(
        F.struct(
            F.lit(PROVIDER).alias(PROVIDER_KEY),
            F.lit(region or None).cast("string").alias(REGION_KEY),
            F.array(log_group).alias(GROUPS_KEY),
            F.when(log_stream != "", F.array(log_stream)).alias(STREAMS_KEY),
        )
    )


def metric_resource_attributes(region: str) -> Column:
    return F.to_json(
        F.struct(
            F.lit(PROVIDER).alias(PROVIDER_KEY),
            F.lit(region or None).cast("string").alias(REGION_KEY),
        )
    )


def log_attributes(event_id: Column) -> Column:
    """The event id as JSON, or NULL without one."""
    return F.when(event_id != "", F.to_json(F.struct(event_id.alias(EVENT_ID_KEY))))


def translate_unit(unit: Column) -> Column:
    """Unit of the delivery vocabulary; annotation-only units are counts, all others None."""
    text = F.coalesce(unit, F.lit(""))
    known = F.create_map(*[F.lit(x) for pair in UNITS.items() for x in pair])
    annotation = (F.length(text) >= 2) & text.startswith("{") & text.endswith("}")
    return F.coalesce(F.try_element_at(known, text), F.when(annotation, "Count"), F.lit("None"))


def dimension_value(dimensions: Column, key: str) -> Column:
    """Value of one dimension, NULL when absent."""
    return F.try_element_at(dimensions, F.lit(key))


def has_dimensions(dimensions: Column, wanted: Mapping[str, str]) -> Column:
    """Every wanted pair is present; more dimensions may be."""
    holds = F.lit(True)
    for key, value in wanted.items():
        holds = holds & (dimension_value(dimensions, key) == value)
    return holds


def dimensions_key(dimensions: Column) -> Column:
    """Text that is equal for equal dimension maps, whatever their key order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(dimensions))))


def event_id(body_seq: Column, position: Column) -> Column:
    """29 digits: 19 of the body's sequence number, room for any bigint, and 10 of the place in it, for any int."""
    return F.concat(F.lpad(body_seq.cast("string"), 19, "0"), F.lpad(position.cast("string"), 10, "0"))


def metric_dimensions(df: DataFrame) -> Column:
    """Dimensions of a gauge row as an array of (name, value): the service, then each string-valued attribute.

    Attributes keep their order in the JSON text; members of other types are left out.
    """
    service = pick(df, ["service_name"])
    attributes = pick(df, ["metric_attributes", "attributes"])
    pair = "array<struct<name:string,value:string>>"
    parts = []
    if service is not None:
        name = F.col(f"`{service.name}`").cast("string")
        parts.append(
            F.when(
                name != "", F.array(F.struct(F.lit("service.name").alias("name"), name.alias("value")))
            ).otherwise(F.array().cast(pair))
        )
    if attributes is not None:
        text = F.col(f"`{attributes.name}`").cast("string")
        # Read as a map of variants, members keep their order and their type.
        members = F.map_entries(F.from_json(text, "map<string,variant>"))
        strings = F.filter(members, lambda m: F.schema_of_variant(m["value"]) == "STRING")
        parts.append(
            F.coalesce(
                F.transform(
                    strings,
                    lambda m: F.struct(
                        m["key"].alias("name"), F.variant_get(m["value"], "$", "string").alias("value")
                    ),
                ),
                F.array().cast(pair),
            )
        )
    return F.concat(*parts) if parts else F.array().cast(pair)


def first_wins_map(pairs: Column) -> Column:
    """Map of an array of (name, value) in which the first of equal names counts."""
    names = F.transform(pairs, lambda p: p["name"])
    kept = F.filter(pairs, lambda p, i: F.array_position(names, p["name"]) == (i + 1).cast("long"))
    return F.map_from_entries(kept)

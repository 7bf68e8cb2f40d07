"""Service dependencies: edges of landed service-graph pages with both ends resolved."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake import schemas
from beaconlake.functions.attributes import filled, is_json_object
from beaconlake.functions.times import ms_to_time, now_ms, time_option
from beaconlake.sources.logs import as_columns, explode_once
from beaconlake.sources.pages import accept_pages
from beaconlake.storage import pin

# Members of services and edges that become attributes, in output order.
SERVICE_ATTRIBUTES = [
    "AccountId", "Root", "State", "Names", "StartTime", "EndTime",
    "DurationHistogram", "ResponseTimeHistogram", "SummaryStatistics",
]
EDGE_ATTRIBUTES = ["Aliases", "ResponseTimeHistogram", "ReceivedEventAgeHistogram", "StartTime", "EndTime"]
# Attribute members that are JSON texts; the others are numbers, flags, arrays or objects.
TEXT_ATTRIBUTES = ["AccountId", "State"]
# The remaining edge and service members.
_EDGE_STATISTICS = (
    "struct<TotalCount:bigint,TotalResponseTime:double,"
    "ErrorStatistics:struct<TotalCount:bigint,ThrottleCount:bigint>,"
    "FaultStatistics:struct<TotalCount:bigint,ThrottleCount:bigint>>"
)
_ALIASES = "array<struct<Name:string,Type:string>>"


def _raw(names: Sequence[str]) -> str:
    return ",".join(f"{name}:string" for name in names)


_EDGE = f"struct<ReferenceId:bigint,EdgeType:string,Type:string,SummaryStatistics:string,{_raw(EDGE_ATTRIBUTES)}>"
_SERVICE = f"struct<ReferenceId:bigint,Name:string,Type:string,{_raw(SERVICE_ATTRIBUTES)},Edges:array<{_EDGE}>>"
_SERVICES = f"array<{_SERVICE}>"
_PAGE = f"struct<Services:{_SERVICES},NextToken:string>"


def _attributes(member: Column, names: Sequence[str]) -> Column:
    """The named members as a JSON object in the given order, NULL when there is none.

    Members were read as raw text, which keeps their inner key order; only texts need their quotes back.
    """
    parts = []
    for name in names:
        raw = member[name]
        if name in TEXT_ATTRIBUTES:
            array = F.to_json(F.array(raw))
            raw = F.when(raw.isNotNull(), F.substring(array, 2, F.length(array) - 2))
        parts.append(F.concat(F.lit(f'"{name}":'), raw))
    joined = F.concat_ws(",", *parts)
    return F.when(joined != "", F.concat(F.lit("{"), joined, F.lit("}")))


def read_graph_pages(pages: DataFrame) -> DataFrame:
    """Landed pages (`request_id`, `page_no`, `body`) parsed once and written: `next_token`, `services`, `is_page`.

    Tokens, services and edges are all read from the written columns.
    """
    parsed = pages.select("request_id", "page_no", is_json_object(F.col("body")).alias("is_page"), F.from_json("body", _PAGE).alias("p"))
    read = parsed.select(
        "request_id", "page_no", "is_page", F.coalesce("p.NextToken", F.lit("")).alias("next_token"), F.col("p.Services").alias("services")
    )
    return pin(read, "graph-pages")


def decode_graph_pages(read: DataFrame) -> DataFrame:
    """Services of parsed pages with their place and attributes; a page that is no JSON object raises."""
    broken = F.raise_error(F.lit("the service graph page is not a JSON object")).cast(_SERVICES)
    services = F.when(F.coalesce("is_page", F.lit(False)), F.col("services")).otherwise(broken)
    return explode_once(read.select("request_id", "page_no", services.alias("_services")), "_services", "s").select(
        "request_id",
        F.struct("page_no", "pos").alias("place"),
        F.col("s.ReferenceId").alias("reference_id"),
        F.coalesce("s.Name", F.lit("")).alias("service"),
        F.coalesce("s.Type", F.lit("")).alias("type"),
        _attributes(F.col("s"), SERVICE_ATTRIBUTES).alias("attributes"),
        F.col("s.Edges").alias("edges"),
    )


def service_edges(services: DataFrame) -> DataFrame:
    """One row per edge: its source, its target reference and first alias, and its statistics."""
    e = F.col("e")
    stats = F.from_json(e["SummaryStatistics"], _EDGE_STATISTICS)
    alias = F.try_element_at(F.from_json(e["Aliases"], _ALIASES), F.lit(1))
    exploded = services.select(
        "request_id",
        F.col("service").alias("source_service"),
        F.col("type").alias("source_type"),
        F.col("attributes").alias("source_attributes"),
        F.explode("edges").alias("e"),
    )
    read = exploded.withColumn("stats", F.when(e["SummaryStatistics"].startswith("{"), stats)).withColumn(
        "alias", F.when(e["Aliases"].startswith("["), alias)
    )

    def number(column: str, zero: Column) -> Column:
        return F.when(F.col("stats").isNotNull(), F.coalesce(F.col(column), zero))

    none = F.lit(0).cast("long")
    throttled = number("stats.ErrorStatistics.ThrottleCount", none) + number(
        "stats.FaultStatistics.ThrottleCount", none
    )
    return read.select(
        "request_id",
        "source_service",
        "source_type",
        "source_attributes",
        F.col("e.ReferenceId").alias("reference_id"),
        F.coalesce("alias.Name", F.lit("")).alias("alias_name"),
        F.coalesce("alias.Type", F.lit("")).alias("alias_type"),
        F.coalesce("e.EdgeType", "e.Type", F.lit("synchronous")).alias("edge_type"),
        number("stats.TotalCount", none).alias("request_count"),
        number("stats.ErrorStatistics.TotalCount", none).alias("error_count"),
        number("stats.FaultStatistics.TotalCount", none).alias("fault_count"),
        throttled.alias("throttle_count"),
        number("stats.TotalResponseTime", F.lit(0.0)).alias("total_response_time_seconds"),
        _attributes(e, EDGE_ATTRIBUTES).alias("edge_attributes"),
    )


def resolve_edges(services: DataFrame, edges: DataFrame) -> DataFrame:
    """Adds target name, type and attributes: of the referenced service, else of the edge's alias.

    The last service of equal ids counts. All pages take part, so an edge may point forward.
    """
    targets = (
        services.filter(F.col("reference_id").isNotNull())
        .groupBy("request_id", "reference_id")
        .agg(F.max_by(F.struct("service", "type", "attributes"), F.col("place")).alias("t"))
        .select("request_id", F.col("reference_id").alias("target_id"), "t")
    )
    joined = edges.alias("e").join(
        targets.alias("x"),
        (F.col("e.request_id") == F.col("x.request_id")) & (F.col("e.reference_id") == F.col("x.target_id")),
        "left",
    )
    known = F.col("x.target_id").isNotNull()
    return joined.select(
        "e.*",
        F.when(known, F.col("t.service")).otherwise(F.col("alias_name")).alias("target_service"),
        F.when(known, F.col("t.type")).otherwise(F.col("alias_type")).alias("target_type"),
        F.col("t.attributes").alias("target_attributes"),
    )


def service_dependencies(
    pages: DataFrame,
    start: int | str | datetime = "-1h",
    end: int | str | datetime = "now",
    now: int | None = None,
) -> DataFrame:
    """The edge table of service-graph pages, for the requested window.

    Of each request only the pages count that a correct pagination takes in: up to the first without a next token, or
    with one that an earlier page had.
    """
    now = now_ms() if now is None else now
    start_ms, end_ms = time_option(start, now, "start_time"), time_option(end, now, "end_time")
    if start_ms >= end_ms:
        raise ValueError("start_time must be before end_time")
    services = decode_graph_pages(accept_pages(read_graph_pages(pages), "seen"))
    resolved = resolve_edges(services, service_edges(services))
    texts = ["source_service", "target_service", "source_type", "target_type", "edge_type"]
    given = {
        "provider": F.lit("cloudwatch"),  # fixed value
        "window_start": ms_to_time(F.lit(start_ms)),
        "window_end": ms_to_time(F.lit(end_ms)),
        **{name: filled(F.col(name)) for name in texts},
        **{
            name: F.col(name)
            for name in schemas.SERVICE_EDGES.names
            if name.endswith(("_count", "_attributes")) or name == "total_response_time_seconds"
        },
    }
    return resolved.select(as_columns(schemas.SERVICE_EDGES, given))

"""Landed tables under names: one view per log group, the open alarms and the service dependencies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from beaconlake.operators.registry import describe_groups
from beaconlake.sources.alarms import open_alarms
from beaconlake.sources.graph import service_dependencies
from beaconlake.sources.logs import logs_scan

# Names of the relations besides the log groups.
ALARMS, EDGES = "alerts.open", "service_map.dependencies"
_LOG_OPTIONS = ["filter", "start", "end", "stream_prefix", "streams", "order", "max_rows", "region", "now"]


@dataclass(frozen=True)
class Attached:
    """Read-only relations by name; SQL finds them as views of the same names."""

    relations: Mapping[str, DataFrame] = field(default_factory=dict)

    def names(self) -> list[str]:
        return list(self.relations)

    def table(self, name: str) -> DataFrame:
        """By exact name, else ignoring case."""
        if name in self.relations:
            return self.relations[name]
        for known, relation in self.relations.items():
            if known.lower() == name.lower():
                return relation
        raise KeyError(name)


def distinct_names(names: Sequence[str | None]) -> list[str]:
    """Distinct log group names in first order; an empty one raises."""
    if any(not name for name in names):
        raise ValueError("a listed log group has no name")
    return list(dict.fromkeys(names))


def attach(
    spark: SparkSession, paths: Mapping[str, str], log_groups: Sequence[str] | None = None,
    max_groups: int | None = None, **scan_defaults
) -> Attached:
    """Names the landed tables of `paths` (`events`, `registry`, `alarms`, `graph`; any may be missing).

    Log groups become views `logs.<group>`: those given, else those of the registry: one
    view and one name on the driver per group, with `max_groups` as a bound if one is wanted. Scan options apply to all.
    """
    unknown = [name for name in scan_defaults if name not in _LOG_OPTIONS]
    if unknown:
        raise ValueError(f"unknown option {unknown[0]}")
    other = [name for name in paths if name not in ("events", "registry", "alarms", "graph")]
    if other:
        raise ValueError(f"unknown path {other[0]}")
    relations: dict[str, DataFrame] = {}
    if "events" in paths:
        events = spark.read.parquet(paths["events"])
        if log_groups is None:
            registry = spark.read.parquet(paths["registry"])
            found = describe_groups(registry).select("log_group").distinct()
            found = (found.limit(max_groups + 1) if max_groups is not None else found).collect()
            if max_groups is not None and len(found) > max_groups:
                raise ValueError(f"the registry has more than {max_groups} log groups; name the ones to attach")
            log_groups = sorted(row.log_group for row in found)
        for group in distinct_names(log_groups):
            relations[f"logs.{group}"] = logs_scan(events, group, **scan_defaults)
    if "alarms" in paths:
        pages = spark.read.parquet(paths["alarms"])
        relations[ALARMS] = open_alarms(pages)
    if "graph" in paths:
        window = {name: scan_defaults[name] for name in ("start", "end", "now") if name in scan_defaults}
        relations[EDGES] = service_dependencies(spark.read.parquet(paths["graph"]), **window)
    for name, relation in relations.items():
        relation.createOrReplaceTempView(f"`{name}`")
    return Attached(relations)

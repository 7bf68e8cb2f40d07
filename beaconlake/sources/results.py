"""Landed results of ad-hoc log queries: ragged (field, value) rows as a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconlake.sources.logs import json_object

MAX_GROUPS = 50
MAX_RESULT_ROWS = 10_000


def check_query(log_groups: Sequence[str], max_rows: int = 1_000) -> None:
    """Limits of one ad-hoc query: 1 to 50 named groups and 0 to 10,000 rows."""
    if not 1 <= len(log_groups) <= MAX_GROUPS or any(not name for name in log_groups):
        raise ValueError(f"a query needs 1 to {MAX_GROUPS} log groups with non-empty names")
    if not 0 <= max_rows <= MAX_RESULT_ROWS:
        raise ValueError(f"max_rows must be between 0 and {MAX_RESULT_ROWS}")


def complete_results(responses: DataFrame) -> DataFrame:
    """The responses themselves; any status but `Complete` raises with its text."""
    status = F.coalesce("status", F.lit(""))
    done = F.when(status == "Complete", True).otherwise(
        F.raise_error(F.concat(F.lit("the query did not complete: "), status)).cast("boolean")
    )
    return responses.filter(done)


def result_fields(rows: DataFrame, max_columns: int | None = None) -> list[str]:
    """Field names in the order rows and fields show them first.

    Rows with the same list of names are grouped before any name is looked at, so this moves one row per
    distinct list. It runs a Spark job. The names become columns and so come to the driver; more than `max_columns`,
    if given, raise.
    """
    place = F.struct("response_no", "row_no")
    shapes = (
        rows.select(place.alias("place"), F.transform("fields", lambda f: f["field"]).alias("names"))
        .groupBy("names")
        .agg(F.min("place").alias("place"))
        .select("place", F.posexplode("names").alias("pos", "name"))
    )
    first = shapes.groupBy("name").agg(F.min(F.struct("place", "pos")).alias("seen"))
    names = first.orderBy("seen")
    names = (names if max_columns is None else names.limit(max_columns + 1)).collect()
    if max_columns is not None and len(names) > max_columns:
        raise ValueError(f"the results have more than {max_columns} fields")
    return [row["name"] for row in names]


def tabulate_results(responses: DataFrame, max_columns: int | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One string column per field of the results, one row per result row.

    `responses` has `response_no`, `status` and `results`. A field absent from a row is NULL, a repeated one
    counts with its last value, a pair without a name is left out and a pair without a value gives ''.
    """
    rows = complete_results(responses).select(
        *[c for c in keep if c != "response_no"], "response_no", F.posexplode("results").alias("row_no", "pairs")
    )
    rows = rows.withColumn("fields", F.filter("pairs", lambda p: p["field"].isNotNull())).drop("pairs")
    names = result_fields(rows, max_columns)
    if not names:
        empty = rows.select(*keep, F.lit("").alias("@message")).filter(F.lit(False))
        return empty

    # Numbered on the way, as a field may have the name of a kept column.
    kept = rows.select(*keep, "fields")
    types = [*[field.dataType for field in kept.schema.fields[:-1]], *[T.StringType()] * len(names)]
    shape = T.StructType([T.StructField(f"c{i}", kind) for i, kind in enumerate(types)])
    return kept.mapInArrow(_columns(names), shape).toDF(*kept.columns[:-1], *names)


def _columns(names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Turns the last column of batches, arrays of (field, value), into one column per name.

    A pair is looked up once among the names, and each column takes its own pairs, so that a row costs what it holds.
    """
    cells = 1 << 22

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, step = pa.array(names, pa.string()), max(1, cells // len(names))
        for batch in batches:
            for begin in range(0, batch.num_rows, step):
                part = batch.slice(begin, step)
                pairs, row = pc.list_flatten(part.columns[-1]), pc.list_parent_indices(part.columns[-1]).to_numpy()
                values = pc.fill_null(pc.struct_field(pairs, "value"), "")
                code = pc.index_in(pc.struct_field(pairs, "field"), value_set=known).to_numpy(zero_copy_only=False)
                order = np.argsort(code, kind="stable")
                ends = np.searchsorted(code[order], np.arange(len(names) + 1))
                made = []
                for at in range(len(names)):
                    mine = order[ends[at] : ends[at + 1]]
                    place = np.full(part.num_rows, -1)
                    place[row[mine]] = mine  # in order, so that the last of repeated fields stays
                    made.append(values.take(pa.array(place, mask=place < 0)))
                made = [*part.columns[:-1], *made]
                yield pa.RecordBatch.from_arrays(made, [f"c{i}" for i in range(len(made))])

    return spread


def result_statistics(responses: DataFrame) -> DataFrame:
    """Records matched and scanned, as whole numbers, per response."""
    return complete_results(responses).select(
        "response_no",
        F.coalesce(F.col("statistics.recordsMatched").cast("long"), F.lit(0)).alias("records_matched"),
        F.coalesce(F.col("statistics.recordsScanned").cast("long"), F.lit(0)).alias("records_scanned"),
    )


# The members of one query response.
RESPONSE = (
    "status string, results array<array<struct<field string, value string>>>,"
    " statistics struct<recordsMatched double, recordsScanned double>"
)


def decode_results(bodies: DataFrame) -> DataFrame:
    """Responses of landed JSON bodies (`response_no`, `body`)."""
    parsed = F.from_json(json_object(F.col("body"), "query response"), RESPONSE)
    return bodies.select("response_no", parsed.alias("r")).select("response_no", "r.*")

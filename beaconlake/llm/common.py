"""Helpers that several operators share: words, tables, connected components."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.storage import pin

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def ship(module: str) -> None:
    """Lets executors run the functions of a module without having the package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(docs: DataFrame, *needed: str) -> DataFrame:
    """The caller's whole row as the struct `row`, and beside it the columns `needed`: no name of the caller's can clash."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *needed)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an undirected graph, root being the smallest node it reaches.

    `edges` has two bigint columns `a`, `b`. Alternates large-star and small-star steps: each node links its larger
    neighbours, then its smaller ones, to the smallest of them, until only stars are left. A step is one grouped
    minimum, combined before the shuffle, and one join on the node, so no neighbourhood is collected. Each round is
    written to the shared folder. Nodes without edges, and edges with a null end, do not appear.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links = pin(links, "links")
    before = None
    for _ in range(most_rounds):
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = pin(hung.unionAll(small.select("u", F.col("m").alias("v"))).distinct(), "links")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            roots = links.select(F.col("v").alias("u"), "v").distinct()
            return links.unionAll(roots).toDF("node", "root")
        before = state
    raise RuntimeError(f"the components did not settle in {most_rounds} rounds")


ship(__name__)

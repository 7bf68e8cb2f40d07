"""The corpus pipeline: language ID, near-dedup, substring dedup, decontamination, mixing.

Each stage takes the documents that the stage before kept and returns those that it keeps, changed where that is its
work; the last adds to each the rate at which it is to be taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from beaconlake.llm.common import table
from beaconlake.llm.decontaminate import drop_contaminated
from beaconlake.llm.langid import keep_identified
from beaconlake.llm.mixing import with_rate
from beaconlake.llm.simhash import drop_near_duplicates
from beaconlake.llm.substrings import remove_repeats
from beaconlake.storage import pin


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language is ambiguous, go."""
    return keep_identified(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays."""
    return drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that an earlier document has leave the text; n_chars follows. Every row stays."""
    return remove_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item is found go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with its `rate`."""
    return with_rate(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: SQL has neither the learned classifiers nor the links of fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each on the written rows of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Where intermediate data lives: the shared folder the cluster names, never an executor's disk."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a fresh temporary one only on a local master without the setting."""
    context = spark.sparkContext
    named = spark.conf.get(_DIR, None) or context.getCheckpointDir()
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named
    if not context.master.startswith("local"):
        raise RuntimeError(f"{_DIR} must name a folder that all executors share")
    made = tempfile.mkdtemp(prefix="beaconlake-")
    context.setCheckpointDir(made)
    return made


_made: list[str] = []


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that no other run uses."""
    path = f"{shared_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def pin(df: DataFrame, purpose: str = "pinned") -> DataFrame:
    """Writes `df` to the shared folder once and continues from the written table.

    Later steps read it by column and survive the loss of any executor without running `df` again.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def folders(spark: SparkSession, pattern: str, but: str | None = None) -> list[str]:
    """Paths that match a pattern of the store's, without `but`."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(pattern).getFileSystem(spark._jsc.hadoopConfiguration())
    left_out = but and store.makeQualified(path(but)).toString()
    found = [f.getPath().toString() for f in store.globStatus(path(pattern)) or []]
    return [f for f in found if f != left_out]


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Deletes folders with what is in them; one that is not there is no error."""
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear(spark: SparkSession) -> None:
    """Deletes what this process wrote to the shared folder. Results that still read it must be written out before."""
    while _made:
        remove(spark, [_made.pop()])

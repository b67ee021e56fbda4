"""Materialisation: lineage cuts on shared storage and scoped caching
(SNK-2, MAT-1, MAT-2).

Lineage is cut with a reliable ``checkpoint()`` into the folder named by
``spark.checkpoint.dir`` (or a table written under it), never a
``localCheckpoint``: executors may be lost and checkpoint blocks must survive
them.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..session import scratch_path, shared_dir


def checkpointed(df: DataFrame, eager: bool = True) -> DataFrame:
    """SNK-2: the DataFrame computed once and written to the shared checkpoint folder;
    the returned frame reads those files (the original plan is not re-run)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as parquet under a fresh folder of the shared dir and read it
    back: a lineage cut that also keeps column statistics for the planner."""
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """MAT-1 / MAT-2: cache ``df`` for the actions run inside the block, then
    release it."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()

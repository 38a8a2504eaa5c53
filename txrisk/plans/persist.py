"""Keep an input materialised while a multi-pass operator runs over it.

Exact quantiles, rank cut-offs and correlations read their input several
times. Re-running the upstream plan (joins, projections) for every pass is
the expensive part at scale, so the projected input is persisted
(memory, spilling to disk) for the duration of the passes and released
afterwards. Lost executors only cost a recomputation of their partitions.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


@contextmanager
def passes_over(df: DataFrame):
    if df.storageLevel.useMemory or df.storageLevel.useDisk:
        yield df
        return
    data = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield data
    finally:
        data.unpersist(blocking=False)


def materialize(df: DataFrame, name: str = "table", reader: SparkSession | None = None, **options) -> DataFrame:
    """Write ``df`` as parquet (with ``options``) below the shared checkpoint folder and read it back, by ``reader`` if given.

    Cuts the lineage (a lost executor no longer re-runs the upstream joins)
    and keeps column pruning and filter pushdown for the passes that follow.
    """
    from txrisk.session import scratch_path

    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").options(**options).parquet(path)
    return (reader or spark).read.parquet(path)

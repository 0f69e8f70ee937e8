"""Persisted intermediates of the current build.

Operators that read a frame more than once (a size check, then the join;
bucket bounds, then the ranking) persist it with MEMORY_AND_DISK -- lost
blocks are recomputed from lineage, so executor loss is survived. Each
persisted frame is recorded here so a caller can release the previous
build's blocks before starting the next one.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..session import checkpoint_root

_PERSISTED: list[DataFrame] = []


def keep(df: DataFrame) -> DataFrame:
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    _PERSISTED.append(out)
    return out


def settled(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the session's shared folder and scanned
    from there: evaluated once, the same for every reader and after a lost
    executor, with columns that later readers can prune."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/settled/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_all() -> None:
    while _PERSISTED:
        _PERSISTED.pop().unpersist(blocking=False)

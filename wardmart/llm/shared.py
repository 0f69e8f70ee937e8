"""Shared-folder tables, size-checked broadcasts and null-safe inputs."""

from __future__ import annotations

import ctypes
import pickle
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """The folder every executor and the driver share.

    ``spark.checkpoint.dir`` of the session. Unset on a ``local[..]``
    master (tests) a scratch folder of this machine is taken; unset on a
    cluster is an error, since machine-local files are invisible to the
    other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    root = "file://" + tempfile.mkdtemp(prefix="llm-shared-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(root)
    return root


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


# folders written within each open `scratch`
_WRITTEN: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Deletes at its end the folders that ``cut`` wrote within it, but for
    those taken out of the list; what reads them must be done by then."""
    _WRITTEN.append([])
    try:
        yield _WRITTEN[-1]
    finally:
        for folder in _WRITTEN.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# Parquet looks at the size of what it holds after each row, not after 100
WIDE_ROWS = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1,
             "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 1}


def cut(df: DataFrame, name: str, wide: bool = False) -> DataFrame:
    """Write ``df`` to a new Parquet folder in the shared root and reread it.

    Cuts the lineage: later jobs, and retries after a lost executor, read
    files instead of recomputing, and see the same rows each time. ``wide``
    says that a row may hold megabytes: a writer or reader then has a few
    rows in memory, however many a task writes.
    """
    path = new_folder(df.sparkSession, name)
    df.write.options(**(WIDE_ROWS if wide else {})).parquet(path)
    for written in _WRITTEN:
        written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast of a *written* table only if it has at most ``rows``
    rows; larger tables keep the shuffle join Spark plans for them."""
    return F.broadcast(df) if df.count() <= rows else df


def text_of(col: str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def fold(col: str, buckets: int) -> Column:
    """crc32 of the id written as text, modulo ``buckets`` (null id: null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % buckets


def bound_batches(spark: SparkSession, size: str = "2m") -> None:
    """Arrow batches sent to Python hold at most ``size`` (one row at least)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def ship(spark: SparkSession, value):
    """Broadcast ``value``; a task calls the result to have it. Classes go
    by value, like functions."""
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(held.value)


def give_back() -> None:
    """Return memory that this worker process has freed to the machine; the
    process lives on for other tasks, beside those of other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def frugal(scan):
    """``scan`` that gives its memory back when a task ends."""
    def run(*args):
        yield from scan(*args)
        give_back()
    return run

"""Sinks and load audits.

Full-refresh semantics of the modelled warehouse: every run rewrites its
tables. Each run writes into its own folder under the shared warehouse
root, so readers of an earlier run are never disturbed and a failed run
leaves no half-replaced table behind. ``publish`` then makes a whole run the
one that readers see, and ``retire`` deletes runs that nobody can read.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import quote
from .publication import Entry

CODEC = "zstd"      # ids and descriptions take about half of the default codec's bytes
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# sessions that write just now: how many writes, and the setting before the first
_WRITING: dict[SparkSession, tuple[int, str | None]] = {}
_LOCK = Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it a query's shuffle files go from all disks as it ends, not
    when the driver happens to collect its garbage. A plan that is run again
    shuffles again. Writes of several threads may overlap."""
    with _LOCK:
        count, before = _WRITING.get(spark, (0, spark.conf.get(CLEANUP, None)))
        _WRITING[spark] = count + 1, before
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _LOCK:
            count, before = _WRITING.pop(spark)
            if count > 1:
                _WRITING[spark] = count - 1, before
            elif before is None:
                spark.conf.unset(CLEANUP)
            else:
                spark.conf.set(CLEANUP, before)


def write_table(df: DataFrame, path: str, partition_by=None) -> None:
    """Replace-table sink (S7): overwrite the Parquet folder at ``path``."""
    w = df.write.mode("overwrite").option("compression", CODEC)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def new_run_id() -> str:
    return uuid.uuid4().hex[:12]


def materialize(spark: SparkSession, df: DataFrame, root: str, name: str, run_id: str,
                partition_by=None, audit_nulls=(),
                bucket_by: tuple[int, list[str]] | None = None,
                database: str = "wardmart_runs", dealt: bool = False) -> tuple[DataFrame, dict]:
    """Table materialisation (S8/S10) with a same-pass audit.

    Writes ``<root>/<name>/run=<run_id>`` and returns a fresh scan of it,
    which also cuts the lineage for downstream models. Row count and the
    NULL counts of ``audit_nulls`` are gathered by an Observation during the
    write -- no second pass over the data. Its shuffle files are deleted
    as soon as it ends.

    ``bucket_by=(n, cols)`` writes the table hash-bucketed on ``cols`` into
    ``n`` buckets, registered as external table ``<name>__<run_id>`` of one
    catalog database (``database``; its folder lives under ``root``) so the
    bucket layout is known to readers. Tables bucketed alike on a join key
    are joined without shuffling either side. ``dealt`` says that the rows
    of a bucket meet in one task already.
    """
    path = os.path.join(root, name, f"run={run_id}")
    obs = Observation(f"audit_{name}_{run_id}")
    metrics = [F.count(F.lit(1)).alias("row_count")]
    metrics += [F.count_if(F.col(quote(c)).isNull()).alias(f"null_{c}") for c in audit_nulls]
    observed = df.observe(obs, *metrics)
    if not bucket_by:
        with shuffles_removed(spark):
            write_table(observed, path, partition_by)
        return spark.read.parquet(path), dict(obs.get)
    n, cols = bucket_by
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` "
              f"LOCATION '{os.path.join(root, '_catalog', database)}'")
    table = f"`{database}`.`{name}__{run_id}`"
    # rows of a bucket meet in one task first: one file a bucket
    w = (observed if dealt else observed.repartition(n, *cols)).write.mode("overwrite").format("parquet").option("path", path) \
        .option("compression", CODEC)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with shuffles_removed(spark):
        w.bucketBy(n, *cols).saveAsTable(table)
    return spark.table(table), dict(obs.get)


def entry_of(df: DataFrame, root: str, name: str, run_id: str, metrics: dict,
             bucket_by: tuple[int, list[str]] | None = None, partition_by=()) -> Entry:
    """How a table that ``materialize`` wrote is published."""
    n, cols = bucket_by or (0, [])
    return Entry(os.path.join(root, name, f"run={run_id}"), metrics["row_count"], df.schema.json(), n, list(cols),
                 list(partition_by or ()))


def as_view(df: DataFrame, name: str) -> DataFrame:
    """View materialisation (S9): a named lazy plan."""
    df.createOrReplaceTempView(name)
    return df


def audit_counts(df: DataFrame, null_cols=()) -> DataFrame:
    """Post-load audit as one aggregate pass: rows and per-column NULLs."""
    aggs = [F.count(F.lit(1)).alias("row_count")]
    aggs += [F.count_if(F.col(quote(c)).isNull()).alias(f"null_{c}") for c in null_cols]
    return df.agg(*aggs)

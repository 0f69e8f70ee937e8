"""Table scans (S3, S3b, S4) over Parquet folders."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, root: str, name: str,
               min_partitions: int | None = None) -> DataFrame:
    """Lazy scan of ``<root>/<name>.parquet``; Catalyst prunes columns and
    pushes filters into the Parquet reader.

    A source stored as one unsplittable block (a single file with a single
    row group) scans in one task, and everything up to the first shuffle
    would run on one core. When the scan yields fewer splits than
    ``min_partitions`` the rows are spread round-robin right after the
    scan (columns are still pruned below it). Sources already split into
    many files or row groups are left alone.
    """
    df = spark.read.parquet(os.path.join(root, f"{name}.parquet"))
    if min_partitions and df.rdd.getNumPartitions() < min_partitions:
        df = df.repartition(min_partitions)
    return df


class TableSet:
    """Memoised lazy scans of one folder of tables.

    Returning the same DataFrame object for repeated reads lets Spark reuse
    exchanges when one plan reads a table in several branches.
    """

    def __init__(self, spark: SparkSession, root: str, spread=(),
                 min_partitions: int | None = None):
        """``spread`` names the tables large enough to be worth spreading
        when stored as one unsplittable block."""
        self.spark = spark
        self.root = root
        self.spread = set(spread)
        self.min_partitions = min_partitions or spark.sparkContext.defaultParallelism
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            mp = self.min_partitions if name in self.spread else None
            self._cache[name] = read_table(self.spark, self.root, name, mp)
        return self._cache[name]

"""The hospital x DRG fact partitioned by service line.

A low-cardinality column of a dimension becomes a folder level of the fact,
so a filter on the dimension skips folders: Spark turns it into a pruning of
the fact's partitions while the query runs. A hot line is written by several
tasks, a file each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import DEFAULT_BROADCAST_ROWS, has_at_most
from ..sources import materialize

LINE = "service_line"
FILES = 4       # most files of a line and write


def with_line(fact: DataFrame, dim_drg: DataFrame, drg_small: bool | None) -> DataFrame:
    """The fact with its DRG's service line, the partition column, last."""
    lines = dim_drg.select(F.col("drg_key").alias("__dk"), LINE)
    if drg_small:
        lines = F.broadcast(lines)
    return fact.join(lines, F.col("drg_key") == F.col("__dk")).drop("__dk")


def spread(df: DataFrame) -> DataFrame:
    """Rows of a line meet in at most ``FILES`` tasks."""
    return df.repartition(F.col(LINE), F.pmod(F.xxhash64("hospital_key"), F.lit(FILES)))


def write_by_line(spark: SparkSession, df: DataFrame, root: str, run_id: str) -> tuple[DataFrame, dict]:
    """A new run of the partitioned fact, with its audit."""
    return materialize(spark, spread(df), root, "fct_medicare_drg_by_line", run_id, partition_by=[LINE])


def replace_lines(df: DataFrame, path: str) -> None:
    """Replace the partitions of the lines that ``df`` holds, and no others."""
    spread(df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LINE).parquet(path)


def rows_of(by_line: DataFrame, dim_drg: DataFrame, wanted: Column, drg_small: bool | None) -> DataFrame:
    """Fact rows of the DRGs that ``wanted`` (over the dimension) selects;
    only the folders of their lines are read."""
    drg = dim_drg.where(wanted).select(F.col("drg_key").alias("__dk"), F.col(LINE).alias("__line"), "drg_code")
    # few wanted DRGs are broadcast from a dimension of any size
    if drg_small or (drg_small is False and has_at_most(drg, DEFAULT_BROADCAST_ROWS)):
        drg = F.broadcast(drg)
    return by_line.join(drg, (F.col(LINE) == F.col("__line")) & (F.col("drg_key") == F.col("__dk"))) \
        .drop("__dk", "__line")

"""Row generators: the day spine behind the date dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _days(start: Column, end_exclusive: Column) -> Column:
    # ``sequence`` is inclusive; an empty range (end <= start) yields no rows.
    last = F.date_sub(end_exclusive, 1)
    return F.when(last >= start, F.sequence(start, last, F.expr("interval 1 day"))) \
        .otherwise(F.array().cast("array<date>"))


def date_spine(spark: SparkSession, start: str, end_exclusive: str) -> DataFrame:
    """One row per day in [start, end_exclusive), column ``date_day``."""
    one = spark.range(1)
    return one.select(F.explode(_days(F.to_date(F.lit(start)),
                                      F.to_date(F.lit(end_exclusive)))).alias("date_day"))


def date_spine_between(bounds: DataFrame, start_col: str, end_col: str) -> DataFrame:
    """Day spine from a one-row DataFrame of data-derived bounds.

    The row count is the day span (bounded by the calendar, not by the data
    volume), so a single generator task is fine.
    """
    return bounds.select(F.explode(_days(F.col(start_col).cast("date"),
                                         F.col(end_col).cast("date"))).alias("date_day"))

"""Mergeable sketches: quantiles and distinct counts from stored states.

A state is a small binary built in one grouped aggregate; states of parts,
days or groups are kept as a table and merged to any coarser grouping
without reading the rows again.

* Quantiles are KLL sketches. Up to ``k`` values a state is exact; beyond,
  the rank of an answer is off by at most ``quantile_error(k)`` of the
  values, with a chance of 99 %, also after merging.
* Distinct counts are HyperLogLog sketches with 2^``lg_k`` registers; the
  relative standard error is ``distinct_error(lg_k)``. Values that several
  groups share are counted once in their union.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col_of

K = 2_048
LG_K = 12


def quantile_error(k: int = K) -> float:
    """Normalised rank error of a KLL sketch of size ``k`` at 99 % confidence
    (the sketch's published bound for single queries)."""
    return 2.296 / k ** 0.9021


def distinct_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / math.sqrt(1 << lg_k)


def quantile_states(df: DataFrame, groups: list[str], col: str, k: int = K) -> DataFrame:
    """(groups, n, quantiles): one state per group over the known values."""
    x = col_of(col).cast("double")
    return df.where(x.isNotNull()).groupBy(*[col_of(g) for g in groups]).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(x, F.lit(k)).alias("quantiles"))


def merge_quantiles(states: DataFrame, groups: list[str]) -> DataFrame:
    """States merged to the coarser ``groups`` (none: one state)."""
    return states.groupBy(*[col_of(g) for g in groups]).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("quantiles").alias("quantiles"))


def quantile(share: float) -> Column:
    """The smallest value with at least ``share`` of the values up to it."""
    return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(share)))


def distinct_states(df: DataFrame, groups: list[str], col: str, lg_k: int = LG_K) -> DataFrame:
    """(groups, distinct): one state per group over the known values."""
    return df.where(col_of(col).isNotNull()).groupBy(*[col_of(g) for g in groups]).agg(
        F.hll_sketch_agg(col_of(col), F.lit(lg_k)).alias("distinct"))


def merge_distinct(states: DataFrame, groups: list[str]) -> DataFrame:
    """The union of the states of each of the coarser ``groups``."""
    return states.groupBy(*[col_of(g) for g in groups]).agg(F.hll_union_agg("distinct").alias("distinct"))


def distinct_estimate() -> Column:
    return F.hll_sketch_estimate("distinct")

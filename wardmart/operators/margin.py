"""Cost / margin derivation and the ranked roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..functions.text import col_of
from .cache import settled
from .exact import exact_sums
from .joins import keyed_join
from .rank import global_rank


def usable_ratio(df: DataFrame, ratio: str, outlier_flag: str) -> DataFrame:
    """Rows whose ratio is known and not flagged (a NULL flag is not usable)."""
    return df.where(col_of(ratio).isNotNull() & (col_of(outlier_flag) == F.lit(False)))


def derive_margin(df: DataFrame, charge: str, payment: str, ratio: str,
                  cost_name: str = "derived_cost", margin_name: str = "margin") -> DataFrame:
    """derived_cost = charge x ratio; margin = payment - derived_cost."""
    cost = col_of(charge) * col_of(ratio)
    return df.withColumns({cost_name: cost, margin_name: col_of(payment) - cost})


def rollup_groups(df: DataFrame, groups: list[str], measure: str, sums: dict[str, str],
                  volume: str, volume_name: str, avg_name: str) -> DataFrame:
    """One row per group: average of ``measure``, totals and volume, as full
    values that do not depend on the order of summation."""
    return exact_sums(df, groups, {"__m": measure, **sums}, {volume_name: col_of(volume)}, {avg_name: "__m"}) \
        .select(*[col_of(c) for c in [*groups, avg_name, *sums, volume_name]])


def rank_groups(grouped: DataFrame, groups: list[str], volume_name: str, min_volume: float,
                avg_name: str, key_name: str, rank_within: str, form: str = "union") -> DataFrame:
    """Rank qualifying groups globally and within ``rank_within``; keep every group.

    * groups under ``min_volume`` (or with unknown volume) get NULL ranks;
    * ``form="union"`` ranks the qualifying groups and unions the rest back
      (no join); ``form="join"`` left-joins the ranked subset back on the
      group keys with null-safe equality, as a self-join would.

    The groups are checkpointed first: their sums are evaluated once, and the
    ranking and the output see the same numbers. The within-partition rank
    window holds at most one row per value of the other group keys, so its
    partitions are bounded by that dimension; the global rank uses the
    distributed operator in ``rank.py``.
    """
    meets = col_of(volume_name) >= F.lit(min_volume)
    agg = settled(grouped.select(surrogate_key(*groups).alias(key_name), "*",
                                 meets.alias("meets_volume_threshold")))
    qualifying = agg.where(F.coalesce(F.col("meets_volume_threshold"), F.lit(False)))
    others = [g for g in groups if g != rank_within]
    w = Window.partitionBy(col_of(rank_within)).orderBy(col_of(avg_name).asc_nulls_last())
    ranked = global_rank(qualifying, avg_name, "global_rank", settle=False) \
        .withColumn("metro_rank", F.rank().over(w).cast("bigint"))
    cols = agg.columns + ["global_rank", "metro_rank"]
    if form == "union":
        rest = agg.where(~F.coalesce(F.col("meets_volume_threshold"), F.lit(False))) \
            .withColumns({"global_rank": F.lit(None).cast("bigint"),
                          "metro_rank": F.lit(None).cast("bigint")})
        return ranked.select(cols).unionByName(rest.select(cols))
    ranks = ranked.select(*others, rank_within, "global_rank", "metro_rank")
    return keyed_join(agg, ranks, keys=others, null_safe_keys=[rank_within], how="left") \
        .select(cols)


def rollup_ranked(df: DataFrame, groups: list[str], measure: str, sums: dict[str, str],
                  volume: str, volume_name: str, min_volume: float, avg_name: str,
                  key_name: str, rank_within: str, form: str = "union") -> DataFrame:
    """``rollup_groups`` then ``rank_groups``."""
    grouped = rollup_groups(df, groups, measure, sums, volume, volume_name, avg_name)
    return rank_groups(grouped, groups, volume_name, min_volume, avg_name, key_name, rank_within, form)

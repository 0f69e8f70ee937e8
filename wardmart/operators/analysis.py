"""Descriptive analyses over the marts.

Each is one aggregate (or one join + aggregate) over the input; results
are small, but nothing is collected: they come back as DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col_of
from ..functions.values import stable_round
from .exact import exact_sums
from .joins import keyed_join
from .moments import correlation, merge_moments, moment_states, sample_stddev


def _shown(c: Column, digits: int | None) -> Column:
    """The full value; rounded only where a caller asks for digits."""
    return c if digits is None else stable_round(c, digits)


def pair_corr(df: DataFrame, x: str, y: str, digits: int | None = None) -> DataFrame:
    """Pearson correlation over rows where both values are known, and n."""
    return corr_of(moment_states(df, [], x, y), digits)


def corr_of(states: DataFrame, digits: int | None = None) -> DataFrame:
    """``pair_corr`` from moment states, stored or not."""
    return merge_moments(states, []).select(_shown(correlation(), digits).alias("correlation"),
                                            F.col("n").alias("n_pairs"))


def share_where(df: DataFrame, cond: Column, name: str, where: Column | None = None,
                digits: int | None = None) -> DataFrame:
    """Count of rows meeting ``cond``, the row total and the share."""
    d = df if where is None else df.where(where)
    hit = F.count_if(cond)
    total = F.count(F.lit(1))
    return d.agg(hit.alias(f"{name}_rows"), total.alias("total_rows"),
                 _shown(F.when(total > 0, hit / total), digits).alias(f"{name}_share"))


def weighted_total(df: DataFrame, a: str, b: str, name: str, digits: int | None = None) -> DataFrame:
    """sum(a x b) over all rows: the products are doubles, their sum exact."""
    total = exact_sums(df, [], {name: col_of(a).cast("double") * col_of(b).cast("double")})
    return total.select(_shown(F.col(name), digits).alias(name))


def distinct_count(df: DataFrame, col: str, name: str, approx: bool = False,
                   where: Column | None = None) -> DataFrame:
    """Distinct non-NULL values (exact, or HyperLogLog++ at scale)."""
    d = df if where is None else df.where(where)
    agg = F.approx_count_distinct(col_of(col)) if approx else F.count_distinct(col_of(col))
    return d.agg(agg.alias(name))


def spread(df: DataFrame, group: str, col: str, digits: int | None = None) -> DataFrame:
    """Per group: number of rows, min, max, range and sample stddev."""
    return spread_of(moment_states(df, [group], col), extremes(df, group, col), group, digits)


def extremes(df: DataFrame, group: str, col: str) -> DataFrame:
    """Per group: rows, min and max. Rows of such tables merge by sum, min
    and max."""
    c = col_of(col)
    return df.groupBy(col_of(group)).agg(F.count(F.lit(1)).alias("n_groups"), F.min(c).alias("min_value"),
                                         F.max(c).alias("max_value"))


def spread_of(states: DataFrame, ends: DataFrame, group: str, digits: int | None = None) -> DataFrame:
    """``spread`` from moment states and extremes, stored or not."""
    merged = merge_moments(states, [group]).select(col_of(group), sample_stddev().alias("__stddev"))
    j = keyed_join(ends, merged, null_safe_keys=[group], how="left")
    return j.select(col_of(group), "n_groups", _shown(F.col("min_value"), digits).alias("min_value"),
                    _shown(F.col("max_value"), digits).alias("max_value"),
                    _shown(F.col("max_value") - F.col("min_value"), digits).alias("value_range"),
                    _shown(F.col("__stddev"), digits).alias("stddev_value"))


def mismatch_rates(left: DataFrame, right: DataFrame, key: str,
                   pairs: dict[str, tuple[str, str]], digits: int | None = None) -> DataFrame:
    """Join two sources on ``key``; per attribute pair, the share of joined
    rows whose values differ (NULL vs value counts as different)."""
    j = left.join(right, key, "inner")
    aggs = [F.count(F.lit(1)).alias("matched_keys")]
    for name, (a, b) in pairs.items():
        aggs.append(_shown(F.avg((~col_of(a).eqNullSafe(col_of(b))).cast("int")),
                                 digits).alias(f"{name}_mismatch_rate"))
    return j.agg(*aggs)


def known_rate(df: DataFrame, flag: str, digits: int | None = None) -> DataFrame:
    """Among rows where the three-valued ``flag`` is known: true count, known
    count and rate."""
    f = col_of(flag)
    known = F.count_if(f.isNotNull())
    hit = F.count_if(f)
    return df.agg(hit.alias("flagged"), known.alias("known"),
                  _shown(F.when(known > 0, hit / known), digits).alias("flag_rate"))


def null_lift(df: DataFrame, target: str, category: str, digits: int | None = None) -> DataFrame:
    """Per category: rows, rows with NULL ``target``, category share among
    NULL rows vs among all rows, and their ratio (lift).

    The totals are one aggregate over the groups, joined on as one row.
    """
    g = df.groupBy(col_of(category)).agg(
        F.count(F.lit(1)).alias("rows_all"),
        F.count_if(col_of(target).isNull()).alias("rows_null"))
    totals = g.agg(F.sum("rows_null").alias("__null"), F.sum("rows_all").alias("__all"), F.lit(1).alias("__one"))
    g = g.join(F.broadcast(totals), F.lit(1) == F.col("__one"))
    share_null = F.when(F.col("__null") > 0, F.col("rows_null") / F.col("__null"))
    share_all = F.when(F.col("__all") > 0, F.col("rows_all") / F.col("__all"))
    return g.select(category, "rows_all", "rows_null",
                    _shown(share_null, digits).alias("share_of_nulls"),
                    _shown(share_all, digits).alias("share_of_all"),
                    _shown(F.when(share_all > 0, share_null / share_all), digits).alias("lift"))


def conditional_means(df: DataFrame, cond: Column, cols: list[str],
                      digits: int | None = None) -> DataFrame:
    """For each column: average over rows meeting ``cond`` and overall."""
    sums, means = {}, {}
    for c in cols:
        sums |= {f"__g_{c}": F.when(cond, col_of(c).cast("double")), f"__o_{c}": c}
        means |= {f"{c}_group_avg": f"__g_{c}", f"{c}_overall_avg": f"__o_{c}"}
    total = exact_sums(df, [], sums, {"group_rows": F.when(cond, 1).otherwise(0), "all_rows": F.lit(1)}, means)
    return total.select(F.coalesce("group_rows", F.lit(0).cast("bigint")).alias("group_rows"),
                        F.coalesce("all_rows", F.lit(0).cast("bigint")).alias("all_rows"),
                        *[_shown(F.col(m), digits).alias(m) for m in means])


def two_lowest(df: DataFrame, col: str, digits: int | None = None) -> DataFrame:
    """Lowest and next-lowest row values of ``col`` and their ratio (the
    extremes check). A top-2 (per-task top-2, merged) then one tiny
    aggregate; NULLs are skipped."""
    c = col_of(col)
    two = df.where(c.isNotNull()).select(c.alias("__v")).orderBy("__v").limit(2)
    lowest, second = F.min("__v"), F.max("__v")
    return two.agg(_shown(lowest, digits).alias("lowest_value"),
                   _shown(second, digits).alias("second_lowest_value"),
                   _shown(F.when(second != 0, lowest / second), digits).alias("ratio"))


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows by ``order`` (TakeOrderedAndProject: per-task top-n,
    then a merge of n rows per task)."""
    return df.orderBy(*order).limit(n)

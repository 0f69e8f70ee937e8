"""Mergeable sketches against the exact operators, within their bounds."""

import random
from bisect import bisect_left, bisect_right

from pyspark.sql import functions as F

from wardmart.operators import sketches as K

SHARES = (0.01, 0.05, 0.25, 0.5, 0.9)


def test_small_states_are_exact(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), float(rng.randint(0, 50))) for _ in range(900)] + [("a", None), ("c", None)]
    states = K.quantile_states(spark.createDataFrame(rows, "g string, x double").repartition(4), ["g"], "x")
    for groups, key in ((["g"], lambda r: r[0]), ([], lambda r: None)):
        merged = K.merge_quantiles(states, groups)
        for r in merged.select(*groups, "n", *[K.quantile(s).alias(f"q{s}") for s in SHARES]).collect():
            values = sorted(x for g, x in rows if x is not None and (not groups or g == r.g))
            assert r.n == len(values)
            for s in SHARES:
                assert r[f"q{s}"] == next(v for i, v in enumerate(values, 1) if i >= s * len(values) - 1e-9)
    assert K.quantile_states(spark.createDataFrame(rows, "g string, x double").limit(0), ["g"], "x").collect() == []


def test_rank_error_stays_within_the_bound_after_merging(spark):
    n, k = 200_000, 200
    df = spark.range(n).select((F.col("id") % 40).alias("day"), F.pow(F.rand(7), 4).alias("x")).repartition(8)
    df = df.cache()
    values = sorted(r.x for r in df.select("x").collect())
    states = K.quantile_states(df, ["day"], "x", k)
    assert states.count() == 40
    merged = K.merge_quantiles(states, []).select(*[K.quantile(s).alias(f"q{s}") for s in SHARES]).collect()[0]
    for s in SHARES:
        low, high = bisect_left(values, merged[f"q{s}"]) / n, bisect_right(values, merged[f"q{s}"]) / n
        # twice the bound of 99 %: a failure by chance is out of the question
        assert low - 2 * K.quantile_error(k) <= s <= high + 2 * K.quantile_error(k)
    df.unpersist()


def test_distinct_counts_of_overlapping_groups(spark):
    df = spark.range(300_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 60_000).alias("v"),
                                     (F.col("id") % 21).alias("few"))
    states = K.distinct_states(df, ["g"], "v")
    total = K.merge_distinct(states, []).select(K.distinct_estimate().alias("n")).first().n
    assert abs(total - 60_000) <= 4 * K.distinct_error() * 60_000
    for r in states.select("g", K.distinct_estimate().alias("n")).collect():
        assert abs(r.n - 20_000) <= 4 * K.distinct_error() * 20_000
    few = K.distinct_states(df, ["g"], "few")
    assert {r.n for r in few.select(K.distinct_estimate().alias("n")).collect()} == {7}
    assert K.merge_distinct(few, []).select(K.distinct_estimate().alias("n")).first().n == 21

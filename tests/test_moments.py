"""Moments from states against exact arithmetic, in any order and split."""

import math
import random
import struct
from fractions import Fraction

from pyspark.sql import functions as F

from wardmart.operators import analysis as A
from wardmart.operators.moments import correlation, merge_moments, moment_states, sample_stddev


def bits(v):
    return None if v is None else struct.pack("d", v)


def exact(pairs):
    n = len(pairs)
    x, y = [Fraction(p[0]) for p in pairs], [Fraction(p[1]) for p in pairs]
    mx, my = sum(x) / n, sum(y) / n
    xx, yy = sum((v - mx) ** 2 for v in x), sum((v - my) ** 2 for v in y)
    xy = sum((a - mx) * (b - my) for a, b in zip(x, y))
    return float(xy) / math.sqrt(xx) / math.sqrt(yy), math.sqrt(xx / (n - 1))


def data(seed, n=600):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        g = rng.choice(["hot", "hot", "hot", "b", None, f"g{i % 7}"])
        x = (1e9 if g == "b" else 0.0) + rng.gauss(3, 2)     # far from zero: naive sums of squares fail
        rows.append((g, x, 0.5 * x + rng.gauss(0, 1)))
    return rows + [("single", 1.0, 2.0), ("b", None, 1.0), ("hot", 1.0, None)]


def frame(spark, rows, parts):
    return spark.createDataFrame(rows, "g string, x double, y double").repartition(parts)


def test_moments_match_exact_arithmetic(spark):
    rows = data(1)
    got = {r.g: r for r in merge_moments(moment_states(frame(spark, rows, 5), ["g"], "x", "y"), ["g"])
           .select("*", correlation().alias("r"), sample_stddev().alias("s")).collect()}
    for g in {r[0] for r in rows}:
        pairs = [(x, y) for k, x, y in rows if k == g and x is not None and y is not None]
        assert got[g].n == len(pairs)
        if len(pairs) > 1:
            r, s = exact(pairs)
            assert math.isclose(got[g].r, r, rel_tol=1e-9) and math.isclose(got[g].s, s, rel_tol=1e-9)
    assert got["single"].s is None and math.isnan(got["single"].r)


def test_bits_do_not_depend_on_order_splits_or_storage(spark, tmpdir_path):
    rows = data(2)
    first = None
    for seed, parts in ((0, 1), (1, 4), (2, 9)):
        df = frame(spark, random.Random(seed).sample(rows, len(rows)), parts)
        states = moment_states(df, ["g"], "x", "y")
        states.write.mode("overwrite").parquet(f"{tmpdir_path}/states")
        stored = spark.read.parquet(f"{tmpdir_path}/states").repartition(parts)
        for s in (states, stored):
            corr = sorted(((r.g or "", bits(r.r), bits(r.m2_x)) for r in merge_moments(s, ["g"])
                           .select("g", "m2_x", correlation().alias("r")).collect()))
            first = first or corr
            assert corr == first
        ends = A.extremes(df, "g", "x")
        direct, again = A.spread(df, "g", "x"), A.spread_of(moment_states(df, ["g"], "x"), ends, "g")
        assert sorted(map(str, direct.collect())) == sorted(map(str, again.collect()))
        # rows without a y count for x alone, so the correlation states are others
        assert df.where("x IS NOT NULL").count() != df.where("x IS NOT NULL AND y IS NOT NULL").count()


def test_later_extracts_are_added(spark):
    rows = [r for r in data(3) if None not in r[1:]]
    old, new = (moment_states(frame(spark, part, 3), [], "x", "y").withColumn("extract", F.lit(i))
                for i, part in enumerate((rows[:200], rows[200:])))
    got = merge_moments(old.unionByName(new), [], ["extract", "part"]).select("n", correlation().alias("r")).collect()
    assert got[0].n == len(rows) and math.isclose(got[0].r, exact([r[1:] for r in rows])[0], rel_tol=1e-9)


def test_without_rows(spark):
    empty = frame(spark, data(1), 1).limit(0)
    assert [tuple(r) for r in A.pair_corr(empty, "x", "y").collect()] == [(None, 0)]
    assert A.spread(empty, "g", "x").collect() == []
    assert [tuple(r) for r in A.conditional_means(empty, F.lit(True), ["x"]).collect()] == [(0, 0, None, None)]
    nan = frame(spark, [("a", math.nan, 1.0), ("a", 1.0, 2.0)], 1)
    assert math.isnan(A.pair_corr(nan, "x", "y").collect()[0].correlation)


def test_conditional_means_are_exact(spark):
    df = frame(spark, [("a", 0.1, 1e300), ("a", 0.2, 1.0), ("b", 0.3, -1e300)], 3)
    got = A.conditional_means(df, F.col("g") == "a", ["x", "y"]).collect()[0]
    assert (got.group_rows, got.all_rows) == (2, 3)
    assert got.x_group_avg == float(Fraction(0.1) + Fraction(0.2)) / 2 and got.y_overall_avg == 1 / 3

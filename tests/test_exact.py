"""Exact sums against exact rational arithmetic."""

import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from wardmart.operators.exact import exact_sums


def true_sum(values):
    """The sum as plain additions of any order agree on it, rounded once."""
    known = [v for v in values if v is not None]
    if not known:
        return None
    if any(math.isnan(v) for v in known) or {math.inf, -math.inf} <= set(known):
        return math.nan
    special = [v for v in known if math.isinf(v)]
    if special:
        return special[0]
    total = sum(map(Fraction, known), Fraction(0))
    try:
        return total.numerator / total.denominator
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def same(a, b):
    if a is None or b is None:
        return a is b
    return struct.pack("d", a + 0.0) == struct.pack("d", b + 0.0) or (math.isnan(a) and math.isnan(b))


def sums(spark, groups, parts=3):
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, x double").repartition(parts)
    return {r.g: r.s for r in exact_sums(df, ["g"], {"s": "x"}).collect()}


TINY, HUGE = 5e-324, 1.7976931348623157e308
GROUPS = {
    "cancel": [1e300, 1.0, -1e300], "small": [1e-14] * 7, "nan": [1.0, math.nan], "both": [math.inf, -math.inf, 1.0],
    "up": [math.inf, -1e308], "down": [-math.inf], "null": [None, None], "some": [None, 2.5], "zero": [0.0, -0.0],
    "nothing left": [1e17, 3.0, -3.0, -1e17], "beyond": [HUGE, HUGE], "back": [HUGE, HUGE, -HUGE, 1.0],
    "tiny": [TINY] * 5, "minus tiny": [-TINY, 1.0, -1.0], "subnormal": [2.2250738585072014e-308, -TINY],
    "tie": [2.0 ** 53, 1.0], "above tie": [2.0 ** 53, 1.0, 1e-300], "even": [2.0 ** 53 + 2, 1.0],
    "under tie": [2.0 ** 53 + 2, 1.0, -1e-300], "negative": [-0.1] * 10, "1e17": [1e17, 0.3, 1e16, 0.7],
    "digits": [1e-11, 2e-12, 123.0], "powers": [2.0 ** e for e in range(-1074, 1023, 7)],
    "minus powers": [-(2.0 ** e) for e in range(-1074, 1024)],
}


def test_named_sums_are_exact(spark):
    got = sums(spark, GROUPS)
    assert {g: (got[g], true_sum(v)) for g, v in GROUPS.items() if not same(got[g], true_sum(v))} == {}


def test_random_sums_are_exact_in_any_order(spark):
    rng = random.Random(3)
    groups = {}
    for i in range(300):
        reach = rng.choice([1, 20, 300])
        vs = [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.uniform(-reach, reach) for _ in range(rng.randint(1, 12))]
        if i % 3 == 0:      # all but a little cancels
            vs += [-v for v in vs[1:]]
        if i % 4 == 0:      # exact bit patterns
            vs = [v for v in struct.unpack("8d", rng.randbytes(64)) if math.isfinite(v)] or [1.0]
        groups[f"r{i}"] = vs
    first = sums(spark, groups)
    assert [g for g in groups if not same(first[g], true_sum(groups[g]))] == []
    mixed = {g: rng.sample(vs, len(vs)) for g, vs in groups.items()}
    again = sums(spark, mixed, parts=7)
    assert all(same(first[g], again[g]) for g in groups)


def test_powers_of_two_are_exact(spark):
    rows = spark.range(-1074, 1024).select("id", F.pow(F.lit(2.0), F.col("id")).alias("p")).collect()
    assert all(r.p == math.ldexp(1.0, r.id) for r in rows)


def test_means_others_no_groups_and_odd_names(spark):
    df = spark.createDataFrame([("a", 0.1, 1), ("a", 0.2, 2), ("a", None, 3), (None, 5.0, 4)],
                               "`group name` string, `x+y` double, v long")
    got = {r[0]: tuple(r)[1:] for r in exact_sums(df, ["group name"], {"s": "x+y", "t": F.col("v") * 0.5},
                                                  {"volume": F.col("v")}, {"mean": "s"}).collect()}
    assert got == {"a": (true_sum([0.1, 0.2]) / 2, true_sum([0.1, 0.2]), 3.0, 6), None: (5.0, 5.0, 2.0, 4)}
    whole = exact_sums(df, [], {"s": "x+y"}).collect()
    assert [tuple(r) for r in whole] == [(true_sum([0.1, 0.2, 5.0]),)]
    assert [tuple(r) for r in exact_sums(df.limit(0), [], {"s": "x+y"}).collect()] == [(None,)]
    assert exact_sums(df.limit(0), ["group name"], {"s": "x+y"}).collect() == []


def test_rows_are_combined_before_each_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS g", "id * 0.1D AS x")
    plan = exact_sums(df, ["g"], {"s": "x"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_sum") >= 4 and "Python" not in plan


@pytest.mark.parametrize("parts", [1, 8])
def test_rollup_has_the_same_bits_in_any_order(spark, parts):
    from wardmart.operators import rollup_groups
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.uniform(-1e5, 1e5), rng.uniform(0, 1e17), rng.randint(1, 9)) for _ in range(400)]
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "g string, m double, p double, v long").repartition(parts)
    for r in rollup_groups(df, ["g"], "m", {"total": "p"}, "v", "volume", "avg").collect():
        mine = [x for x in rows if x[0] == r.g]
        assert r.total == true_sum([x[2] for x in mine]) and r.volume == sum(x[3] for x in mine)
        assert r.avg == true_sum([x[1] for x in mine]) / len(mine)

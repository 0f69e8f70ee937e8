import math
import random

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from wardmart.operators import exact_percentiles, global_rank, rollup_groups, rollup_ranked


def test_global_rank_equals_sql_rank_with_ties_and_nulls(spark):
    rnd = random.Random(7)
    vals = [float(rnd.randint(0, 40)) for _ in range(3000)] + [None] * 5
    # a hot value: a third of all rows
    vals += [17.0] * 1500
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    ours = global_rank(df, "v", "r", buckets=8)
    ref = df.withColumn("r_ref", F.rank().over(Window.orderBy(F.col("v").asc_nulls_last())))
    j = ours.join(ref.select("id", "r_ref"), "id")
    assert j.count() == len(vals)
    assert j.where(F.col("r") != F.col("r_ref")).count() == 0


def test_global_rank_descending(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 7.0), (4, 1.0)], "id int, v double")
    got = {r.id: r.r for r in global_rank(df, "v", "r", ascending=False, buckets=2).collect()}
    assert got == {2: 1, 3: 1, 1: 3, 4: 4}


def _is_sql_rank(df, order, n, **kw):
    ours = global_rank(df, "v", "r", **kw)
    ref = df.withColumn("r_ref", F.rank().over(Window.orderBy(order)))
    j = ours.join(ref.select("id", "r_ref"), "id")
    assert j.count() == n and j.where(F.col("r") != F.col("r_ref")).count() == 0
    return ours


def test_rank_of_ties_across_tasks_specials_and_directions(spark):
    rnd = random.Random(8)
    # three values with a fifth each, ties over every bucket's ends, NaN, infinities and NULLs
    vals = [rnd.choice([5.0, -1.0, 7.25]) for _ in range(1800)] + [float(rnd.randint(0, 60)) for _ in range(900)]
    vals += [math.nan] * 40 + [None] * 30 + [math.inf, -math.inf] * 9
    df = spark.createDataFrame(list(enumerate(vals)), "id long, v double").repartition(5)
    v = F.col("v")
    for kw, order in (({"buckets": 16}, v.asc_nulls_last()), ({"buckets": 300}, v.asc_nulls_last()), ({}, v.asc_nulls_last()),
                      ({"buckets": 16, "nulls_last": False}, v.asc_nulls_first()),
                      ({"buckets": 16, "ascending": False}, v.desc_nulls_last()),
                      ({"ascending": False, "nulls_last": False}, v.desc_nulls_first())):
        _is_sql_rank(df, order, len(vals), **kw)
    _is_sql_rank(df.limit(0), v.asc(), 0, buckets=4)
    same = spark.range(500).withColumn("v", F.lit(3.0))
    assert global_rank(same, "v", "r", buckets=8).select("r").distinct().collect()[0].r == 1


def test_rank_shuffles_the_rows_once_and_evenly(spark):
    df = spark.range(20_000).withColumn("v", F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.rand(3)))
    ranked = global_rank(df, "v", "r", buckets=16)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(__b") == 1 and "SortMergeJoin" not in plan
    # the other exchange is that of the buckets' counts
    assert plan.count("Exchange hashpartitioning") == 2
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in global_rank(df, "v", "r", buckets=16).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(sizes) < 20_000 / 3      # the hot value alone has as many


def test_exact_percentiles_match_linear_interpolation(spark):
    rnd = random.Random(3)
    vals = [rnd.randint(1, 500) for _ in range(997)]
    df = spark.createDataFrame([(v,) for v in vals], "v long")
    row = exact_percentiles(df, "v", [0.05, 0.25, 0.5, 1.0], buckets=6).collect()[0]
    for name, p in [("p5", 5), ("p25", 25), ("p50", 50), ("p100", 100)]:
        assert abs(row[name] - float(np.percentile(vals, p))) < 1e-9


def _fixture(spark):
    rows = [
        # service_line, metro, margin, discharges
        ("Onc", "M1", -100.0, 10), ("Onc", "M1", -40.0, 20),     # volume 30: ranked
        ("Card", "M1", 10.0, 29),                                # volume 29: not ranked
        ("Onc", None, -75.0, 40), ("Card", None, -75.0, 35),     # NULL metro, tied averages
        ("Ortho", "M2", 5.0, 100),                               # group of one
    ]
    return spark.createDataFrame(rows, "service_line string, metro_name string, margin double, "
                                       "total_discharges long")


def _rollup(df, form):
    return rollup_ranked(df, ["service_line", "metro_name"], "margin", {"total_margin": "margin"},
                         "total_discharges", "total_discharge_volume", 30, "avg_margin",
                         "key", "metro_name", form)


def test_rollup_ranked_threshold_ties_and_null_metro(spark):
    out = {(r.service_line, r.metro_name): r for r in _rollup(_fixture(spark), "union").collect()}
    assert len(out) == 5
    assert out[("Card", "M1")].global_rank is None and out[("Card", "M1")].meets_volume_threshold is False
    assert out[("Onc", "M1")].meets_volume_threshold is True
    assert out[("Onc", None)].global_rank == 1 and out[("Card", None)].global_rank == 1
    assert out[("Onc", "M1")].global_rank == 3 and out[("Ortho", "M2")].global_rank == 4
    assert out[("Onc", None)].metro_rank == 1 and out[("Card", None)].metro_rank == 1
    assert out[("Onc", "M1")].metro_rank == 1


def test_rollup_union_form_equals_join_form(spark):
    df = _fixture(spark)
    a = sorted(tuple(r) for r in _rollup(df, "union").collect())
    b = sorted(tuple(r) for r in _rollup(df, "join").collect())
    assert a == b


def test_partitioned_global_rank_equals_sql_rank(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(4000):
        # partition "hot" holds about a third of the rows; NULL is a partition
        p = "hot" if i % 3 == 0 else rnd.choice(["a", "b", None])
        v = None if i % 97 == 0 else float(rnd.randint(0, 300))
        rows.append((i, p, v))
    df = spark.createDataFrame(rows, "id long, p string, v double")
    ours = global_rank(df, "v", "r", buckets=8, partition_by=["p"])
    ref = df.withColumn("r_ref", F.rank().over(Window.partitionBy("p").orderBy(F.col("v").asc_nulls_last())))
    j = ours.join(ref.select("id", "r_ref"), "id")
    assert j.count() == len(rows)
    assert j.where(F.col("r") != F.col("r_ref")).count() == 0


def test_global_rank_with_many_buckets_uses_binary_search(spark):
    rnd = random.Random(5)
    vals = [rnd.random() * 1000 for _ in range(5000)] + [42.0] * 2000
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    ours = global_rank(df, "v", "r", buckets=1000)
    ref = df.withColumn("r_ref", F.rank().over(Window.orderBy("v")))
    j = ours.join(ref.select("id", "r_ref"), "id")
    assert j.count() == len(vals) and j.where(F.col("r") != F.col("r_ref")).count() == 0


def test_bucket_of_tree_and_search_agree(spark):
    from wardmart.operators.rank import _bucket_of
    bounds = sorted({float(b) for b in random.Random(9).sample(range(10000), 300)})
    probe = [float(x) for x in range(-5, 10010, 7)] + bounds
    df = spark.createDataFrame([(x,) for x in probe], "v double")
    got = [r[0] for r in df.select(_bucket_of(F.col("v"), bounds)).collect()]
    import bisect
    assert got == [bisect.bisect_left(bounds, x) for x in probe]
    small = bounds[:40]
    got_small = [r[0] for r in df.select(_bucket_of(F.col("v"), small)).collect()]
    assert got_small == [bisect.bisect_left(small, x) for x in probe]


def test_exact_sums_keep_large_values_and_nan(spark):
    rows = [("a", 1e14, 1), ("a", 0.1, 1), ("b", 1e17, 1), ("b", 5e17, 1), ("c", float("nan"), 1), ("c", 1.0, 1),
            ("d", None, 1), ("e", 0.1, 1), ("e", 0.2, 1)]
    df = spark.createDataFrame(rows, "g string, v double, n long")
    out = {r.g: r for r in rollup_groups(df, ["g"], "v", {"total": "v"}, "n", "volume", "avg").collect()}
    assert out["a"].total == 1e14 + 0.1 and out["b"].total == 6e17 and out["b"].avg == 3e17
    assert math.isnan(out["c"].total) and out["d"].total is None and out["d"].avg is None
    assert out["e"].total == 0.1 + 0.2                # the two doubles' sum, rounded once


def test_rank_is_a_bigint(spark):
    ranked = global_rank(spark.createDataFrame([(1.0,), (2.0,)], "v double"), "v", "r")
    assert dict(ranked.dtypes)["r"] == "bigint"


def test_rank_reads_its_input_once(spark):
    scans = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(v):
        scans.add(1)
        return v

    df = spark.range(100).select(seen((F.col("id") % 7).cast("double")).alias("v"))
    assert global_rank(df, "v", "r").where("r > 0").count() == 100
    assert scans.value == 100

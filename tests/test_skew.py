"""Split joins and Bloom pruning against plain joins."""

import random

import pytest
from pyspark.sql import functions as F

from wardmart.operators import bloom_filter, hot_keys, orphans, pruned_join, pruned_orphans, split_join
from wardmart.operators import skew


@pytest.fixture()
def no_auto_broadcast(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, v in before.items():
        spark.conf.set(n, v) if v else spark.conf.unset(n)


def fact(spark, n=20_000):
    """A third of the rows has one key, some have none or an unknown one."""
    return spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL WHEN id % 7 = 2 THEN concat('x', id) "
        "ELSE concat('k', id % 900) END AS ccn", "id AS v").repartition(6)


def dim(spark, n=1_000):
    return spark.range(n).selectExpr("CASE WHEN id = 0 THEN 'hot' ELSE concat('k', id) END AS ccn", "id AS h") \
        .unionByName(spark.createDataFrame([(None, -1)], "ccn string, h long"))


def rows(df):
    return sorted(map(str, df.collect()))


def test_hot_keys_are_found_and_no_others(spark):
    assert hot_keys(fact(spark), "ccn") == ["hot"]
    assert hot_keys(spark.range(1000).selectExpr("id AS k"), "k") == []
    assert hot_keys(fact(spark).limit(0), "ccn") == []
    with pytest.raises(ValueError):
        hot_keys(fact(spark), "ccn", 1e-5)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_join_is_the_plain_join(spark, how, no_auto_broadcast):
    f, d = fact(spark), dim(spark).unionByName(spark.createDataFrame([("hot", 7), ("k5", 8)], "ccn string, h long"))
    got = split_join(f, d, "ccn", how)
    assert got.columns == ["ccn", "v", "h"] and rows(got) == rows(f.join(d, "ccn", how).select("ccn", "v", "h"))
    for hot in ([], ["hot", "k1", "unknown"]):      # whatever the sketch says
        assert rows(split_join(f, d, "ccn", how, hot=hot)) == rows(got)
    plan = split_join(f, d, "ccn", how)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" in plan


def test_no_task_of_the_shuffle_gets_the_hot_key(spark, no_auto_broadcast):
    f, d = fact(spark), dim(spark)
    cold = f.where("ccn IS NOT NULL AND ccn <> 'hot'").repartition(8, "ccn")
    largest = cold.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest < f.count() / 6
    got = split_join(f, d, "ccn")
    assert got.count() == f.join(d, "ccn").count()


def test_bloom_filter_loses_no_key_and_lets_few_through(spark):
    d = spark.range(5_000).selectExpr("concat('k', id) AS k")
    child = spark.range(20_000).selectExpr("concat('k', id) AS k").unionByName(spark.sql("SELECT string(NULL) AS k"))
    flagged = skew.with_possible(child, "k", bloom_filter(d, "k"))
    counts = {(r.member, r["__possible"]): r["count"] for r in flagged.withColumn(
        "member", F.expr("k IS NOT NULL AND int(substr(k, 2)) < 5000")).groupBy("member", "__possible").count().collect()}
    assert (True, False) not in counts and counts[True, True] == 5_000
    assert counts[False, True] < 0.02 * 15_000
    assert bloom_filter(d, "k", max_bytes=100) is None
    blocks, words = bloom_filter(d.limit(0), "k")
    assert skew.with_possible(child, "k", (blocks, words)).where("__possible").count() == 0


@pytest.mark.parametrize("bits", [16, 1])
def test_pruned_orphans_are_the_orphans(spark, monkeypatch, bits):
    # with one bit a key the filter lets most strangers through
    monkeypatch.setattr(skew, "BLOOM_BITS", bits)
    f, d = fact(spark), dim(spark)
    want = rows(orphans(f, "ccn", d, "ccn"))
    assert rows(pruned_orphans(f, "ccn", d, "ccn")) == want and len(want) > 1_500
    monkeypatch.setattr(skew, "bloom_filter", lambda *a: None)
    assert rows(pruned_orphans(f, "ccn", d, "ccn")) == want


def shuffled(df):
    """Rows written to the shuffles of an executed query."""
    def walk(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        if "QueryStageExec" in name:
            return walk(plan.plan())
        own = plan.metrics().get("shuffleRecordsWritten").get().value() if name == "ShuffleExchangeExec" else 0
        children = plan.children()
        return own + sum(walk(children.apply(i)) for i in range(children.size()))
    df.collect()
    return walk(df._jdf.queryExecution().executedPlan())


def test_pruning_shuffles_fewer_rows(spark, no_auto_broadcast):
    f = spark.range(40_000).selectExpr("CASE WHEN id % 10 = 0 THEN id % 500 ELSE id + 1000000 END AS k", "id AS v")
    d = spark.range(500).selectExpr("id AS k", "id AS h").repartition(3)
    f = f.repartition(4).cache()
    plain, pruned = f.join(d, "k"), pruned_join(f, d, "k")
    assert rows(plain.select("k", "v", "h")) == rows(pruned)
    assert shuffled(plain) > 40_000 and shuffled(pruned_join(f, d, "k")) < 10_000
    orphaned, plainly = pruned_orphans(f, "k", d, "k"), orphans(f, "k", d, "k")
    assert rows(orphaned) == rows(plainly)
    assert shuffled(pruned_orphans(f, "k", d, "k")) < shuffled(orphans(f, "k", d, "k")) / 3
    f.unpersist()


def test_fact_with_large_dimensions_and_a_hot_hospital(spark):
    from wardmart.plans.facts import fct_medicare_drg
    medicare = fact(spark, 6_000).selectExpr("ccn", "concat('d', v % 40) AS drg_code", "v AS total_discharges",
                                             "1.0D * v AS avg_submitted_covered_charge",
                                             "2.0D * v AS avg_total_payment_amount",
                                             "3.0D * v AS avg_medicare_payment_amount")
    hospitals = dim(spark).selectExpr("ccn", "md5(ccn) AS hospital_key").where("ccn IS NOT NULL")
    drgs = spark.range(30).selectExpr("concat('d', id) AS drg_code", "md5(string(id)) AS drg_key")
    assert rows(fct_medicare_drg(medicare, hospitals, drgs, False, False)) \
        == rows(fct_medicare_drg(medicare, hospitals, drgs, True, True)) != []

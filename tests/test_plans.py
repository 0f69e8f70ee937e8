"""Plan properties the scale design relies on (read from executed plans)."""

import re

from pyspark.sql import functions as F

from wardmart.operators import latest_per_key, skew
from wardmart.plans.analog import AnalogRaw, raw_medicare_inpatient, seed_drg_service_line
from wardmart.plans.warehouse import Warehouse
from wardmart.sources import TableSet

SMALL = "/root/testdata/sf0.001"


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns_and_aggregates_before_shuffle(spark):
    t = TableSet(spark, SMALL)
    plan = raw_medicare_inpatient(t)._jdf.queryExecution().executedPlan().toString()
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "lineitem" in ln][0]
    read = re.search(r"ReadSchema: struct<([^>]*)>", scan).group(1)
    cols = {c.split(":")[0] for c in read.split(",")}
    assert cols == {"l_orderkey", "l_partkey", "l_extendedprice", "l_discount", "l_tax"}
    assert "partial_count" in plan and "partial_sum" in plan


def test_flagship_has_no_pairwise_join_and_broadcasts_small_dims(spark):
    t = TableSet(spark, SMALL)
    wh = Warehouse(AnalogRaw(t), seed_drg_service_line(t), cost_tie_break=("Report Record Number",),
                   min_volume=30, persist_dims=True)
    plan = executed(wh.mart_service_line_margin)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
    assert wh._bounds == {"dim_hospital": True, "dim_drg": True, "dim_geography": True}
    gap_plan = executed(wh.mart_reimbursement_gap)
    assert "BroadcastHashJoin" in gap_plan and "SortMergeJoin" not in gap_plan.split("InMemoryRelation")[0]


def test_percentiles_skip_the_ranking_and_lift_has_no_window(spark):
    from wardmart.plans import catalogue
    from wardmart.operators.analysis import null_lift
    plan = executed(catalogue.q_volume_percentiles(catalogue.Ctx(spark, SMALL)))
    assert "rank(" not in plan                      # percentiles come before ranking
    df = spark.createDataFrame([("a", None), ("a", 1.0), ("b", 2.0)], "g string, v double")
    lift = null_lift(df, "v", "g")
    assert "Window" not in executed(lift)
    assert {(r.g, r.share_of_nulls, r.lift) for r in lift.collect()} == {("a", 1.0, 1.5), ("b", 0.0, 0.0)}


def test_over_bound_dimension_is_not_broadcast(spark, monkeypatch):
    t = TableSet(spark, SMALL)

    def joins():
        wh = Warehouse(AnalogRaw(t), seed_drg_service_line(t), cost_tie_break=("Report Record Number",),
                       min_volume=30, max_broadcast_rows=10, persist_dims=True)
        fact = wh.fct_medicare_drg
        assert wh._bounds["dim_hospital"] is False and wh._bounds["dim_drg"] is False
        plan = fact._jdf.queryExecution().optimizedPlan().toString()
        inner = [ln for ln in plan.splitlines() if re.search(r"Join Inner, \((ccn|drg_code)#\d+ = (ccn|drg_code)#", ln)]
        return inner, plan.split("InMemoryRelation")[0]
    # beside the joins of the dimensions stand those of hot keys' rows only;
    # the Bloom filters enter by left joins
    monkeypatch.setattr(skew, "hot_keys", lambda *a: ["000001"])
    inner, plan = joins()
    cold = [ln for ln in inner if "strategy=broadcast" not in ln]
    assert cold and any("strategy=broadcast" in ln for ln in inner)
    # without hot keys and filters nothing is broadcast
    monkeypatch.setattr(skew, "hot_keys", lambda *a: [])
    monkeypatch.setattr(skew, "bloom_filter", lambda *a: None)
    assert "broadcast" not in joins()[1].lower()


def test_top1_per_key_limits_before_the_shuffle(spark):
    df = spark.range(5000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    plan = executed(latest_per_key(df, ["k"], "v"))
    first_exchange = plan.find("Exchange hashpartitioning")
    assert plan.count("WindowGroupLimit") >= 2
    assert plan.rfind("WindowGroupLimit") > first_exchange

"""Invariants of a whole warehouse build over the driver's smallest tables."""

import pytest
from pyspark.sql import functions as F

from wardmart.plans.analog import AnalogRaw, seed_drg_service_line, tables
from wardmart.plans.warehouse import Warehouse

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def wh(spark):
    t = tables(spark, SMALL)
    return Warehouse(AnalogRaw(t), seed_drg_service_line(t), cost_tie_break=("Report Record Number",),
                     min_volume=30)


def test_left_joins_preserve_rows(wh):
    # dim_hospital is the hospital registry enriched by three left joins
    assert wh.dim_hospital.count() == wh.stg_hospital_general_info.count()
    # the burden mart left-joins geography onto the scorecard
    assert wh.mart_burden_vs_community.count() == wh.mart_finance_scorecard.count()


def test_grains_are_unique(wh):
    for model, keys in [("dim_hospital", ["ccn"]), ("stg_cost_report", ["ccn"]),
                        ("fct_medicare_drg", ["hospital_key", "drg_key"]),
                        ("mart_reimbursement_gap", ["hospital_key", "drg_key"]),
                        ("mart_service_line_margin", ["service_line", "metro_name"])]:
        df = wh.model(model)
        assert df.groupBy(*keys).count().where("count > 1").count() == 0, model


def test_ranked_plus_unranked_is_all_and_ranks_are_dense_enough(wh):
    slm = wh.mart_service_line_margin
    total = slm.count()
    ranked = slm.where(F.col("global_rank").isNotNull())
    unranked = slm.where(F.col("global_rank").isNull())
    assert ranked.count() + unranked.count() == total
    assert ranked.where(~F.col("meets_volume_threshold")).count() == 0
    assert unranked.where(F.col("meets_volume_threshold")).count() == 0
    # rank() semantics: the smallest rank is 1 and the largest is at most the ranked count
    r = ranked.agg(F.min("global_rank").alias("lo"), F.max("global_rank").alias("hi")).collect()[0]
    assert r.lo == 1 and r.hi <= ranked.count()


def test_gap_margin_identity_and_exclusions(wh):
    gap = wh.mart_reimbursement_gap
    bad = gap.where(F.abs(F.col("margin") - (F.col("medicare_payment") - F.col("derived_cost"))) > 1e-6)
    assert bad.count() == 0
    assert gap.where(F.col("cost_to_charge_ratio").isNull() | (F.col("cost_to_charge_ratio") < 0)
                     | (F.col("cost_to_charge_ratio") > 1)).count() == 0
    # the fact rows that survive equal the fact rows of hospitals with a usable ratio
    fin = wh.fct_hospital_finance.where("cost_to_charge_ratio is not null and not is_ccr_outlier")
    kept = wh.fct_medicare_drg.join(fin.select("hospital_key"), "hospital_key", "left_semi")
    assert kept.count() == gap.count()


def test_null_metro_is_one_group_per_service_line(wh):
    slm = wh.mart_service_line_margin
    per_line = slm.where(F.col("metro_name").isNull()).groupBy("service_line").count()
    assert per_line.where("count > 1").count() == 0

"""Fact models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import range_flag, surrogate_key
from ..functions.keys import is_md5
from ..operators import bloom_filter, hot_keys, lookup_join, pruned_join, select_keys
from ..operators.skew import with_possible

# The measures the fact carries, in order.
FINANCE_MEASURES = [
    "fiscal_year_begin_date", "fiscal_year_end_date", "number_of_beds", "total_bed_days_available",
    "total_costs", "total_charges", "inpatient_total_charges", "outpatient_total_charges",
    "cost_to_charge_ratio", "charity_care_cost", "bad_debt_expense", "uncompensated_care_cost",
    "total_unreimbursed_uncompensated_care", "net_income", "net_income_from_service_to_patients",
    "total_assets", "total_liabilities", "total_fund_balances", "net_patient_revenue",
]

# The measures of a hospital x DRG row, in order.
MEDICARE_MEASURES = ["total_discharges", "avg_submitted_covered_charge", "avg_total_payment_amount",
                     "avg_medicare_payment_amount"]


def fct_hospital_finance(cost_report: DataFrame, dim_hospital: DataFrame,
                         hospital_small: bool | None = None) -> DataFrame:
    """Latest filing per hospital with its surrogate key and the CCR outlier
    flag (NULL when the ratio is unknown). Filings of hospitals outside the
    dimension drop out (inner join)."""
    keys = select_keys(dim_hospital, "ccn", "hospital_key")
    j = lookup_join(cost_report, keys, "ccn", "inner", hospital_small)
    return j.select("hospital_key", *FINANCE_MEASURES,
                    range_flag("cost_to_charge_ratio", 0.0, 1.0).alias("is_ccr_outlier"))


def star_rows(medicare: DataFrame, hospitals: DataFrame, drgs: DataFrame, hospital_small: bool | None = None,
              drg_small: bool | None = None) -> DataFrame:
    """Medicare rows with the columns of their hospital (by ``ccn``) and DRG
    (by ``drg_code``), shuffled once at most for each.

    A dimension proven small is broadcast, so the rows are not shuffled for
    it. For one proven large, rows without a match are dropped by a Bloom
    filter and rows of hot keys joined by broadcast before the rest is
    shuffled. Hot keys are looked for in the unjoined rows. The second
    shuffle carries the hospital's key as bytes.
    """
    j = medicare
    pack = drg_small is False and "hospital_key" in hospitals.columns
    if pack:
        hospitals = packed_key(hospitals, "hospital_key")
    for dim, on, small in ((hospitals, "ccn", hospital_small), (drgs, "drg_code", drg_small)):
        j = pruned_join(j, dim, on, hot_keys(medicare, on)) if small is False else \
            lookup_join(j, dim, on, "inner", small)
    return unpacked_key(j, "hospital_key") if pack else j


def packed_key(df: DataFrame, key: str) -> DataFrame:
    """``df`` with the MD5 text ``key`` as 16 bytes; other texts stay text."""
    md5 = is_md5(key)
    return df.withColumns({"__bytes": F.when(md5, F.unhex(key)), "__text": F.when(~md5, F.col(key))}).drop(key)


def unpacked_key(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(key, F.coalesce(F.lower(F.hex("__bytes")), F.col("__text"))).drop("__bytes", "__text")


def fct_medicare_drg(medicare: DataFrame, dim_hospital: DataFrame, dim_drg: DataFrame,
                     hospital_small: bool | None = None,
                     drg_small: bool | None = None, drg_columns=()) -> DataFrame:
    """Hospital x DRG measures carrying surrogate keys only.

    The dimensions enter as key-only projections; see ``star_rows``.
    ``drg_columns`` names attributes of the DRG to carry along.
    """
    h = select_keys(dim_hospital, "ccn", "hospital_key")
    d = select_keys(dim_drg, "drg_code", "drg_key", *drg_columns)
    return star_rows(medicare, h, d, hospital_small, drg_small).select(
        "hospital_key", "drg_key", *MEDICARE_MEASURES, *drg_columns)


def own_keys(dim: DataFrame, code: str, key: str) -> bool:
    """Whether every ``key`` of a dimension is the surrogate key of its ``code``."""
    return dim.where(~F.col(key).eqNullSafe(surrogate_key(code))).agg(F.count(F.lit(1)).alias("n")).first().n == 0


def fct_medicare_drg_dealt(medicare: DataFrame, dim_hospital: DataFrame, dim_drg: DataFrame, buckets: int,
                           drg_small: bool | None = None) -> DataFrame:
    """``fct_medicare_drg`` for a large hospital dimension, its rows in
    ``buckets`` on their hospital key.

    The keys of both dimensions are the ``surrogate_key`` of their natural
    ones (``own_keys``). So rows with a possible hospital go to their DRGs, and
    then by the key of their CCN to the buckets, where they meet the hospital
    itself: two shuffles of natural keys and measures instead of three that
    end with both surrogate keys.
    """
    rows = medicare.select("ccn", "drg_code", *MEDICARE_MEASURES).where(F.col("ccn").isNotNull())
    bloom = bloom_filter(dim_hospital, "ccn")
    if bloom is not None:
        rows = with_possible(rows, "ccn", bloom).where("__possible").drop("__possible")
    drgs = dim_drg.select("drg_code", F.col("drg_code").alias("__code"))
    rows = pruned_join(rows, drgs, "drg_code", hot_keys(medicare, "drg_code")) if drg_small is False else \
        lookup_join(rows, drgs, "drg_code", "inner", drg_small)
    key = surrogate_key("ccn")
    dealt = rows.select("ccn", "__code", *MEDICARE_MEASURES).repartition(buckets, key) \
        .select(key.alias("hospital_key"), surrogate_key("__code").alias("drg_key"), *MEDICARE_MEASURES)
    # a bucket's few keys are hashed, so its rows stay in the order of their DRGs and the table packs well
    hospitals = dim_hospital.where(F.col("ccn").isNotNull()).select("hospital_key").hint("shuffle_hash")
    return dealt.join(hospitals, "hospital_key")

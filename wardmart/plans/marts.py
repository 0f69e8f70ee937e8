"""Business marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dealt_packed, guarded_ratio
from ..functions.keys import key_bytes, key_text
from ..operators import (DEFAULT_BROADCAST_ROWS, derive_margin, has_at_most, left_join_nullsafe_split, lookup_join,
                         rank_groups, rollup_groups, select_keys, usable_ratio)
from .facts import MEDICARE_MEASURES, packed_key, star_rows, unpacked_key


def _geo_left(df: DataFrame, geo: DataFrame, take: list[str], geo_small: bool | None) -> DataFrame:
    """Left-join CBSA attributes on ``cbsa_code``. A proven-small geography
    is broadcast; otherwise hospitals without a CBSA (NULL key, never a
    match) bypass the shuffle instead of piling into one task."""
    if geo_small:
        g = geo.select(F.col("cbsa_code").alias("__cbsa"), *take)
        return lookup_join(df, g, F.col("cbsa_code") == F.col("__cbsa"), "left", True) \
            .drop("__cbsa")
    return left_join_nullsafe_split(df, geo, "cbsa_code", "cbsa_code", take)


# The mart's columns in order.
GAP_COLUMNS = [
    "hospital_key", "drg_key", "hospital_name", "cbsa_code", "metro_name", "drg_code",
    "drg_description", "service_line", "total_discharges", "charges", "medicare_payment",
    "cost_to_charge_ratio", "derived_cost", "margin",
]

# The fact's measures that the mart reads.
GAP_FACT = ["total_discharges", "avg_submitted_covered_charge", "avg_medicare_payment_amount"]

# The columns that roll-ups by line and metro read.
GAP_MEASURES = ["service_line", "metro_name", "total_discharges", "medicare_payment", "derived_cost", "margin"]


def mart_reimbursement_gap(drg_fact: DataFrame, finance: DataFrame, dim_hospital: DataFrame,
                           dim_drg: DataFrame, dim_geography: DataFrame,
                           hospital_small: bool | None = None, drg_small: bool | None = None,
                           geo_small: bool | None = None) -> DataFrame:
    """Hospital x DRG margin: payment minus charges x the hospital's CCR.

    Hospitals without a usable CCR (unknown, or flagged outside [0, 1])
    drop out. The hospital-grain inputs (usable finance row, hospital name
    and CBSA, metro name) are combined first -- all unique per hospital --
    so the fact is joined once per key (hospital, then DRG) instead of once
    per input table. Inner joins commute and the metro lookup depends only
    on the hospital row, so the result equals the star join as written.
    """
    per_hospital = usable_hospitals(finance, dim_hospital, dim_geography, hospital_small, geo_small)
    drg = dim_drg.select(F.col("drg_key").alias("__dk"), "drg_code", "drg_description",
                         "service_line")
    # per_hospital has at most one row per dimension hospital: the hospital
    # dimension's bound carries over
    j = lookup_join(drg_fact, per_hospital, "hospital_key", "inner", hospital_small)
    return _gap_rows(lookup_join(j, drg, F.col("drg_key") == F.col("__dk"), "inner", drg_small))


def mart_reimbursement_gap_dealt(drg_fact: DataFrame, per_hospital: DataFrame, dim_drg: DataFrame, buckets: int,
                                 hospital_small: bool | None = None) -> DataFrame:
    """``mart_reimbursement_gap`` of a fact in ``buckets`` on its hospital
    key, for a large DRG dimension; the mart's rows are in the same buckets.

    Rows of unusable hospitals leave first, within their buckets. The rest
    is shuffled with its keys, as bytes, and measures to the DRGs and back to the
    buckets, and only there gets the columns of its hospital
    (``usable_hospitals``).
    """
    fact = drg_fact.select("hospital_key", "drg_key", *GAP_FACT)
    fact = lookup_join(fact, per_hospital.select("hospital_key"), "hospital_key", "left_semi", hospital_small)
    drg = dim_drg.select(key_bytes("drg_key").alias("__drg"), "drg_code", "drg_description", "service_line")
    j = packed_key(fact, "hospital_key").withColumn("__drg", key_bytes("drg_key")).drop("drg_key").join(drg, "__drg")
    j = dealt_packed(unpacked_key(j, "hospital_key").withColumn("drg_key", key_text("__drg")).drop("__drg"),
                     buckets, "hospital_key", ["hospital_key", "drg_key"])
    return _gap_rows(lookup_join(j, per_hospital, "hospital_key", "inner", hospital_small))


def _gap_rows(j: DataFrame, columns: list[str] = GAP_COLUMNS) -> DataFrame:
    j = j.select("*", F.col("avg_submitted_covered_charge").alias("charges"),
                 F.col("avg_medicare_payment_amount").alias("medicare_payment"))
    return derive_margin(j, "charges", "medicare_payment", "cost_to_charge_ratio").select(columns)


def usable_hospitals(finance: DataFrame, dim_hospital: DataFrame, dim_geography: DataFrame,
                     hospital_small: bool | None = None, geo_small: bool | None = None) -> DataFrame:
    """Hospitals of a usable CCR with their name, CBSA and metro."""
    fin = usable_ratio(finance, "cost_to_charge_ratio", "is_ccr_outlier") \
        .select("hospital_key", "cost_to_charge_ratio")
    hosp = dim_hospital.select(F.col("hospital_key").alias("__hk"), "hospital_name", "cbsa_code")
    per_hospital = lookup_join(fin, hosp, F.col("hospital_key") == F.col("__hk"), "inner",
                               hospital_small).drop("__hk")
    return _geo_left(per_hospital, dim_geography, ["metro_name"], geo_small)


def gap_hospitals(per_hospital: DataFrame, dim_hospital: DataFrame, hospital_small: bool | None = None) -> DataFrame:
    """``usable_hospitals`` under the natural key of the dimension."""
    keys = dim_hospital.select("ccn", F.col("hospital_key").alias("__hk"))
    return lookup_join(per_hospital, keys, F.col("hospital_key") == F.col("__hk"), "inner", hospital_small).drop("__hk")


def gap_drgs(dim_drg: DataFrame, drg_small: bool | None = None) -> DataFrame:
    """DRG attributes of the mart under the natural key of the dimension."""
    drg = dim_drg.select(F.col("drg_key").alias("__dk"), F.col("drg_code").alias("__code"), "drg_description",
                         "service_line")
    return lookup_join(select_keys(dim_drg, "drg_code", "drg_key"), drg, F.col("drg_key") == F.col("__dk"), "inner",
                       drg_small).drop("__dk")


def mart_reimbursement_gap_star(medicare: DataFrame, hospitals: DataFrame, drgs: DataFrame,
                                hospital_small: bool | None = None, drg_small: bool | None = None) -> DataFrame:
    """``mart_reimbursement_gap`` of a fact that is not written.

    The fact is its lookups of the two surrogate keys, and the mart joins on
    these keys again. Inner joins associate, so here the dimensions' sides
    (``gap_hospitals``, ``gap_drgs``) are joined first, and the medicare rows
    once with each: two shuffles of rows instead of four when both are large,
    and rows of unusable hospitals leave before the first.
    """
    rows = medicare.select("ccn", "drg_code", *MEDICARE_MEASURES)
    return _gap_rows(star_rows(rows, hospitals, drgs, hospital_small, drg_small)
                     .drop("drg_code").withColumnRenamed("__code", "drg_code"))


def measure_sides(hospitals: DataFrame, drgs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The columns of the star's sides that ``GAP_MEASURES`` need."""
    return hospitals.select("ccn", "metro_name", "cost_to_charge_ratio"), select_keys(drgs, "drg_code", "service_line")


def gap_measures_star(medicare: DataFrame, hospitals: DataFrame, drgs: DataFrame, hospital_small: bool | None = None,
                      drg_small: bool | None = None) -> DataFrame:
    """``GAP_MEASURES`` of ``mart_reimbursement_gap_star``, from ``measure_sides``."""
    rows = medicare.select("ccn", "drg_code", *MEDICARE_MEASURES)
    return _gap_rows(star_rows(rows, hospitals, drgs, hospital_small, drg_small), GAP_MEASURES)


def sides_of_groups(hospitals: DataFrame, drgs: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sides of the star that rows of the few ``groups`` can come from:
    hospitals of their metros (NULL is one) and DRGs of their lines."""
    metros = groups.select(F.col("metro_name").alias("__mn")).distinct()
    lines = groups.select(F.col("service_line").alias("__sl")).distinct()
    return (hospitals.join(metros, F.col("metro_name").eqNullSafe(F.col("__mn")), "left_semi"),
            drgs.join(lines, F.col("service_line") == F.col("__sl"), "left_semi"))


def rows_of_groups(gap: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of the mart whose line and metro are among ``groups``."""
    wanted = groups.select(F.col("service_line").alias("__sl"), F.col("metro_name").alias("__mn"))
    if has_at_most(wanted, DEFAULT_BROADCAST_ROWS):
        wanted = F.broadcast(wanted)
    return gap.join(wanted, (F.col("service_line") == F.col("__sl")) &
                    F.col("metro_name").eqNullSafe(F.col("__mn")), "left_semi")


def service_line_groups(gap: DataFrame) -> DataFrame:
    """service_line x metro averages, totals and volumes; NULL metro is a group."""
    return rollup_groups(
        gap, ["service_line", "metro_name"], "margin",
        {"total_medicare_payment": "medicare_payment", "total_derived_cost": "derived_cost"},
        "total_discharges", "total_discharge_volume", "avg_margin")


def mart_service_line_margin(groups: DataFrame, min_volume: float = 30, form: str = "union") -> DataFrame:
    """The service-line groups with global and per-metro margin ranks for
    those of at least ``min_volume`` discharges."""
    return rank_groups(groups, ["service_line", "metro_name"], "total_discharge_volume", min_volume,
                       "avg_margin", "service_line_margin_key", "metro_name", form)


def mart_finance_scorecard(finance: DataFrame, dim_hospital: DataFrame, dim_geography: DataFrame,
                           hospital_small: bool | None = None,
                           geo_small: bool | None = None) -> DataFrame:
    """Per hospital: revenue, burden costs and burden as a share of net
    patient revenue (NULL when revenue is not positive)."""
    h = dim_hospital.select(F.col("hospital_key").alias("__hk"), "hospital_name", "cbsa_code",
                            "hospital_ownership")
    j = lookup_join(finance, h, F.col("hospital_key") == F.col("__hk"), "inner", hospital_small)
    j = _geo_left(j, dim_geography, ["metro_name"], geo_small)
    return j.select(
        "hospital_key", "hospital_name", "cbsa_code", "metro_name", "hospital_ownership",
        "net_patient_revenue", "charity_care_cost", "uncompensated_care_cost", "net_income",
        guarded_ratio("charity_care_cost", "net_patient_revenue").alias("charity_pct_of_revenue"),
        guarded_ratio("uncompensated_care_cost", "net_patient_revenue")
        .alias("uncompensated_pct_of_revenue"))


def mart_burden_vs_community(scorecard: DataFrame, dim_geography: DataFrame,
                             geo_small: bool | None = None) -> DataFrame:
    """Scorecard rows with their community's income and uninsured rate;
    hospitals outside any CBSA are kept with NULL community columns."""
    j = _geo_left(scorecard, dim_geography, ["median_household_income", "uninsured_rate"],
                  geo_small)
    return j.select("hospital_key", "hospital_name", "metro_name", "hospital_ownership",
                    "net_patient_revenue", "charity_pct_of_revenue", "uncompensated_pct_of_revenue",
                    "median_household_income", "uninsured_rate")

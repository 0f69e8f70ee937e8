"""Dimension models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar_columns, date_key, known_and_different, surrogate_key
from ..functions.text import col_of
from ..operators import dominant_match, lookup_join

# The dimension's columns in order.
DIM_HOSPITAL_COLUMNS = [
    "hospital_key", "ccn", "hospital_name", "address", "city", "state", "zip_code", "county",
    "phone_number", "hospital_ownership", "emergency_services", "birthing_friendly_designation",
    "hospital_overall_rating", "cbsa_code", "ownership_type", "rural_urban", "provider_type",
    "medicare_payment_cbsa", "ruca_code", "ruca_description", "is_cbsa_reclassified",
]


def dim_hospital(hospitals: DataFrame, cost_report: DataFrame, crosswalk: DataFrame,
                 medicare: DataFrame, crosswalk_tie_break: bool = True) -> DataFrame:
    """One row per hospital: identity from hospital info, dominant CBSA of
    its ZIP, cost-report attributes, RUCA rurality, reclassification flag.

    Every enrichment side is unique on its join key (top-1 per ZIP, latest
    filing per CCN, distinct RUCA per CCN), so left joins keep the row count.
    All sides are hospital-grain; Spark picks the join strategy from their
    sizes (AQE converts to broadcast at runtime when a side is small).
    """
    h = hospitals.select(
        col_of("facility_id").alias("ccn"), col_of("facility_name").alias("hospital_name"),
        "address", "city", "state", "zip_code", "county", "phone_number", "hospital_ownership",
        "emergency_services", "birthing_friendly_designation", "hospital_overall_rating")
    bridge = crosswalk.select(col_of("zip_code").alias("__zip"), "cbsa_code", "res_ratio")
    ties = [F.col("cbsa_code").asc_nulls_last()] if crosswalk_tie_break else []
    with_cbsa = dominant_match(h, bridge, "zip_code", "__zip", "res_ratio", ["cbsa_code"], ties)
    cr = cost_report.select(col_of("ccn").alias("__cr_ccn"), "ownership_type", "rural_urban",
                            "provider_type", "medicare_payment_cbsa")
    ruca = medicare.select(col_of("ccn").alias("__ru_ccn"), "ruca_code", "ruca_description") \
        .distinct()
    j = lookup_join(with_cbsa, cr, F.col("ccn") == F.col("__cr_ccn"), "left")
    j = lookup_join(j, ruca, F.col("ccn") == F.col("__ru_ccn"), "left")
    return j.select(
        surrogate_key("ccn").alias("hospital_key"),
        *[c for c in DIM_HOSPITAL_COLUMNS[1:-1]],
        known_and_different("medicare_payment_cbsa", "cbsa_code").alias("is_cbsa_reclassified"))


def dim_drg(seed: DataFrame) -> DataFrame:
    """DRG to service-line lookup with a surrogate key."""
    return seed.select(surrogate_key("drg_cd").alias("drg_key"), col_of("drg_cd").alias("drg_code"),
                       col_of("drg_desc").alias("drg_description"), "service_line")


def dim_geography(census: DataFrame) -> DataFrame:
    """One row per CBSA with community measures."""
    return census.select(surrogate_key("cbsa_code").alias("geography_key"), "cbsa_code",
                         col_of("name").alias("metro_name"), "median_household_income",
                         "total_population", "median_age", "insurance_universe",
                         "uninsured_count", "uninsured_rate")


def dim_date(spine: DataFrame, day_col: str = "date_day") -> DataFrame:
    """Calendar attributes per day, keyed by the YYYYMMDD integer."""
    return spine.select(date_key(day_col).alias("date_key"), *calendar_columns(day_col))

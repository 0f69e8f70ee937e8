"""Staging models: rename, type and filter the five raw sources (M2, M4, M7-M9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parse_date, sentinel_to_null, squash_upper, sum_parts
from ..functions.text import col_of
from ..operators import latest_per_key, rename_project

# Raw column names of the five public sources and the sentinel
# texts the models test for.
ACUTE = "Acute Care Hospitals"
RATING_MISSING = "Not Available"
NON_METRO_CBSA = "99999"
UNINSURED_PARTS = ["B27010_017E", "B27010_033E", "B27010_050E", "B27010_066E"]
UNIVERSE = "B27010_001E"
CBSA_COLUMN = "metropolitan statistical area/micropolitan statistical area"

# Fixed values: (source column, model column) pairs in order.
COST_REPORT_COLUMNS = [
    ("Provider CCN", "ccn"),
    ("Medicare CBSA Number", "medicare_payment_cbsa"),
    ("Rural Versus Urban", "rural_urban"),
    ("Provider Type", "provider_type"),
    ("Type of Control", "ownership_type"),
    ("Fiscal Year Begin Date", "fiscal_year_begin_date"),
    ("Fiscal Year End Date", "fiscal_year_end_date"),
    ("Number of Beds", "number_of_beds"),
    ("Total Bed Days Available", "total_bed_days_available"),
    ("Cost of Charity Care", "charity_care_cost"),
    ("Total Bad Debt Expense", "bad_debt_expense"),
    ("Cost of Uncompensated Care", "uncompensated_care_cost"),
    ("Total Unreimbursed and Uncompensated Care", "total_unreimbursed_uncompensated_care"),
    ("Total Costs", "total_costs"),
    ("Inpatient Total Charges", "inpatient_total_charges"),
    ("Outpatient Total Charges", "outpatient_total_charges"),
    ("Combined Outpatient + Inpatient Total Charges", "total_charges"),
    ("Total Assets", "total_assets"),
    ("Total Liabilities", "total_liabilities"),
    ("Total Fund Balances", "total_fund_balances"),
    ("Disproportionate Share Adjustment", "dsh_adjustment"),
    ("Allowable DSH Percentage", "allowable_dsh_percentage"),
    ("Cost To Charge Ratio", "cost_to_charge_ratio"),
    ("Net Income", "net_income"),
    ("Net Income from Service to Patients", "net_income_from_service_to_patients"),
    ("Net Patient Revenue", "net_patient_revenue"),
]

# Fixed values: (source column, model column) pairs in order.
HOSPITAL_COLUMNS = [
    ("Facility ID", "facility_id"),
    ("Facility Name", "facility_name"),
    ("Address", "address"),
    ("City/Town", "city"),
    ("State", "state"),
    ("ZIP Code", "zip_code"),
    ("County/Parish", "county"),
    ("Telephone Number", "phone_number"),
    ("Hospital Ownership", "hospital_ownership"),
    ("Emergency Services", "emergency_services"),
    ("Meets criteria for birthing friendly designation", "birthing_friendly_designation"),
    ("Hospital overall rating", "hospital_overall_rating"),
]

# Fixed values: (source column, model column) pairs in order.
MEDICARE_COLUMNS = [
    ("Rndrng_Prvdr_CCN", "ccn"),
    ("Rndrng_Prvdr_RUCA", "ruca_code"),
    ("Rndrng_Prvdr_RUCA_Desc", "ruca_description"),
    ("DRG_Cd", "drg_code"),
    ("DRG_Desc", "drg_description"),
    ("Tot_Dschrgs", "total_discharges"),
    ("Avg_Submtd_Cvrd_Chrg", "avg_submitted_covered_charge"),
    ("Avg_Tot_Pymt_Amt", "avg_total_payment_amount"),
    ("Avg_Mdcr_Pymt_Amt", "avg_medicare_payment_amount"),
]


def stg_hospital_general_info(raw: DataFrame) -> DataFrame:
    """Acute-care hospitals; county squashed; rating sentinel to NULL, int."""
    acute = raw.where(col_of("Hospital Type") == F.lit(ACUTE))
    cleaners = {"county": squash_upper,
                "hospital_overall_rating": lambda c: sentinel_to_null(c, RATING_MISSING, "int")}
    return rename_project(acute, HOSPITAL_COLUMNS).select(
        [cleaners[c](col_of(c)).alias(c) if c in cleaners else col_of(c)
         for _, c in HOSPITAL_COLUMNS])


def stg_cost_report(raw: DataFrame, tie_break: tuple[str, ...] = (),
                    nulls_win: bool = True) -> DataFrame:
    """Latest filing per CCN (fiscal year end, descending, unknown first),
    dates parsed from M/D/YYYY text, identity fields left out.

    ``tie_break`` names raw columns (e.g. a report record number, highest
    wins) that decide between filings with the same year end; without one
    the pick among such filings is arbitrary.
    """
    pairs = COST_REPORT_COLUMNS + [(c, f"__tie{i}") for i, c in enumerate(tie_break)]
    renamed = rename_project(raw, pairs).withColumns({
        "fiscal_year_begin_date": parse_date("fiscal_year_begin_date"),
        "fiscal_year_end_date": parse_date("fiscal_year_end_date"),
    })
    ties = [F.col(f"__tie{i}").desc_nulls_last() for i in range(len(tie_break))]
    names = [dst for _, dst in COST_REPORT_COLUMNS]
    return latest_per_key(renamed, ["ccn"], "fiscal_year_end_date", ties, nulls_win).select(names)


def stg_census_acs(raw: DataFrame) -> DataFrame:
    """One row per CBSA with a usable insurance universe; uninsured rate."""
    universe = col_of(UNIVERSE)
    usable = raw.where(universe.isNotNull() & (universe > 0))
    out = usable.select(
        col_of("NAME").alias("name"),
        col_of(CBSA_COLUMN).alias("cbsa_code"),
        col_of("B19013_001E").alias("median_household_income"),
        col_of("B01003_001E").alias("total_population"),
        col_of("B01002_001E").alias("median_age"),
        universe.alias("insurance_universe"),
        sum_parts(*UNINSURED_PARTS).alias("uninsured_count"))
    return out.withColumn("uninsured_rate",
                          F.col("uninsured_count").cast("double") / F.col("insurance_universe").cast("double"))


def stg_zip_cbsa_crosswalk(raw: DataFrame) -> DataFrame:
    """ZIP to CBSA bridge without the non-metro sentinel (drops NULL too)."""
    return raw.where(col_of("cbsa") != F.lit(NON_METRO_CBSA)).select(
        col_of("geoid").alias("zip_code"), col_of("cbsa").alias("cbsa_code"),
        col_of("res_ratio"))


def stg_medicare_inpatient(raw: DataFrame) -> DataFrame:
    """Hospital x DRG rows with at least one discharge."""
    return rename_project(raw.where(col_of("Tot_Dschrgs") > 0), MEDICARE_COLUMNS)

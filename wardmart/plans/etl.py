"""The script-built ETL forms.

These run beside the staging models and differ from them on purpose
(dynamic projection, 42 renamed columns with dates kept as text, the
sentinel-excluding top-1 geo match carrying its ratio, the census rate
without a denominator filter).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pad_id, parse_date, ratio, squash_upper, sum_parts
from ..functions.text import col_of
from ..operators import clean_in_place, dominant_match, latest_per_key, rename_project
from .staging import ACUTE, CBSA_COLUMN, NON_METRO_CBSA, UNINSURED_PARTS, UNIVERSE

# Per raw table, the id columns the loaders strip and zero-pad
# (width 6 for CCNs, 5 for the crosswalk ZIP).
PAD_RULES = {
    "medicare_inpatient": {"Rndrng_Prvdr_CCN": 6},
    "cost_report": {"Provider CCN": 6},
    "hospital_general_info": {"Facility ID": 6},
    "census_acs": {},
    "zip_cbsa_crosswalk": {"geoid": 5},
}

# Fixed values: (source column, clean name) pairs of the ETL cost-report dedup.
DEDUP_COLUMNS = [
    ("Provider CCN", "ccn"),
    ("Hospital Name", "hospital_name"),
    ("Street Address", "street_address"),
    ("City", "city"),
    ("State Code", "state"),
    ("Zip Code", "zip_code"),
    ("County", "county"),
    ("Medicare CBSA Number", "medicare_cbsa"),
    ("Rural Versus Urban", "rural_urban"),
    ("CCN Facility Type", "ccn_facility_type"),
    ("Provider Type", "provider_type"),
    ("Type of Control", "ownership_type"),
    ("Fiscal Year Begin Date", "fiscal_year_begin_date"),
    ("Fiscal Year End Date", "fiscal_year_end_date"),
    ("FTE - Employees on Payroll", "fte_employees"),
    ("Number of Interns and Residents (FTE)", "interns_residents_fte"),
    ("Number of Beds", "number_of_beds"),
    ("Total Bed Days Available", "total_bed_days_available"),
    ("Cost of Charity Care", "charity_care_cost"),
    ("Total Bad Debt Expense", "bad_debt_expense"),
    ("Cost of Uncompensated Care", "uncompensated_care_cost"),
    ("Total Unreimbursed and Uncompensated Care", "total_unreimbursed_uncompensated_care"),
    ("Total Salaries From Worksheet A", "total_salaries"),
    ("Overhead Non-Salary Costs", "overhead_non_salary_costs"),
    ("Depreciation Cost", "depreciation_cost"),
    ("Total Costs", "total_costs"),
    ("Inpatient Total Charges", "inpatient_total_charges"),
    ("Outpatient Total Charges", "outpatient_total_charges"),
    ("Combined Outpatient + Inpatient Total Charges", "total_charges"),
    ("Cash on Hand and in Banks", "cash_on_hand"),
    ("Total Current Assets", "total_current_assets"),
    ("Total Assets", "total_assets"),
    ("Total Current Liabilities", "total_current_liabilities"),
    ("Total Long Term Liabilities", "total_long_term_liabilities"),
    ("Total Liabilities", "total_liabilities"),
    ("Total Fund Balances", "total_fund_balances"),
    ("Total Liabilities and Fund Balances", "total_liabilities_and_fund_balances"),
    ("DRG Amounts Other Than Outlier Payments", "drg_payments"),
    ("Outlier Payments For Discharges", "outlier_payments"),
    ("Disproportionate Share Adjustment", "dsh_adjustment"),
    ("Allowable DSH Percentage", "allowable_dsh_percentage"),
    ("Managed Care Simulated Payments", "managed_care_simulated_payments"),
]

# Raw hospital columns carried into the ETL geo table.
GEO_COLUMNS = [
    ("Facility ID", "ccn"),
    ("Facility Name", "hospital_name"),
    ("Address", "address"),
    ("City/Town", "city"),
    ("State", "state"),
    ("ZIP Code", "zip_code"),
    ("County/Parish", "county"),
    ("Telephone Number", "telephone_number"),
    ("Hospital Type", "hospital_type"),
    ("Hospital Ownership", "hospital_ownership"),
    ("Emergency Services", "emergency_services"),
    ("Meets criteria for birthing friendly designation", "birthing_friendly_designation"),
    ("Hospital overall rating", "hospital_overall_rating"),
]


def apply_load_rules(table: str, df: DataFrame) -> DataFrame:
    """The loader's id clean-up for one raw table: strip and zero-pad the
    listed id columns (never truncating), all other columns untouched."""
    rules = PAD_RULES.get(table, {})
    return clean_in_place(df, {c: (lambda w: lambda col: pad_id(col, w))(w)
                               for c, w in rules.items()})


def clean_hospital_info(raw: DataFrame, county_col: str = "County/Parish") -> DataFrame:
    """All raw columns as they are, county squashed in place, acute only."""
    acute = raw.where(col_of("Hospital Type") == F.lit(ACUTE))
    return clean_in_place(acute, {county_col: squash_upper})


def dedup_cost_report(raw: DataFrame, tie_break: tuple[str, ...] = (),
                      nulls_win: bool = True) -> DataFrame:
    """Latest filing per CCN by the parsed year-end text; 42 renamed columns,
    dates kept as text."""
    pairs = DEDUP_COLUMNS + [(c, f"__tie{i}") for i, c in enumerate(tie_break)]
    proj = rename_project(raw, pairs).withColumn(
        "__year_end", parse_date("fiscal_year_end_date"))
    ties = [F.col(f"__tie{i}").desc_nulls_last() for i in range(len(tie_break))]
    return latest_per_key(proj, ["ccn"], "__year_end", ties, nulls_win) \
        .select([dst for _, dst in DEDUP_COLUMNS])


def build_hospital_geo(hospitals_clean: DataFrame, crosswalk_raw: DataFrame,
                       tie_break=("cbsa",)) -> DataFrame:
    """Each hospital with the crosswalk row of largest ratio for its ZIP,
    non-metro sentinel excluded first; unmatched hospitals kept with NULLs."""
    base = rename_project(hospitals_clean, GEO_COLUMNS)
    bridge = crosswalk_raw.select(col_of("geoid").alias("__zip"),
                                  col_of("cbsa").alias("cbsa_code"), col_of("res_ratio"))
    ties = [F.col("cbsa_code").asc_nulls_last()] if tie_break else []
    return dominant_match(base, bridge, "zip_code", "__zip", "res_ratio",
                          ["cbsa_code", "res_ratio"], ties,
                          exclude=F.col("cbsa_code") != F.lit(NON_METRO_CBSA))


def build_census_uninsured(raw: DataFrame) -> DataFrame:
    """Uninsured count and rate per CBSA, no denominator filter: a zero
    universe raises, as the warehouse's numeric division does."""
    parts = sum_parts(*UNINSURED_PARTS)
    return raw.select(col_of("NAME").alias("name"), col_of(CBSA_COLUMN).alias("cbsa_code"),
                      col_of(UNIVERSE).alias("universe"), parts.alias("uninsured_count"),
                      ratio(parts, UNIVERSE).alias("uninsured_rate"))

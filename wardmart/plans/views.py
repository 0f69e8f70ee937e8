"""The staging models as persistent views over the published raw tables.

The same rules as ``staging``, worded in SQL: a catalog keeps views as text.
Names in braces stand for the tables of the publication.
"""

from __future__ import annotations

from ..functions.text import quote
from ..functions.values import US_DATE
from . import staging as S

RAW = ["hospital_general_info", "cost_report", "census_acs", "zip_cbsa_crosswalk", "medicare_inpatient"]
DATES = ("fiscal_year_begin_date", "fiscal_year_end_date")


def raw_name(table: str) -> str:
    """Name under which a raw table is published."""
    return f"raw_{table}"


def _picked(pairs: list[tuple[str, str]], special: dict[str, str]) -> str:
    return ", ".join(f"{special.get(dst, '{}').replace('{}', quote(src))} AS {dst}" for src, dst in pairs)


def staging_views(tie_break: tuple[str, ...] = (), nulls_win: bool = True) -> dict[str, str]:
    """View name -> SQL of the five staging models."""
    year_end = f"to_date({quote('Fiscal Year End Date')}, '{US_DATE}')"
    order = ", ".join([f"{year_end} DESC NULLS {'FIRST' if nulls_win else 'LAST'}",
                       *[f"{quote(c)} DESC NULLS LAST" for c in tie_break]])
    uninsured = " + ".join(S.UNINSURED_PARTS)
    names = ", ".join(dst for _, dst in S.COST_REPORT_COLUMNS)
    return {
        "stg_hospital_general_info":
            f"SELECT " + _picked(S.HOSPITAL_COLUMNS, {
                "county": "upper(replace(trim({}), ' ', ''))",
                "hospital_overall_rating": f"CAST(nullif({{}}, '{S.RATING_MISSING}') AS INT)"})
            + f" FROM {{raw_hospital_general_info}} WHERE `Hospital Type` = '{S.ACUTE}'",
        "stg_cost_report":
            f"SELECT {names} FROM (SELECT "
            + _picked(S.COST_REPORT_COLUMNS, {d: f"to_date({{}}, '{US_DATE}')" for d in DATES})
            + f", row_number() OVER (PARTITION BY `Provider CCN` ORDER BY {order}) AS nth"
            + " FROM {raw_cost_report}) WHERE nth = 1",
        "stg_census_acs":
            f"SELECT *, CAST(uninsured_count AS DOUBLE) / CAST(insurance_universe AS DOUBLE) AS uninsured_rate"
            f" FROM (SELECT NAME AS name, {quote(S.CBSA_COLUMN)} AS cbsa_code, B19013_001E AS median_household_income,"
            f" B01003_001E AS total_population, B01002_001E AS median_age, {S.UNIVERSE} AS insurance_universe,"
            f" {uninsured} AS uninsured_count FROM {{raw_census_acs}} WHERE {S.UNIVERSE} > 0)",
        "stg_zip_cbsa_crosswalk":
            f"SELECT geoid AS zip_code, cbsa AS cbsa_code, res_ratio FROM {{raw_zip_cbsa_crosswalk}}"
            f" WHERE cbsa <> '{S.NON_METRO_CBSA}'",
        "stg_medicare_inpatient":
            "SELECT " + _picked(S.MEDICARE_COLUMNS, {}) + " FROM {raw_medicare_inpatient} WHERE Tot_Dschrgs > 0",
    }

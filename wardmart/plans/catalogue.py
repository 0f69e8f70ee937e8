"""Query catalogue over the driver's tables: one Spark query per operator
or model, each with its DuckDB oracle SQL.

Every query builds the warehouse from the stand-in raw tables (see
``analog``) and runs the library's operators over whole tables. Double
sums of the marts are exact on both sides and compared bit by bit; shares
and rates are rounded in the query, in Spark and in the SQL alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pad_id, parse_date, sentinel_to_null, squash_upper, stable_round, surrogate_key
from ..functions.text import col_of
from ..operators import analysis as A
from ..operators import (exact_percentiles, exact_sums, global_rank, keyed_join, lookup_join, pruned_orphans,
                         quality as Q)
from ..operators.cache import release_all, settled
from ..operators import sketches as K
from ..operators.moments import correlation, merge_moments, moment_states
from ..session import warehouse_root
from ..sources import audit_counts, date_spine_between, materialize, new_run_id, snapshot
from . import etl, oracle
from .analog import AnalogRaw, seed_drg_service_line, tables
from .dims import dim_date
from .load import load_raw_csv
from .marts import mart_service_line_margin
from .partitioned import rows_of, write_by_line
from .oracle import compose, exact_double, pad, r6, scaled_sum, sk, usdate
from .build import build_all
from .suite import report_sql
from .warehouse import Warehouse

def brand_lines(n: int = 25) -> list[str]:
    """Service lines of the analog: part brands Brand#1 .. Brand#n."""
    return [f"Brand#{i}" for i in range(1, n + 1)]


class Ctx:
    """Everything one query needs, built lazily from ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str, persist_marts: bool = False):
        release_all()          # blocks persisted by the previous query's build
        self.spark = spark
        self.t = tables(spark, sf_dir)
        self.raw = AnalogRaw(self.t, load=True)
        self.min_volume = oracle.MIN_VOLUME
        self.wh = Warehouse(self.raw, seed_drg_service_line(self.t),
                            cost_tie_break=("Report Record Number",), min_volume=self.min_volume,
                            # the stand-ins' dimensions are read by several models of a query
                            persist_dims=True,
                            persist_marts=persist_marts)

    def published(self, name: str, tables: list[str]) -> DataFrame:
        """``name`` as a second session reads it after a build of ``tables``."""
        run = new_run_id()
        root = f"{warehouse_root(self.spark)}/published/{run}"
        build_all(self.spark, self.wh, root, run, brand_lines(), publish=True, tables=tables)
        reader = self.spark.newSession()
        for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
            reader.conf.set(key, self.spark.conf.get(key))
        snapshot(reader, root).bind(f"published_{run}")
        return reader.table(f"published_{run}.{name}")

    @property
    def hospital_geo(self) -> DataFrame:
        return etl.build_hospital_geo(etl.clean_hospital_info(self.raw["hospital_general_info"]),
                                      self.raw["zip_cbsa_crosswalk"])

    @property
    def ranked_groups(self) -> DataFrame:
        return self.wh.mart_service_line_margin.where(F.col("global_rank").isNotNull())


def rounded(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Sums of doubles as compared: the models keep full values."""
    return df.withColumns({c: stable_round(c, digits) for c in cols})


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table under the shared root and scanned from there."""
    return materialize(df.sparkSession, df, f"{warehouse_root(df.sparkSession)}/states", name, new_run_id())[0]


Q_: dict[str, Callable[[Ctx], DataFrame]] = {}
S_: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        Q_[name] = fn
        if sql is not None:
            S_[name] = sql
        return fn
    return deco


def _cols(pairs) -> str:
    return ", ".join(f'"{src}" AS {dst}' for src, dst in pairs)


# ---- loading and cleaning ----------------------------------------------------
@query("pad_ids", f"""SELECT CAST(c_custkey AS VARCHAR) AS facility_id_raw,
  {pad("CAST(c_custkey AS VARCHAR)", 6)} AS facility_id,
  {pad("CAST(c_custkey AS VARCHAR)", 5)} AS zip5
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def q_pad_ids(c: Ctx) -> DataFrame:
    raw = c.raw.unloaded("hospital_general_info")
    return raw.select(col_of("Facility ID").alias("facility_id_raw"),
                      pad_id("Facility ID", 6).alias("facility_id"),
                      pad_id("Facility ID", 5).alias("zip5"))


@query("rename_project", compose(f"SELECT {_cols(etl.DEDUP_COLUMNS)} FROM raw_cost_report"))
def q_rename_project(c: Ctx) -> DataFrame:
    from ..operators import rename_project
    return rename_project(c.raw["cost_report"], etl.DEDUP_COLUMNS)


_HOSP_RAW = ["Facility ID", "Facility Name", "Address", "City/Town", "State", "ZIP Code",
             "County/Parish", "Telephone Number", "Hospital Type", "Hospital Ownership",
             "Emergency Services", "Meets criteria for birthing friendly designation",
             "Hospital overall rating"]
_CLEAN_SQL = ", ".join(
    "upper(replace(trim(\"County/Parish\"), ' ', '')) AS \"County/Parish\"" if n == "County/Parish"
    else f'"{n}"' for n in _HOSP_RAW)
oracle.F["clean_hospital"] = (f"SELECT {_CLEAN_SQL} FROM raw_hospital_general_info "
                              "WHERE \"Hospital Type\" = 'Acute Care Hospitals'")


@query("clean_dynamic", compose("SELECT * FROM clean_hospital"))
def q_clean_dynamic(c: Ctx) -> DataFrame:
    return etl.clean_hospital_info(c.raw["hospital_general_info"])


@query("clean_text", compose("""SELECT "Facility ID" AS facility_id, "County/Parish" AS county_raw,
  upper(replace(trim("County/Parish"), ' ', '')) AS county FROM raw_hospital_general_info"""))
def q_clean_text(c: Ctx) -> DataFrame:
    raw = c.raw["hospital_general_info"]
    return raw.select(col_of("Facility ID").alias("facility_id"),
                      col_of("County/Parish").alias("county_raw"),
                      squash_upper("County/Parish").alias("county"))


@query("sentinel_cast", compose("""SELECT "Facility ID" AS facility_id,
  "Hospital overall rating" AS rating_raw,
  CAST(nullif("Hospital overall rating", 'Not Available') AS INTEGER) AS hospital_overall_rating
FROM raw_hospital_general_info"""))
def q_sentinel_cast(c: Ctx) -> DataFrame:
    raw = c.raw["hospital_general_info"]
    return raw.select(col_of("Facility ID").alias("facility_id"),
                      col_of("Hospital overall rating").alias("rating_raw"),
                      sentinel_to_null("Hospital overall rating", "Not Available", "int")
                      .alias("hospital_overall_rating"))


@query("parse_dates", compose(f"""SELECT "Provider CCN" AS ccn,
  "Report Record Number" AS report_record_number,
  "Fiscal Year End Date" AS year_end_text,
  {usdate('"Fiscal Year Begin Date"')} AS fiscal_year_begin_date,
  {usdate('"Fiscal Year End Date"')} AS fiscal_year_end_date
FROM raw_cost_report"""))
def q_parse_dates(c: Ctx) -> DataFrame:
    raw = c.raw["cost_report"]
    return raw.select(col_of("Provider CCN").alias("ccn"),
                      col_of("Report Record Number").alias("report_record_number"),
                      col_of("Fiscal Year End Date").alias("year_end_text"),
                      parse_date("Fiscal Year Begin Date").alias("fiscal_year_begin_date"),
                      parse_date("Fiscal Year End Date").alias("fiscal_year_end_date"))


_HOSP_CSV = ", ".join(f'"{n}"' for n in _HOSP_RAW)


def from_csv(c: Ctx, table: str, columns: list[str] | None = None) -> DataFrame:
    """A stand-in written as delimited text under the shared root and loaded
    from there by the raw loader (text ids, padding, inferred types)."""
    path = f"{warehouse_root(c.spark)}/csv/{new_run_id()}"
    raw = c.raw.unloaded(table)
    raw.select([col_of(n) for n in columns or raw.columns]) \
        .write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    return load_raw_csv(c.spark, {table: path})[table]


@query("csv_load", compose(f"SELECT {_HOSP_CSV} FROM raw_hospital_general_info"))
def q_csv_load(c: Ctx) -> DataFrame:
    return from_csv(c, "hospital_general_info", _HOSP_RAW)


@query("csv_crosswalk", compose("SELECT geoid, cbsa, res_ratio FROM raw_zip_cbsa_crosswalk"))
def q_csv_crosswalk(c: Ctx) -> DataFrame:
    return from_csv(c, "zip_cbsa_crosswalk")


_CODES = ["Provider Type", "Type of Control"]


@query("csv_cost_report", compose("SELECT * REPLACE (" + ", ".join(
    f'CAST("{n}" AS BIGINT) AS "{n}"' for n in _CODES) + ") FROM raw_cost_report"))
def q_csv_cost_report(c: Ctx) -> DataFrame:
    """All columns of the cost report: codes and record numbers come out as
    integers, measures as doubles, dates and ids as text."""
    return from_csv(c, "cost_report")


@query("csv_medicare", compose("SELECT * FROM raw_medicare_inpatient"))
def q_csv_medicare(c: Ctx) -> DataFrame:
    return from_csv(c, "medicare_inpatient")


@query("csv_census", compose("SELECT * FROM raw_census_acs"))
def q_csv_census(c: Ctx) -> DataFrame:
    return from_csv(c, "census_acs")


# ---- staging -------------------------------------------------------------------
@query("stg_hospital", compose("SELECT * FROM stg_hospital_general_info"))
def q_stg_hospital(c: Ctx) -> DataFrame:
    return c.wh.stg_hospital_general_info


_AVGS = ["avg_submitted_covered_charge", "avg_total_payment_amount", "avg_medicare_payment_amount"]


@query("stage_measures", compose(f"""SELECT ccn, ruca_code, ruca_description, drg_code,
  drg_description, total_discharges, {', '.join(_AVGS)}
FROM stg_medicare_inpatient"""))
def q_stage_measures(c: Ctx) -> DataFrame:
    return c.wh.stg_medicare_inpatient


@query("stg_crosswalk", compose("SELECT * FROM stg_zip_cbsa_crosswalk"))
def q_stg_crosswalk(c: Ctx) -> DataFrame:
    """ZIP to CBSA bridge without the non-metro code (many rows per ZIP)."""
    return c.wh.stg_zip_cbsa_crosswalk


@query("latest_per_key", compose("SELECT * FROM stg_cost_report"))
def q_latest_per_key(c: Ctx) -> DataFrame:
    return c.wh.stg_cost_report


_DEDUP_NAMES = ", ".join(dst for _, dst in etl.DEDUP_COLUMNS)
oracle.F["cost_report_dedup"] = f"""
SELECT {_DEDUP_NAMES} FROM (
  SELECT {_cols(etl.DEDUP_COLUMNS)},
         row_number() OVER (PARTITION BY "Provider CCN"
                            ORDER BY {usdate('"Fiscal Year End Date"')} DESC NULLS FIRST,
                                     "Report Record Number" DESC NULLS LAST) AS rn
  FROM raw_cost_report) d WHERE rn = 1"""


@query("cost_report_dedup", compose("SELECT * FROM cost_report_dedup"))
def q_cost_report_dedup(c: Ctx) -> DataFrame:
    return etl.dedup_cost_report(c.raw["cost_report"], ("Report Record Number",))


_GEO_SQL = ", ".join(f'h."{src}" AS {dst}' for src, dst in etl.GEO_COLUMNS)
oracle.F["hospital_geo"] = f"""
SELECT {_GEO_SQL}, b.cbsa AS cbsa_code, b.res_ratio AS res_ratio
FROM clean_hospital h
LEFT JOIN (SELECT geoid, cbsa, res_ratio,
                  row_number() OVER (PARTITION BY geoid
                                     ORDER BY res_ratio DESC NULLS FIRST, cbsa ASC NULLS LAST) AS rn
           FROM raw_zip_cbsa_crosswalk WHERE cbsa <> '99999') b
  ON h."ZIP Code" = b.geoid AND b.rn = 1"""


@query("dominant_match", compose("SELECT * FROM hospital_geo"))
def q_dominant_match(c: Ctx) -> DataFrame:
    return c.hospital_geo


@query("distinct_attrs", compose("SELECT * FROM ruca"))
def q_distinct_attrs(c: Ctx) -> DataFrame:
    return c.wh.stg_medicare_inpatient.select("ccn", "ruca_code", "ruca_description").distinct()


@query("uninsured_rate", compose("SELECT * FROM stg_census_acs"))
def q_uninsured_rate(c: Ctx) -> DataFrame:
    return c.wh.stg_census_acs


@query("census_uninsured", compose("""SELECT "NAME" AS name,
  "metropolitan statistical area/micropolitan statistical area" AS cbsa_code,
  "B27010_001E" AS universe,
  "B27010_017E" + "B27010_033E" + "B27010_050E" + "B27010_066E" AS uninsured_count,
  CAST("B27010_017E" + "B27010_033E" + "B27010_050E" + "B27010_066E" AS DOUBLE)
    / CAST("B27010_001E" AS DOUBLE) AS uninsured_rate
FROM raw_census_acs"""))
def q_census_uninsured(c: Ctx) -> DataFrame:
    return etl.build_census_uninsured(c.raw["census_acs"])


# ---- keys and dimensions ------------------------------------------------------------
@query("surrogate_key", compose(f"""SELECT ccn, {sk('ccn')} AS hospital_key,
  {sk('hospital_ownership', 'cbsa_code')} AS ownership_area_key, hospital_ownership, cbsa_code
FROM dim_hospital"""))
def q_surrogate_key(c: Ctx) -> DataFrame:
    d = c.wh.dim_hospital
    return d.select("ccn", surrogate_key("ccn").alias("hospital_key"),
                    surrogate_key("hospital_ownership", "cbsa_code").alias("ownership_area_key"),
                    "hospital_ownership", "cbsa_code")


@query("dim_date", compose("""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date_day,
  CAST(year(d) AS INTEGER) AS calendar_year, CAST(quarter(d) AS INTEGER) AS calendar_quarter,
  CAST(month(d) AS INTEGER) AS calendar_month, monthname(d) AS month_name,
  CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
  dayname(d) AS day_name
FROM (SELECT CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP),
                                         INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT min(fiscal_year_begin_date) AS s, max(fiscal_year_end_date) AS e
            FROM stg_cost_report) b) days"""))
def q_dim_date(c: Ctx) -> DataFrame:
    """Day spine over the fiscal-year range found in the staged cost
    report (end exclusive = last year end + 1 day)."""
    b = c.wh.stg_cost_report.agg(F.min("fiscal_year_begin_date").alias("s"),
                                 F.date_add(F.max("fiscal_year_end_date"), 1).alias("e"))
    return dim_date(date_spine_between(b, "s", "e"))


@query("dim_lookup", compose("SELECT * FROM dim_drg"))
def q_dim_lookup(c: Ctx) -> DataFrame:
    return c.wh.dim_drg


@query("dim_geography", compose("SELECT * FROM dim_geography"))
def q_dim_geography(c: Ctx) -> DataFrame:
    return c.wh.dim_geography


@query("dim_hospital", compose("SELECT * FROM dim_hospital"))
def q_dim_hospital(c: Ctx) -> DataFrame:
    return c.wh.dim_hospital


@query("geo_reclass_flag", compose("""SELECT ccn, cbsa_code, medicare_payment_cbsa,
  is_cbsa_reclassified FROM dim_hospital"""))
def q_geo_reclass_flag(c: Ctx) -> DataFrame:
    return c.wh.dim_hospital.select("ccn", "cbsa_code", "medicare_payment_cbsa",
                                    "is_cbsa_reclassified")


# ---- facts -----------------------------------------------------------------------------
@query("fact_finance", compose("SELECT * FROM fct_hospital_finance"))
def q_fact_finance(c: Ctx) -> DataFrame:
    return c.wh.fct_hospital_finance


@query("range_flag", compose("""SELECT hospital_key, cost_to_charge_ratio, is_ccr_outlier
FROM fct_hospital_finance"""))
def q_range_flag(c: Ctx) -> DataFrame:
    return c.wh.fct_hospital_finance.select("hospital_key", "cost_to_charge_ratio", "is_ccr_outlier")


@query("fact_drg", compose(f"""SELECT hospital_key, drg_key, total_discharges, {', '.join(_AVGS)}
FROM fct_medicare_drg"""))
def q_fact_drg(c: Ctx) -> DataFrame:
    return c.wh.fct_medicare_drg


@query("fact_drg_split", S_["fact_drg"])
def q_fact_drg_split(c: Ctx) -> DataFrame:
    """The same fact with both dimensions over the broadcast bound: Bloom
    filters drop unmatched rows, hot keys are joined apart."""
    c.wh.bcast = 1
    return c.wh.fct_medicare_drg


# ---- marts ---------------------------------------------------------------------------------
@query("reimbursement_gap", compose("SELECT * FROM mart_reimbursement_gap"))
def q_reimbursement_gap(c: Ctx) -> DataFrame:
    return c.wh.mart_reimbursement_gap


_SLM = compose("SELECT * FROM mart_service_line_margin")


@query("service_line_margin", _SLM)
def q_service_line_margin(c: Ctx) -> DataFrame:
    return c.wh.mart_service_line_margin


@query("service_line_margin_join", _SLM)
def q_service_line_margin_join(c: Ctx) -> DataFrame:
    """Same mart through the self-join form: ranked subset left-joined back
    on service line and null-safe metro."""
    return mart_service_line_margin(c.wh.service_line_groups, c.min_volume, form="join")


@query("global_rank", compose("""SELECT hospital_key, drg_key, margin,
  rank() OVER (ORDER BY margin ASC NULLS LAST) AS margin_rank
FROM mart_reimbursement_gap"""))
def q_global_rank(c: Ctx) -> DataFrame:
    """rank() over every hospital x DRG margin, without a single-task stage."""
    return global_rank(c.wh.mart_reimbursement_gap.select("hospital_key", "drg_key", "margin"), "margin", "margin_rank")


_RANKED = ["service_line", "metro_name", "avg_margin", "total_discharge_volume", "global_rank"]


@query("top_worst", compose(f"""SELECT {', '.join(_RANKED)} FROM mart_service_line_margin
WHERE global_rank IS NOT NULL ORDER BY global_rank, service_line, metro_name NULLS LAST LIMIT 5"""))
def q_top_worst(c: Ctx) -> DataFrame:
    return A.top_n(c.ranked_groups.select(_RANKED),
                   [F.col("global_rank"), F.col("service_line"), F.col("metro_name").asc_nulls_last()], 5)


@query("top_best", compose(f"""SELECT {', '.join(_RANKED)} FROM mart_service_line_margin
WHERE global_rank IS NOT NULL ORDER BY avg_margin DESC, service_line, metro_name NULLS LAST LIMIT 5"""))
def q_top_best(c: Ctx) -> DataFrame:
    return A.top_n(c.ranked_groups.select(_RANKED),
                   [F.col("avg_margin").desc(), F.col("service_line"), F.col("metro_name").asc_nulls_last()], 5)


@query("finance_scorecard", compose("SELECT * FROM mart_finance_scorecard"))
def q_finance_scorecard(c: Ctx) -> DataFrame:
    return c.wh.mart_finance_scorecard


@query("burden_vs_community", compose("SELECT * FROM mart_burden_vs_community"))
def q_burden_vs_community(c: Ctx) -> DataFrame:
    return c.wh.mart_burden_vs_community


# ---- audits and data quality ---------------------------------------------------------------
@query("audit_counts", compose("""SELECT count(*) AS row_count,
  count_if(cbsa_code IS NULL) AS null_cbsa_code FROM hospital_geo"""))
def q_audit_counts(c: Ctx) -> DataFrame:
    return audit_counts(c.hospital_geo, ["cbsa_code"])


_FIN_COLS = ["hospital_key", "fiscal_year_begin_date", "fiscal_year_end_date", "number_of_beds",
             "total_bed_days_available", "total_costs", "total_charges", "inpatient_total_charges",
             "outpatient_total_charges", "cost_to_charge_ratio", "charity_care_cost",
             "bad_debt_expense", "uncompensated_care_cost", "total_unreimbursed_uncompensated_care",
             "net_income", "net_income_from_service_to_patients", "total_assets",
             "total_liabilities", "total_fund_balances", "net_patient_revenue", "is_ccr_outlier"]


@query("dq_not_null", compose("SELECT count(*) AS row_count, " + ", ".join(
    f"count_if({c} IS NULL) AS null_{c}" for c in _FIN_COLS) + " FROM fct_hospital_finance"))
def q_dq_not_null(c: Ctx) -> DataFrame:
    return Q.null_profile(c.wh.fct_hospital_finance, _FIN_COLS)


@query("dq_unique", compose("""SELECT "Provider CCN" AS unique_field, count(*) AS n_records
FROM raw_cost_report WHERE "Provider CCN" IS NOT NULL GROUP BY 1 HAVING count(*) > 1"""))
def q_dq_unique(c: Ctx) -> DataFrame:
    """The raw cost report is not unique per CCN (several filings), which
    is why the staging model keeps the latest one."""
    return Q.unique(c.raw["cost_report"], "Provider CCN")


@query("dq_relationships_large", None)
def q_dq_relationships_large(c: Ctx) -> DataFrame:
    """``dq_relationships`` for a parent too large to broadcast: a Bloom
    filter settles the certain orphans before any shuffle."""
    return pruned_orphans(c.wh.stg_medicare_inpatient.select(F.col("ccn").alias("from_field")), "from_field",
                          c.wh.stg_hospital_general_info, "facility_id")


_ACCEPTED = brand_lines(20)


@query("dq_accepted", compose("SELECT service_line AS value_field, count(*) AS n_records FROM dim_drg "
                              "WHERE service_line NOT IN (" + ", ".join(f"'{v}'" for v in _ACCEPTED)
                              + ") GROUP BY 1"))
def q_dq_accepted(c: Ctx) -> DataFrame:
    return Q.accepted_values(c.wh.dim_drg, "service_line", _ACCEPTED)


@query("dq_unique_bucketed", S_["dq_unique"])
def q_dq_unique_bucketed(c: Ctx) -> DataFrame:
    """``dq_unique`` over a table bucketed on the tested key: duplicates are
    searched within the buckets, without a shuffle."""
    n = int(c.spark.conf.get("spark.sql.shuffle.partitions"))
    table, _ = materialize(c.spark, c.raw["cost_report"].select("Provider CCN", "Report Record Number"),
                           f"{warehouse_root(c.spark)}/bucketed", "cost_report", new_run_id(),
                           bucket_by=(n, ["Provider CCN"]))
    return Q.unique(table, "Provider CCN")


@query("dq_relationships", compose("""SELECT m.ccn AS from_field FROM stg_medicare_inpatient m
LEFT JOIN (SELECT DISTINCT facility_id AS pk FROM stg_hospital_general_info) p ON m.ccn = p.pk
WHERE m.ccn IS NOT NULL AND p.pk IS NULL"""))
def q_dq_relationships(c: Ctx) -> DataFrame:
    """Medicare rows whose CCN has no acute-care hospital row (the fact's
    inner join to the hospital dimension drops exactly these)."""
    return Q.relationships(c.wh.stg_medicare_inpatient, "ccn", c.wh.stg_hospital_general_info,
                           "facility_id")


S_["dq_relationships_large"] = S_["dq_relationships"]


@query("dq_range", compose("""SELECT * FROM fct_hospital_finance WHERE cost_to_charge_ratio IS NOT NULL
  AND (cost_to_charge_ratio < 0 OR cost_to_charge_ratio > 1)"""))
def q_dq_range(c: Ctx) -> DataFrame:
    return Q.out_of_range(c.wh.fct_hospital_finance, "cost_to_charge_ratio", 0.0, 1.0)


@query("dq_report", None)
def q_dq_report(c: Ctx) -> DataFrame:
    """All 52 declared data tests in one report, run the way the warehouse
    runs them: every table model is written to a run folder under the
    shared warehouse root first, then the tests read the written tables."""
    return build_all(c.spark, c.wh, service_lines=brand_lines(), enforce=False)["report"]


S_["dq_report"] = compose(report_sql(brand_lines()))


@query("published_burden", compose("SELECT * FROM mart_burden_vs_community"))
def q_published_burden(c: Ctx) -> DataFrame:
    """The community mart as readers see it: built and published, then read
    by its published name in a second session."""
    return c.published("mart_burden_vs_community", ["dim_hospital", "dim_geography", "fct_hospital_finance",
                                                    "mart_finance_scorecard", "mart_burden_vs_community"])


@query("published_stg_cost", compose("SELECT * FROM stg_cost_report"))
def q_published_stg_cost(c: Ctx) -> DataFrame:
    """A staging model read as a persistent view over the published raw tables."""
    return c.published("stg_cost_report", [])


@query("published_stg_hospital", compose("SELECT * FROM stg_hospital_general_info"))
def q_published_stg_hospital(c: Ctx) -> DataFrame:
    return c.published("stg_hospital_general_info", [])


@query("dq_identity", compose("""SELECT count_if("Net Patient Revenue" IS NOT NULL
    AND "Total Patient Revenue" IS NOT NULL AND "Contractual Allowance" IS NOT NULL) AS rows_checked,
  count_if("Net Patient Revenue" IS NOT NULL AND "Total Patient Revenue" IS NOT NULL
    AND "Contractual Allowance" IS NOT NULL
    AND abs("Net Patient Revenue" - ("Total Patient Revenue" * 1 + "Contractual Allowance" * -1))
        > 0.005) AS rows_failing
FROM raw_cost_report"""))
def q_dq_identity(c: Ctx) -> DataFrame:
    return Q.identity_summary(c.raw["cost_report"], "Net Patient Revenue",
                              [("Total Patient Revenue", 1), ("Contractual Allowance", -1)])


@query("dq_fd", compose("""SELECT "Provider CCN", count(*) AS n_variants FROM
  (SELECT "Provider CCN", "Hospital Name" FROM raw_cost_report GROUP BY 1, 2) t
GROUP BY 1 HAVING count(*) > 1"""))
def q_dq_fd(c: Ctx) -> DataFrame:
    """CCNs whose filed hospital name is not constant across filings."""
    return Q.dependency_fails(c.raw["cost_report"], "Provider CCN", ["Hospital Name"])


@query("dq_compare", compose("""SELECT count_if(avg_medicare_payment_amount IS NOT NULL
    AND avg_total_payment_amount IS NOT NULL) AS rows_checked,
  count_if(avg_medicare_payment_amount > avg_total_payment_amount) AS rows_failing
FROM fct_medicare_drg"""))
def q_dq_compare(c: Ctx) -> DataFrame:
    return Q.order_summary(c.wh.fct_medicare_drg, "avg_medicare_payment_amount",
                           "avg_total_payment_amount")


# ---- documented analyses ---------------------------------------------------------------------------
@query("burden_corr", compose(f"""SELECT {r6('corr(uninsured_rate, uncompensated_pct_of_revenue)')}
  AS correlation,
  count_if(uninsured_rate IS NOT NULL AND uncompensated_pct_of_revenue IS NOT NULL) AS n_pairs
FROM mart_burden_vs_community"""))
def q_burden_corr(c: Ctx) -> DataFrame:
    return A.pair_corr(settled(c.wh.mart_burden_vs_community), "uninsured_rate", "uncompensated_pct_of_revenue", 6)


@query("burden_corr_stored", S_["burden_corr"])
def q_burden_corr_stored(c: Ctx) -> DataFrame:
    """The same correlation from moment states kept as a table per ownership,
    as a dashboard would add extracts to it."""
    mart = settled(c.wh.mart_burden_vs_community)
    states = stored(moment_states(mart, ["hospital_ownership"], "uninsured_rate", "uncompensated_pct_of_revenue"),
                    "burden_states")
    merged = merge_moments(states, [], ["hospital_ownership", "part"])
    return merged.select(stable_round(correlation(), 6).alias("correlation"), F.col("n").alias("n_pairs"))


@query("volume_percentiles", compose(f"""SELECT
  {r6('quantile_cont(total_discharge_volume, 0.05)')} AS p5,
  {r6('quantile_cont(total_discharge_volume, 0.25)')} AS p25,
  {r6('quantile_cont(total_discharge_volume, 0.5)')} AS p50
FROM mart_service_line_margin"""))
def q_volume_percentiles(c: Ctx) -> DataFrame:
    p = exact_percentiles(c.wh.service_line_groups, "total_discharge_volume", [0.05, 0.25, 0.5])
    return rounded(p, ["p5", "p25", "p50"])


def by_rank(share: float, name: str) -> str:
    """SQL: the smallest value with at least ``share`` of the values up to it."""
    return f"min(CASE WHEN nth >= ceil({share} * n) THEN v END) AS {name}"


@query("volume_sketches", compose(f"""SELECT service_line, CAST(max(n) AS BIGINT) AS n, {by_rank(.05, 'p5')},
  {by_rank(.25, 'p25')}, {by_rank(.5, 'p50')} FROM (
SELECT *, row_number() OVER (PARTITION BY level, service_line ORDER BY v) AS nth,
       count(*) OVER (PARTITION BY level, service_line) AS n FROM (
SELECT 1 AS level, service_line, CAST(total_discharge_volume AS DOUBLE) AS v FROM slm_groups
UNION ALL SELECT 2, NULL, CAST(total_discharge_volume AS DOUBLE) FROM slm_groups) r) q GROUP BY level, service_line"""))
def q_volume_sketches(c: Ctx) -> DataFrame:
    """Volume percentiles by service line, and overall, from one stored table
    of quantile states (exact up to 2,048 groups a line)."""
    states = stored(K.quantile_states(c.wh.service_line_groups, ["service_line"], "total_discharge_volume"),
                    "volume_states")
    levels = states.unionByName(K.merge_quantiles(states, []).withColumn("service_line", F.lit(None).cast("string")))
    return levels.select("service_line", "n", *[K.quantile(p).alias(n) for p, n in
                                                ((.05, "p5"), (.25, "p25"), (.5, "p50"))])


@query("metro_sketches", compose("""SELECT service_line, count(DISTINCT metro_name) AS exact_metros,
  count(DISTINCT metro_name) AS merged_metros FROM mart_reimbursement_gap WHERE metro_name IS NOT NULL GROUP BY 1
UNION ALL SELECT NULL, count(DISTINCT metro_name), count(DISTINCT metro_name) FROM mart_reimbursement_gap"""))
def q_metro_sketches(c: Ctx) -> DataFrame:
    """Distinct metros by service line and overall: counted exactly, and from
    one stored table of states, in which metros are shared between lines."""
    rows = settled(c.wh.gap_measures.select("service_line", "metro_name").where("metro_name IS NOT NULL"))
    states = stored(K.distinct_states(rows, ["service_line"], "metro_name"), "metro_states")
    total = F.lit(None).cast("string").alias("service_line")
    merged = states.unionByName(K.merge_distinct(states, []).select(total, "distinct")) \
        .select("service_line", K.distinct_estimate().alias("merged_metros"))
    exact = rows.groupBy("service_line").agg(F.count_distinct("metro_name").alias("exact_metros")) \
        .unionByName(rows.agg(F.count_distinct("metro_name").alias("exact_metros")).select(total, "exact_metros"))
    return keyed_join(exact, merged, null_safe_keys=["service_line"], how="inner")


@query("fact_by_line", compose("""SELECT f.*, d.service_line, d.drg_code FROM fct_medicare_drg f
JOIN dim_drg d ON f.drg_key = d.drg_key WHERE d.drg_code <= '000120'"""))
def q_fact_by_line(c: Ctx) -> DataFrame:
    """Rows of some DRGs from the fact partitioned by service line: a filter
    on the dimension decides which folders are read."""
    small = c.wh._small("dim_drg")
    by_line, _ = write_by_line(c.spark, c.wh.fct_medicare_drg_with_line, f"{warehouse_root(c.spark)}/facts",
                               new_run_id())
    return rows_of(by_line, c.wh.dim_drg, F.col("drg_code") <= "000120", small)


@query("threshold_coverage", compose(f"""SELECT
  count_if(total_discharge_volume < {oracle.MIN_VOLUME}) AS below_rows, count(*) AS total_rows,
  {r6(f'CASE WHEN count(*) > 0 THEN count_if(total_discharge_volume < {oracle.MIN_VOLUME}) / count(*) END')}
    AS below_share
FROM mart_service_line_margin"""))
def q_threshold_coverage(c: Ctx) -> DataFrame:
    return A.share_where(c.wh.service_line_groups,
                         F.col("total_discharge_volume") < F.lit(c.min_volume), "below", digits=6)


@query("negative_share", compose(f"""SELECT count_if(avg_margin < 0) AS negative_rows,
  count(*) AS total_rows,
  {r6('CASE WHEN count(*) > 0 THEN count_if(avg_margin < 0) / count(*) END')} AS negative_share
FROM mart_service_line_margin WHERE global_rank IS NOT NULL"""))
def q_negative_share(c: Ctx) -> DataFrame:
    return A.share_where(c.ranked_groups, F.col("avg_margin") < 0, "negative", digits=6)


@query("portfolio_gap", compose(f"""SELECT {exact_double('s', 66)} AS portfolio_gap
FROM (SELECT {scaled_sum('(margin * total_discharges)', 66)} AS s FROM mart_reimbursement_gap) t"""))
def q_portfolio_gap(c: Ctx) -> DataFrame:
    return A.weighted_total(c.wh.gap_measures, "margin", "total_discharges", "portfolio_gap")


_EXACT = {"total_costs": "Total Costs", "net_income": "Net Income", "interns": "Number of Interns and Residents (FTE)"}


@query("exact_sums", compose(f"""SELECT control, n, {', '.join(
    f"{exact_double(k, 60)} / n AS avg_{k}, {exact_double(k, 60)} AS {k}" for k in _EXACT)} FROM (
SELECT "Type of Control" AS control, count(*) AS n, {', '.join(
    scaled_sum(f'"{v}"', 60) + f" AS {k}" for k, v in _EXACT.items())}
FROM raw_cost_report GROUP BY 1) t"""))
def q_exact_sums(c: Ctx) -> DataFrame:
    """Sums and means of the filings' measures by type of control, compared
    bit by bit: the SQL adds whole numbers."""
    return exact_sums(c.raw["cost_report"].withColumnRenamed("Type of Control", "control"), ["control"],
                      _EXACT, {"n": F.lit(1)}, {f"avg_{k}": k for k in _EXACT})


@query("metro_coverage", compose("""SELECT count(DISTINCT metro_name) AS distinct_metros
FROM mart_service_line_margin WHERE global_rank IS NOT NULL"""))
def q_metro_coverage(c: Ctx) -> DataFrame:
    return A.distinct_count(c.ranked_groups, "metro_name", "distinct_metros")


@query("margin_spread", compose(f"""SELECT service_line, count(*) AS n_groups,
  {r6('min(avg_margin)')} AS min_value, {r6('max(avg_margin)')} AS max_value,
  {r6('max(avg_margin) - min(avg_margin)')} AS value_range,
  {r6('stddev_samp(avg_margin)')} AS stddev_value
FROM mart_service_line_margin GROUP BY service_line"""))
def q_margin_spread(c: Ctx) -> DataFrame:
    return A.spread(settled(c.wh.service_line_groups), "service_line", "avg_margin", 6)


@query("margin_spread_stored", S_["margin_spread"])
def q_margin_spread_stored(c: Ctx) -> DataFrame:
    """The same spread from stored moment states and extremes."""
    groups = settled(c.wh.service_line_groups)
    return A.spread_of(stored(moment_states(groups, ["service_line"], "avg_margin"), "margin_states"),
                       stored(A.extremes(groups, "service_line", "avg_margin"), "margin_extremes"), "service_line", 6)


@query("source_mismatch", compose(f"""SELECT count(*) AS matched_keys,
  {r6('avg(CAST((h.facility_name IS DISTINCT FROM d.hospital_name) AS INTEGER))')}
    AS name_mismatch_rate,
  {r6('avg(CAST((h.zip_code IS DISTINCT FROM d.zip_code) AS INTEGER))')} AS zip_mismatch_rate
FROM stg_hospital_general_info h JOIN cost_report_dedup d ON h.facility_id = d.ccn"""))
def q_source_mismatch(c: Ctx) -> DataFrame:
    """How often the cost report's identity fields disagree with the
    hospital registry for the same CCN."""
    h = c.wh.stg_hospital_general_info.select(F.col("facility_id").alias("ccn"),
                                              F.col("facility_name").alias("hi_name"),
                                              F.col("zip_code").alias("hi_zip"))
    d = etl.dedup_cost_report(c.raw["cost_report"], ("Report Record Number",)) \
        .select("ccn", F.col("hospital_name").alias("cr_name"), F.col("zip_code").alias("cr_zip"))
    return A.mismatch_rates(h, d, "ccn", {"name": ("hi_name", "cr_name"), "zip": ("hi_zip", "cr_zip")}, 6)


@query("geo_reclass_rate", compose(f"""SELECT count_if(is_cbsa_reclassified) AS flagged,
  count_if(is_cbsa_reclassified IS NOT NULL) AS known,
  {r6('CASE WHEN count_if(is_cbsa_reclassified IS NOT NULL) > 0 THEN count_if(is_cbsa_reclassified) / count_if(is_cbsa_reclassified IS NOT NULL) END')}
    AS flag_rate
FROM dim_hospital"""))
def q_geo_reclass_rate(c: Ctx) -> DataFrame:
    return A.known_rate(c.wh.dim_hospital, "is_cbsa_reclassified", 6)


oracle.F["finance_with_owner"] = """
SELECT f.*, h.ownership_type FROM fct_hospital_finance f JOIN dim_hospital h
  ON f.hospital_key = h.hospital_key"""


@query("null_lift", compose(f"""SELECT ownership_type, rows_all, rows_null,
  {r6('CASE WHEN sum(rows_null) OVER () > 0 THEN rows_null / sum(rows_null) OVER () END')} AS share_of_nulls,
  {r6('CASE WHEN sum(rows_all) OVER () > 0 THEN rows_all / sum(rows_all) OVER () END')} AS share_of_all,
  {r6('CASE WHEN sum(rows_all) OVER () > 0 THEN (CASE WHEN sum(rows_null) OVER () > 0 THEN rows_null / sum(rows_null) OVER () END) / (rows_all / sum(rows_all) OVER ()) END')} AS lift
FROM (SELECT ownership_type, count(*) AS rows_all, count_if(cost_to_charge_ratio IS NULL) AS rows_null
      FROM finance_with_owner GROUP BY 1) g"""))
def q_null_lift(c: Ctx) -> DataFrame:
    """Over-representation of each ownership type among hospitals with an
    unknown cost-to-charge ratio."""
    f = lookup_join(c.wh.fct_hospital_finance,
                    c.wh.dim_hospital.select(F.col("hospital_key").alias("__hk"), "ownership_type"),
                    F.col("hospital_key") == F.col("__hk"), "inner", c.wh._small("dim_hospital"))
    return A.null_lift(f, "cost_to_charge_ratio", "ownership_type", 6)


_GVO = ["number_of_beds", "total_costs", "net_patient_revenue"]


@query("group_vs_overall", compose("SELECT count_if(cost_to_charge_ratio IS NULL) AS group_rows, "
                                   "count(*) AS all_rows, " + ", ".join(
    f"{r6(f'avg(CASE WHEN cost_to_charge_ratio IS NULL THEN {x} END)')} AS {x}_group_avg, "
    f"{r6(f'avg({x})')} AS {x}_overall_avg" for x in _GVO) + " FROM fct_hospital_finance"))
def q_group_vs_overall(c: Ctx) -> DataFrame:
    return A.conditional_means(c.wh.fct_hospital_finance, F.col("cost_to_charge_ratio").isNull(), _GVO, 6)


@query("exclusion_audit", compose("""SELECT reason, count(*) AS fact_rows,
  count(DISTINCT hospital_key) AS hospitals FROM (
  SELECT d.hospital_key, CASE WHEN f.hospital_key IS NULL THEN 'no_cost_report'
                              WHEN f.cost_to_charge_ratio IS NULL THEN 'null_ccr'
                              WHEN f.is_ccr_outlier THEN 'ccr_outlier'
                              ELSE 'usable' END AS reason
  FROM fct_medicare_drg d LEFT JOIN fct_hospital_finance f ON d.hospital_key = f.hospital_key) x
GROUP BY reason"""))
def q_exclusion_audit(c: Ctx) -> DataFrame:
    """Fact rows (and hospitals) by why they are kept or dropped from the
    margin mart."""
    f = c.wh.fct_hospital_finance.select(F.col("hospital_key").alias("__hk"),
                                         "cost_to_charge_ratio", "is_ccr_outlier")
    # finance is hospital-grain: the hospital dimension's bound carries over
    j = lookup_join(c.wh.fct_medicare_drg, f, F.col("hospital_key") == F.col("__hk"), "left",
                    c.wh._small("dim_hospital"))
    reason = (F.when(F.col("__hk").isNull(), "no_cost_report")
              .when(F.col("cost_to_charge_ratio").isNull(), "null_ccr")
              .when(F.col("is_ccr_outlier"), "ccr_outlier").otherwise("usable"))
    return j.groupBy(reason.alias("reason")).agg(
        F.count(F.lit(1)).alias("fact_rows"), F.count_distinct("hospital_key").alias("hospitals"))


@query("drilldown", compose(f"""SELECT g.hospital_key, g.drg_code, g.service_line, g.metro_name,
  g.margin, g.total_discharges,
  rank() OVER (PARTITION BY g.service_line, g.metro_name ORDER BY g.margin) AS contribution_rank
FROM mart_reimbursement_gap g
SEMI JOIN (SELECT service_line, metro_name FROM mart_service_line_margin WHERE global_rank = 1) w
  ON g.service_line = w.service_line AND g.metro_name IS NOT DISTINCT FROM w.metro_name"""))
def q_drilldown(c: Ctx) -> DataFrame:
    """Rows behind the worst-ranked group(s), ranked by their margin within
    the group. The rank is the distributed partitioned rank, so a group
    holding a third of all fact rows is not sorted in one task."""
    # tied groups apart, a single row
    worst = settled(c.wh.mart_service_line_margin.where(F.col("global_rank") == 1).select("service_line", "metro_name"))
    rows = c.wh.gap_rows_of(worst)
    return global_rank(rows.select("hospital_key", "drg_code", "service_line", "metro_name",
                                   "margin", "total_discharges"),
                       "margin", "contribution_rank", partition_by=["service_line", "metro_name"])


@query("extreme_gap", compose(f"""SELECT {r6('min(v)')} AS lowest_value,
  {r6('max(v)')} AS second_lowest_value,
  {r6('CASE WHEN max(v) <> 0 THEN min(v) / max(v) END')} AS ratio
FROM (SELECT avg_margin AS v FROM mart_service_line_margin WHERE global_rank IS NOT NULL
      ORDER BY avg_margin LIMIT 2) t"""))
def q_extreme_gap(c: Ctx) -> DataFrame:
    return A.two_lowest(c.ranked_groups, "avg_margin", 6)


@query("top_ratio", compose("""SELECT hospital_key, hospital_name, charity_pct_of_revenue
FROM mart_finance_scorecard ORDER BY charity_pct_of_revenue DESC NULLS LAST, hospital_key LIMIT 10"""))
def q_top_ratio(c: Ctx) -> DataFrame:
    s = c.wh.mart_finance_scorecard.select("hospital_key", "hospital_name", "charity_pct_of_revenue")
    return A.top_n(s, [F.col("charity_pct_of_revenue").desc_nulls_last(), F.col("hospital_key")], 10)


@query("top_uninsured_metros", compose("""SELECT cbsa_code, metro_name, uninsured_rate
FROM dim_geography ORDER BY uninsured_rate DESC NULLS LAST, cbsa_code LIMIT 5"""))
def q_top_uninsured_metros(c: Ctx) -> DataFrame:
    g = c.wh.dim_geography.select("cbsa_code", "metro_name", "uninsured_rate")
    return A.top_n(g, [F.col("uninsured_rate").desc_nulls_last(), F.col("cbsa_code")], 5)


# ---- wiring -------------------------------------------------------------------------------------
def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, sf_dir: fn(Ctx(spark, sf_dir))
    return {name: bind(fn) for name, fn in Q_.items()}


def oracle_sql() -> dict[str, str]:
    return dict(S_)

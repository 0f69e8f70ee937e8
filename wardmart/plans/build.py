"""Full build: materialize every model in dependency order, test, publish.

The Spark counterpart of a warehouse build run: views (staging) stay lazy,
dimensions, facts and marts are written as Parquet tables into a run
folder under the shared warehouse root (``spark.checkpoint.dir`` of the
session), each later model reads the written tables -- so a lost executor
never forces a recompute past the last written model -- and the declared
data tests run against the written tables. Only a build that is whole and
passes its tests is published; until then readers see the one before.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..functions import dealt_packed
from ..operators import quality as Q
from ..sources import as_view, begin, entry_of, materialize, new_run_id
from ..sources import publish as make_visible
from ..session import warehouse_root
from .suite import spark_checks
from .views import RAW, raw_name, staging_views
from .warehouse import Warehouse

# staging models are views, named lazy plans
VIEWS = ["stg_hospital_general_info", "stg_cost_report", "stg_census_acs", "stg_zip_cbsa_crosswalk",
         "stg_medicare_inpatient"]
# models written as tables, in dependency order; staging stays lazy (views)
# the models of a wave read only models of earlier waves and are written side by side
WAVES = [["dim_hospital", "dim_drg", "dim_geography", "dim_date"],
         ["fct_hospital_finance", "fct_medicare_drg"],
         ["mart_reimbursement_gap", "mart_finance_scorecard"],
         ["mart_service_line_margin", "mart_burden_vs_community"]]
TABLES = [name for wave in WAVES for name in wave]

AUDIT_NULLS = {"dim_hospital": ["cbsa_code"], "mart_burden_vs_community": ["metro_name"]}

# hospital-grain tables and the hospital x DRG facts share one bucketing on
# the hospital key, so joins between them need no shuffle when the hospital
# dimension is too large to broadcast
BUCKETED_ON_HOSPITAL = ["dim_hospital", "fct_hospital_finance", "fct_medicare_drg",
                        "mart_reimbursement_gap", "mart_finance_scorecard"]


def build_all(spark: SparkSession, wh: Warehouse, root: str | None = None,
              run_id: str | None = None, service_lines: list[str] | None = None,
              enforce: bool = True, buckets: int | None = None, load: bool = False, publish: bool = False,
              tables: list[str] | None = None) -> dict:
    """Write every table model, then run the 52 declared tests on them.

    Hospital-keyed tables are bucketed on ``hospital_key`` into ``buckets``
    (default: the session's shuffle partition count). ``tables`` writes some
    models only; the tests are then those that read nothing else. Nothing is
    ever deleted here: see ``retire``.

    With ``load`` the raw tables are written first, as part of the run.
    ``publish`` does so too, and once the tests have passed the whole run
    becomes the version that readers of ``root`` see: raw tables, models,
    and the staging models as views. A failing test of error severity, or an
    error anywhere, leaves the version before in place.

    Returns ``{"run_id", "root", "audits": {model: metrics}, "entries",
    "report": DataFrame, "tests": rows, "version"}``; the report DataFrame reads only
    the written tables. With ``enforce`` or ``publish`` the (one row per
    test) report is collected and an error-severity failure raises; without
    them ``tests`` and ``version`` are None.
    """
    root = root or warehouse_root(spark)
    run_id = run_id or new_run_id()
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    audits, entries, version = {}, {}, None
    begin(spark, root, run_id)

    def write(name: str, model: DataFrame) -> DataFrame:
        bucket = (n, ["hospital_key"]) if name in BUCKETED_ON_HOSPITAL else None
        dealt = name in wh.dealt
        if name == "fct_medicare_drg" and not dealt:
            model, dealt = dealt_packed(model, n, "hospital_key", ["hospital_key", "drg_key"]), True
        df, audits[name] = materialize(spark, model, root, name, run_id, audit_nulls=AUDIT_NULLS.get(name, ()),
                                       bucket_by=bucket, dealt=dealt)
        entries[name] = entry_of(df, root, name, run_id, audits[name], bucket)
        return df

    def write_all(models: dict[str, DataFrame]) -> dict[str, DataFrame]:
        begin(spark, root, run_id)
        with ThreadPoolExecutor(max(1, len(models))) as pool:
            return dict(zip(models, pool.map(write, models, models.values())))

    if load or publish:
        written = write_all({raw_name(t): wh.raw[t] for t in RAW})
        wh.raw = {t: written[raw_name(t)] for t in RAW}
    for name in VIEWS:
        as_view(wh.model(name), name)
    wanted = set(TABLES if tables is None else tables)
    wh.dealt.clear()
    wh.buckets = n if "fct_medicare_drg" in wanted else None
    for wave in WAVES:
        # later models read the written table (cached_property slot)
        wh.__dict__.update(write_all({name: wh.model(name) for name in wave if name in wanted}))
    report = Q.quality_report(spark_checks(
        wh.model, service_lines, None if tables is None else {*VIEWS, *wanted},
        {name: "hospital_key" for name in BUCKETED_ON_HOSPITAL if name in wanted}))
    rows = Q.enforce(report) if enforce or publish else None
    if publish:
        version = make_visible(spark, root, run_id, entries, staging_views(wh.cost_tie_break, wh.cost_nulls_win))
    return {"run_id": run_id, "root": root, "audits": audits, "entries": entries, "report": report, "tests": rows,
            "version": version}

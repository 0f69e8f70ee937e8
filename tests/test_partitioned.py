"""Partitioned facts, partition pruning, and duplicates within buckets."""

import os

from pyspark.sql import functions as F

from wardmart.operators import quality as Q
from wardmart.plans.partitioned import replace_lines, rows_of, with_line, write_by_line
from wardmart.sources import materialize, new_run_id


def tables(spark):
    drg = spark.range(40).selectExpr("md5(string(id)) AS drg_key", "format_string('%03d', id) AS drg_code",
                                     "concat('Line ', id % 5) AS service_line")
    fact = spark.range(4_000).selectExpr("md5(concat('h', id % 100)) AS hospital_key",
                                         "md5(string(IF(id % 3 = 0, 0, id % 45))) AS drg_key", "id AS total_discharges")
    return fact, drg


def leaf_folders(path):
    return {d for d in os.listdir(path) if d.startswith("service_line=")}


def test_a_filter_on_the_dimension_prunes_the_fact(spark, tmpdir_path):
    fact, drg = tables(spark)
    by_line, audit = write_by_line(spark, with_line(fact, drg, True), tmpdir_path, "r1")
    path = os.path.join(tmpdir_path, "fct_medicare_drg_by_line", "run=r1")
    assert len(leaf_folders(path)) == 5 and by_line.count() == audit["row_count"]
    wanted = F.col("drg_code").isin("002", "007")       # two DRGs of one line
    got = rows_of(by_line, drg, wanted, True)
    plain = with_line(fact, drg, True).join(drg.where(wanted).select("drg_key", "drg_code"), "drg_key")
    assert sorted(map(str, got.select(sorted(got.columns)).collect())) \
        == sorted(map(str, plain.select(sorted(plain.columns)).collect())) != []
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan

    def scan(p):
        if "QueryStage" in p.getClass().getSimpleName() or "AdaptiveSparkPlan" in p.getClass().getSimpleName():
            return scan(p.plan() if "Stage" in p.getClass().getSimpleName() else p.executedPlan())
        if p.metrics().contains("numPartitions"):
            return [p.metrics().get("numPartitions").get().value()]
        return [x for i in range(p.children().size()) for x in scan(p.children().apply(i))]
    got.collect()
    assert scan(got._jdf.queryExecution().executedPlan()) == [1]        # of five folders
    # a hot line is written by several tasks, unless tasks this small are merged
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    _ = write_by_line(spark, with_line(fact, drg, True), tmpdir_path, "r2")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    folder = path.replace("run=r1", "run=r2") + "/service_line=Line 0"
    assert 1 < len([f for f in os.listdir(folder) if f.endswith(".parquet")]) <= 4


def test_lines_are_replaced_alone(spark, tmpdir_path):
    fact, drg = tables(spark)
    whole = with_line(fact, drg, True)
    path = os.path.join(tmpdir_path, "f")
    replace_lines(whole, path)
    before = {r.service_line: r["count"] for r in spark.read.parquet(path).groupBy("service_line").count().collect()}
    replace_lines(whole.where("service_line = 'Line 2'").limit(7), path)
    after = {r.service_line: r["count"] for r in spark.read.parquet(path).groupBy("service_line").count().collect()}
    assert after == before | {"Line 2": 7}


def test_duplicates_are_found_without_a_shuffle(spark, tmpdir_path):
    df = spark.range(1_000).selectExpr("IF(id % 3 = 0, 'hot', concat('k', id % 700)) AS k", "id AS v") \
        .unionByName(spark.sql("SELECT string(NULL) AS k, 1L AS v"))
    table, _ = materialize(spark, df, tmpdir_path, "t", new_run_id(), bucket_by=(6, ["k"]),
                           database="wardmart_unique_" + new_run_id())
    for check, source in ((Q.unique(table, "k"), Q.unique(df, "k")),
                          (Q.unique_combination(table, ["k", "v"]), Q.unique_combination(df, ["k", "v"]))):
        assert "Exchange" not in check._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, check.collect())) == sorted(map(str, source.collect()))


def test_the_report_searches_bucketed_keys_locally(spark, tmpdir_path):
    from wardmart.plans.suite import spark_checks, specs
    from test_publish import raw_tables, warehouse
    wh = warehouse(raw_tables(spark), spark)
    key = {"dim_hospital": "hospital_key"}
    plain = {c.name: c for c in spark_checks(wh.model)}
    local = {c.name: c for c in spark_checks(wh.model, bucketed=key)}
    changed = [n for n in plain if plain[n].unique_col != local[n].unique_col]
    assert changed == ["unique_dim_hospital_hospital_key"] and len(specs()) == len(local)
    rows = [sorted(map(str, Q.quality_report(list(c.values())).collect())) for c in (plain, local)]
    assert rows[0] == rows[1]

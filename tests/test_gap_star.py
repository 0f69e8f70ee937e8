"""The gap mart over dimensions too large to broadcast: each joined once with the medicare rows."""
import datetime

from pyspark.sql import functions as F

from wardmart.functions import dealt_packed
from wardmart.functions.keys import key_bytes, key_text
from wardmart.operators.cache import release_all
from wardmart.plans import facts, marts
from wardmart.plans.facts import FINANCE_MEASURES
from wardmart.plans.partitioned import rows_of
from wardmart.plans.warehouse import Warehouse
from wardmart.sources import materialize, new_run_id


def _inner_joins(plan) -> int:
    """Inner joins of an optimised plan, without those inside kept frames."""
    found = int(plan.nodeName() == "Join" and plan.joinType().toString() == "Inner")
    children = plan.children()
    return found + sum(_inner_joins(children.apply(i)) for i in range(children.size()))


def _frames(spark):
    day = datetime.date(2024, 1, 1)
    hospitals = spark.range(400).select(
        F.col("id").cast("string").alias("ccn"), F.md5(F.col("id").cast("string")).alias("hospital_key"),
        F.concat(F.lit("H"), "id").alias("hospital_name"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 5).cast("string")).alias("cbsa_code"))
    hospitals = hospitals.unionByName(hospitals.where("ccn = '3'"))         # a repeated key
    drgs = spark.range(300).select(
        F.col("id").cast("string").alias("drg_code"), F.md5(F.concat(F.lit("d"), "id")).alias("drg_key"),
        F.concat(F.lit("DRG "), "id").alias("drg_description"), (F.col("id") % 4).cast("string").alias("service_line"))
    drgs = drgs.unionByName(drgs.where("drg_code = '7'"))
    geography = spark.range(1, 4).select(F.col("id").cast("string").alias("cbsa_code"),
                                         F.concat(F.lit("M"), "id").alias("metro_name"))
    cost = spark.range(350).select(
        F.col("id").cast("string").alias("ccn"),
        *[(F.lit(day) if "date" in c else F.when(F.col("id") % 6 > 0, F.col("id") / 300.0) if "ratio" in c
           else F.col("id").cast("double")).alias(c) for c in FINANCE_MEASURES])
    medicare = spark.range(6_000).select(
        F.when(F.col("id") % 50 > 0, (F.col("id") % 419).cast("string")).alias("ccn"), F.lit("x").alias("drg_description"),
        (F.col("id") % 307).cast("string").alias("drg_code"), (F.col("id") % 9).alias("total_discharges"),
        *[(F.col("id") * k).cast("double").alias(c) for k, c in enumerate(
            ["avg_submitted_covered_charge", "avg_total_payment_amount", "avg_medicare_payment_amount"], 1)])
    return {"dim_hospital": hospitals, "dim_drg": drgs, "dim_geography": geography, "stg_cost_report": cost,
            "stg_medicare_inpatient": medicare}


def _warehouse(frames, bound):
    wh = Warehouse({}, frames["dim_drg"], max_broadcast_rows=bound)
    wh.__dict__.update(frames)
    return wh


def test_large_dimensions_are_joined_once_each(spark):
    frames = _frames(spark)
    broadcast = _warehouse(frames, 200_000).mart_reimbursement_gap
    wh = _warehouse(frames, 20)
    wh.persist_dims = True
    large = wh.mart_reimbursement_gap
    try:
        assert wh._bounds == {"dim_hospital": False, "dim_drg": False, "dim_geography": True}
        assert _inner_joins(large._jdf.queryExecution().optimizedPlan()) == 2
        # a fact that is there already is read
        wh.__dict__.pop("mart_reimbursement_gap")
        _ = wh.fct_medicare_drg
        read = wh.mart_reimbursement_gap
        wanted = sorted(map(str, broadcast.collect()))
        assert len(wanted) > 500
        assert sorted(map(str, large.collect())) == wanted
        assert sorted(map(str, read.collect())) == wanted
    finally:
        release_all()


def test_second_shuffle_carries_the_key_as_bytes(spark, monkeypatch):
    keys = ["0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "00" * 16, "0123456789abcdef" * 2 + "\n", "abc", "", None]
    hospitals = spark.createDataFrame([(str(i), k) for i, k in enumerate(keys)], "ccn string, hospital_key string")
    drgs = spark.createDataFrame([("d", "k")], "drg_code string, drg_key string")
    rows = spark.range(len(keys) + 1).select(F.col("id").cast("string").alias("ccn"), F.lit("d").alias("drg_code"))
    seen, join = [], facts.pruned_join
    monkeypatch.setattr(facts, "pruned_join", lambda j, *a: seen.append(dict(j.dtypes)) or join(j, *a))
    got = {r.ccn: r.hospital_key for r in facts.star_rows(rows, hospitals, drgs, False, False).collect()}
    assert got == {str(i): k for i, k in enumerate(keys)}
    assert seen[1].get("__bytes") == "binary" and "hospital_key" not in seen[1]


def _joined_rows(wh, monkeypatch):
    """Sides that the star joins, by call."""
    seen, star = [], marts.mart_reimbursement_gap_star
    monkeypatch.setattr(marts, "mart_reimbursement_gap_star",
                        lambda medicare, hospitals, drgs, *small: seen.append((hospitals.count(), drgs.count(), *small))
                        or star(medicare, hospitals, drgs, *small))
    return seen


def test_rows_of_few_groups_join_their_sides_only(spark, monkeypatch):
    frames = _frames(spark)
    wh = _warehouse(frames, 100)
    wh.persist_dims = True
    seen = _joined_rows(wh, monkeypatch)
    groups = spark.createDataFrame([("1", "M2"), ("2", None), ("2", "M3"), (None, "M1")],
                                   "service_line string, metro_name string")
    try:
        wanted = sorted(map(str, (r for r in wh.mart_reimbursement_gap.collect()
                                  if (r.service_line, r.metro_name) in {("1", "M2"), ("2", None), ("2", "M3")})))
        assert len(wanted) > 50
        assert sorted(map(str, wh.gap_rows_of(groups.where("service_line = '1'")).collect())) \
            == [r for r in wanted if "metro_name='M2'" in r]
        assert sorted(map(str, wh.gap_rows_of(groups).collect())) == wanted
        (h, d, *large), (few_h, few_d, *small), _ = seen
        assert large == [False, False] and small == [True, True]        # the rows of a group are not shuffled
        assert few_h < h / 3 and few_d < d / 3
        # a mart that is written or kept is read
        wh.mart_reimbursement_gap = wh.mart_reimbursement_gap.select("*")
        assert sorted(map(str, wh.gap_rows_of(groups).collect())) == wanted
        assert len(seen) == 3
    finally:
        release_all()


def test_finance_measures_are_pruned(spark):
    """The fact is not kept whole: a query carries the measures it reads."""
    wh = _warehouse(_frames(spark), 20)
    wh.persist_dims = True
    flags = wh.fct_hospital_finance.select("hospital_key", "is_ccr_outlier")
    assert "total_assets" not in flags._jdf.queryExecution().optimizedPlan().toString()


def test_lines_of_large_dimensions_ride_on_the_keys(spark):
    frames = _frames(spark)
    small, wh = _warehouse(frames, 200_000), _warehouse(frames, 20)
    wh.persist_dims = True
    try:
        large = wh.fct_medicare_drg_with_line
        assert _inner_joins(large._jdf.queryExecution().optimizedPlan()) == 2
        wanted = small.fct_medicare_drg_with_line
        assert large.columns == wanted.columns
        assert sorted(map(str, large.collect())) == sorted(map(str, wanted.collect()))
        few = rows_of(large, wh.dim_drg, F.col("drg_code") == "7", False)
        assert "ResolvedHint (strategy=broadcast)" in few._jdf.queryExecution().analyzed().toString()
    finally:
        release_all()


def test_measures_join_narrow_sides_by_broadcast(spark, monkeypatch):
    frames = _frames(spark)
    seen, star = [], marts.gap_measures_star
    monkeypatch.setattr(marts, "gap_measures_star", lambda medicare, hospitals, drgs, *small: seen.append(
        (*hospitals.columns, *drgs.columns, *small)) or star(medicare, hospitals, drgs, *small))
    columns = ("ccn", "metro_name", "cost_to_charge_ratio", "drg_code", "service_line")
    try:
        small = _warehouse(frames, 200_000)
        wanted = sorted(map(str, small.mart_reimbursement_gap.select(marts.GAP_MEASURES).collect()))
        assert sorted(map(str, small.gap_measures.collect())) == wanted and not seen
        groups = sorted(map(str, small.service_line_groups.collect()))
        # dimensions over the bound whose few columns are not, and such that are over it all the same
        for bound, narrow in ((100, True), (20, False)):
            wh = _warehouse(frames, bound)
            wh.persist_dims = True
            assert sorted(map(str, wh.gap_measures.collect())) == wanted
            assert sorted(map(str, wh.service_line_groups.collect())) == groups
            assert wh._bounds["dim_hospital"] is wh._bounds["dim_drg"] is False
            assert seen.pop() == (*columns, narrow, narrow) and not seen
        # a mart that is written or kept is read
        wh = _warehouse(frames, 100)
        wh.mart_reimbursement_gap = small.mart_reimbursement_gap
        assert sorted(map(str, wh.gap_measures.collect())) == wanted and not seen
    finally:
        release_all()


def _files_hold_their_buckets(table, n):
    """Buckets of a written table with more than one file or a row of another bucket."""
    file = F.input_file_name()
    at = table.select(file.alias("file"), F.regexp_extract(file, r"_(\d{5})\.c", 1).cast("int").alias("at"),
                      F.pmod(F.hash("hospital_key"), F.lit(n)).alias("bucket"))
    return at.groupBy("at").agg(F.count_distinct("file").alias("files"), F.count_if(F.col("at") != F.col("bucket")).alias("astray")) \
        .where("files > 1 OR astray > 0").count()


def test_mart_of_a_written_fact_goes_to_its_drgs_and_back(spark, tmpdir_path):
    frames, run = _frames(spark), new_run_id()
    wanted = sorted(map(str, _warehouse(frames, 200_000).mart_reimbursement_gap.collect()))
    wh = _warehouse(frames, 20)
    wh.persist_dims = True

    def written(name, df):
        return materialize(spark, df, tmpdir_path, name, run, bucket_by=(4, ["hospital_key"]), database=f"gap_{run}",
                           dealt=True)[0]

    try:
        fact = written("fact", dealt_packed(wh.fct_medicare_drg, 4, "hospital_key", ["hospital_key", "drg_key"]))
        assert sorted(map(str, fact.collect())) == sorted(map(str, wh.fct_medicare_drg.collect()))
        assert _files_hold_their_buckets(fact, 4) == 0
        wh.fct_medicare_drg, wh.buckets = fact, 4
        gap = wh.mart_reimbursement_gap
        assert wh.dealt == {"mart_reimbursement_gap"} and gap.columns == marts.GAP_COLUMNS
        mart = written("gap", gap)
        assert sorted(map(str, mart.collect())) == wanted
        assert _files_hold_their_buckets(mart, 4) == 0
    finally:
        release_all()


def _shuffled_rows(df):
    """Largest numbers of rows that the exchanges of a collected plan wrote, none of them of a dimension."""
    def walk(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(plan.plan())
        own = [plan.metrics().apply("shuffleRecordsWritten").value()] if name == "ShuffleExchangeExec" else []
        children = plan.children()
        return own + [n for i in range(children.size()) for n in walk(children.apply(i))]
    df.collect()
    return sum(n > 2_000 for n in walk(df._jdf.queryExecution().executedPlan()))


def test_fact_of_large_dimensions_is_shuffled_twice_on_its_way_to_the_buckets(spark, tmpdir_path):
    frames, run = _frames(spark), new_run_id()
    frames["dim_drg"] = frames["dim_drg"].withColumn("drg_key", F.md5("drg_code"))
    wanted = sorted(map(str, _warehouse(frames, 200_000).fct_medicare_drg.collect()))
    frames["dim_hospital"] = materialize(spark, frames["dim_hospital"], tmpdir_path, "hospital", run,
                                         bucket_by=(4, ["hospital_key"]), database=f"fact_{run}")[0]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wh = _warehouse(frames, 20)
        wh.buckets = 4
        fact = wh.fct_medicare_drg
        assert wh.dealt == {"fct_medicare_drg"} and sorted(map(str, fact.collect())) == wanted != []
        assert _shuffled_rows(fact) == 2
        written = materialize(spark, fact, tmpdir_path, "fact", run, bucket_by=(4, ["hospital_key"]),
                              database=f"fact_{run}", dealt=True)[0]
        assert sorted(map(str, written.collect())) == wanted and _files_hold_their_buckets(written, 4) == 0
        # keys that are not made of the codes are looked up first
        other = _warehouse(frames | {"dim_drg": frames["dim_drg"].withColumn("drg_key", F.col("drg_code"))}, 20)
        other.buckets = 4
        assert {r.drg_key for r in other.fct_medicare_drg.collect()} <= set(map(str, range(300))) and not other.dealt
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        release_all()


def test_texts_come_back_from_key_bytes(spark):
    keys = ["0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "00" * 16, "abc", "", "\0" * 16, "x" * 16, "é", None]
    rows = spark.createDataFrame([(k,) for k in keys], "k string").withColumn("b", key_bytes("k"))
    got = rows.withColumn("back", key_text("b")).collect()
    assert [r.back for r in got] == keys and len({bytes(r.b) for r in got if r.b is not None}) == len(keys) - 1


def test_rows_are_dealt_by_the_text_of_their_key(spark):
    keys = ["0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "00" * 16, "0123456789abcdef" * 2 + "\n", "abc", "", None]
    rows = spark.createDataFrame([(k, other, i) for i, k in enumerate(keys) for other in keys],
                                 "hospital_key string, drg_key string, n int")
    dealt = dealt_packed(rows, 5, "hospital_key", ["hospital_key", "drg_key"])
    assert dealt.schema == rows.schema
    assert sorted(map(str, dealt.collect())) == sorted(map(str, rows.collect()))
    assert dealt.where(F.spark_partition_id() != F.pmod(F.hash("hospital_key"), F.lit(5))).count() == 0

"""Publication, leases and retirement of runs."""

import os
import time
from concurrent.futures import ThreadPoolExecutor

import pytest

from wardmart.plans import etl
from wardmart.plans.build import VIEWS, build_all
from wardmart.plans.warehouse import Warehouse
from wardmart.sources import NotPublished, begin, entry_of, materialize, new_run_id, publish, retire, snapshot
from wardmart.sources.sinks import CLEANUP

from test_warehouse_e2e import census, cost_report, crosswalk, hospitals, medicare, seed


def run(spark, root, rows, names=("a", "b"), bucket=None):
    """Write tables of ``rows`` rows each and return (run id, entries)."""
    run_id, entries = new_run_id(), {}
    begin(spark, root, run_id)
    for name in names:
        df, metrics = materialize(spark, spark.range(rows).withColumnRenamed("id", "k"), root, name, run_id,
                                  bucket_by=bucket)
        entries[name] = entry_of(df, root, name, run_id, metrics, bucket)
    return run_id, entries


def there(root, name="a"):
    return {d.removeprefix("run=") for d in os.listdir(os.path.join(root, name))}


def test_readers_see_whole_versions_and_leases_keep_them(spark, tmpdir_path):
    with pytest.raises(NotPublished):
        snapshot(spark, tmpdir_path)
    runs = [run(spark, tmpdir_path, n) for n in (1, 2, 3, 4)]
    first = None
    for n, (run_id, entries) in enumerate(runs, 1):
        assert publish(spark, tmpdir_path, run_id, entries) == n
        now = snapshot(spark, tmpdir_path)
        assert [now.table(t).count() for t in ("a", "b")] == [n, n]
        first = first or now
        if now is not first:
            now.release()
    ids = [r for r, _ in runs]
    # the first version is leased, the second is not, two are kept
    assert retire(spark, tmpdir_path) == ids[1:2]
    assert there(tmpdir_path) == {ids[0], ids[2], ids[3]} and first.table("a").count() == 1
    with pytest.raises(NotPublished):
        snapshot(spark, tmpdir_path, version=1)
    assert retire(spark, tmpdir_path) == []
    first.release()
    assert retire(spark, tmpdir_path) == ids[:1]
    assert retire(spark, tmpdir_path, keep=1) == ids[2:3] and there(tmpdir_path) == {ids[3]}


def test_shuffle_files_go_as_a_table_is_written(spark, tmpdir_path):
    def files():
        env = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {f for f in env.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}

    df, before, setting = spark.range(1_000).repartition(5, "id"), files(), spark.conf.get(CLEANUP, None)
    with ThreadPoolExecutor(2) as pool:
        pool.submit(materialize, spark, df, tmpdir_path, "a", "r1").result()
        list(pool.map(lambda bucket, name: materialize(spark, df, tmpdir_path, name, "r2", bucket_by=bucket),
                      [None, (4, ["id"])], ["b", "c"]))
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(CLEANUP, None) == setting
    assert [spark.read.parquet(f"{tmpdir_path}/{t}/run={r}").count() for t, r in (("a", "r1"), ("b", "r2"), ("c", "r2"))] \
        == [1_000] * 3 == [df.count()] * 3


def test_a_lease_that_ran_out_holds_nothing(spark, tmpdir_path):
    for n in (1, 2):
        publish(spark, tmpdir_path, *run(spark, tmpdir_path, n))
        snapshot(spark, tmpdir_path, seconds=100)
    assert retire(spark, tmpdir_path, keep=1) == []
    assert len(retire(spark, tmpdir_path, keep=1, now=time.time() + 200)) == 1


def test_unpublished_runs_stay_while_their_builder_lives(spark, tmpdir_path):
    old, _ = run(spark, tmpdir_path, 1)
    published = run(spark, tmpdir_path, 2)
    publish(spark, tmpdir_path, *published)
    unannounced = new_run_id()
    materialize(spark, spark.range(3), tmpdir_path, "a", unannounced)
    assert retire(spark, tmpdir_path) == []
    # a day later the builder's lease has run out; the published run stays
    assert retire(spark, tmpdir_path, now=time.time() + 2 * 86400) == [old]
    assert there(tmpdir_path) == {published[0], unannounced}
    with snapshot(spark, tmpdir_path) as s:
        assert s.table("b").count() == 2


def test_a_version_that_goes_while_a_reader_arrives(spark, tmpdir_path, monkeypatch):
    from wardmart.sources import publication as P
    for n in (1, 2):
        publish(spark, tmpdir_path, *run(spark, tmpdir_path, n))
    real, calls = P.versions, []

    def late(store):
        calls.append(1)
        # the reader's list is stale once: version 1 looks like the newest
        return [1] if len(calls) == 1 else real(store)
    retire(spark, tmpdir_path, keep=1)
    monkeypatch.setattr(P, "versions", late)
    with snapshot(spark, tmpdir_path) as s:
        assert s.version == 2 and s.table("a").count() == 2


def test_publications_at_the_same_time_get_their_own_versions(spark, tmpdir_path):
    runs = [run(spark, tmpdir_path, n, names=("a",)) for n in range(1, 6)]
    with ThreadPoolExecutor(5) as pool:
        got = list(pool.map(lambda r: publish(spark, tmpdir_path, *r), runs))
    assert sorted(got) == [1, 2, 3, 4, 5]
    with snapshot(spark, tmpdir_path) as s:
        assert s.manifest.run_id == runs[got.index(5)][0]


def test_a_run_that_lost_rows_is_not_published(spark, tmpdir_path):
    run_id, entries = run(spark, tmpdir_path, 5)
    entries["a"].rows = 6
    with pytest.raises(NotPublished, match="6 rows were written, 5 are there"):
        publish(spark, tmpdir_path, run_id, entries)
    with pytest.raises(NotPublished):
        snapshot(spark, tmpdir_path)


def test_bound_names_follow_the_publications_and_know_their_buckets(spark, tmpdir_path):
    database = "wardmart_bound_" + new_run_id()
    for n in (10, 20):
        publish(spark, tmpdir_path, *run(spark, tmpdir_path, n, bucket=(3, ["k"])),
                views={"both": "SELECT k FROM {a} JOIN {b} USING (k)"})
        snapshot(spark, tmpdir_path).bind(database)
        reader = spark.newSession()
        reader.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        reader.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        assert reader.table(f"{database}.a").count() == n
        joined = reader.table(f"{database}.both")
        assert joined.count() == n
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


def raw_tables(spark):
    raw = {"hospital_general_info": hospitals(spark), "cost_report": cost_report(spark),
           "medicare_inpatient": medicare(spark), "zip_cbsa_crosswalk": crosswalk(spark),
           "census_acs": census(spark).where("NAME <> 'Gallup'")}
    return {k: etl.apply_load_rules(k, v) for k, v in raw.items()}


def warehouse(raw, spark):
    return Warehouse(raw, seed(spark), cost_tie_break=("Report Record Number",), min_volume=30)


def test_a_failed_build_leaves_the_old_rows_visible(spark, tmpdir_path):
    out = build_all(spark, warehouse(raw_tables(spark), spark), root=tmpdir_path, publish=True,
                    tables=["dim_drg", "dim_geography"])
    assert out["version"] == 1 and all(r["status"] != "fail" for r in out["tests"])
    # a test of error severity fails: one CBSA twice
    raw = raw_tables(spark)
    raw["census_acs"] = raw["census_acs"].unionByName(raw["census_acs"])
    with pytest.raises(AssertionError, match="dim_geography"):
        build_all(spark, warehouse(raw, spark), root=tmpdir_path, publish=True, tables=["dim_drg", "dim_geography"])
    # the build dies between two tables
    raw = raw_tables(spark)
    raw["zip_cbsa_crosswalk"] = raw["zip_cbsa_crosswalk"].selectExpr("geoid", "cbsa", "assert_true(false) AS res_ratio")
    with pytest.raises(Exception):
        build_all(spark, warehouse(raw, spark), root=tmpdir_path, publish=True, tables=["dim_drg", "dim_geography"])
    with snapshot(spark, tmpdir_path) as s:
        assert s.version == 1 and s.table("dim_geography").count() == 1 and s.table("dim_drg").count() == 4


def test_published_staging_views_equal_the_models(spark, tmpdir_path):
    wh = warehouse(raw_tables(spark), spark)
    build_all(spark, wh, root=tmpdir_path, publish=True, tables=[])
    database = "wardmart_views_" + new_run_id()
    snapshot(spark, tmpdir_path).bind(database)
    reader = spark.newSession()
    plain = warehouse(raw_tables(spark), spark)
    for name in VIEWS:
        view = reader.table(f"{database}.{name}")
        assert view.dtypes == plain.model(name).dtypes, name
        assert sorted(map(str, view.collect())) == sorted(map(str, plain.model(name).collect())), name


def test_reports_survive_later_builds(spark, tmpdir_path):
    reports = [build_all(spark, warehouse(raw_tables(spark), spark), root=tmpdir_path, enforce=False,
                         tables=["dim_drg"])["report"] for _ in range(4)]
    retire(spark, tmpdir_path, keep=1)
    assert [r.count() for r in reports] == [reports[0].count()] * 4

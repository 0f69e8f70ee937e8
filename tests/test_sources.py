import os

import pytest
from pyspark.sql import functions as F

from wardmart.operators import has_at_most
from wardmart.sources import audit_counts, date_spine, materialize, new_run_id, scan_csv


def test_scan_csv_keeps_id_text_and_nulls_na_tokens(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "hospital.csv")
    with open(path, "w") as f:
        f.write("Facility ID,ZIP Code,Number of Beds,Hospital overall rating,Note\n")
        f.write("10005,01234,25,4,ok\n")
        f.write(" 010001 ,00501,NA,Not Available,N/A\n")
        f.write("1234567,,null,,\n")
    df = scan_csv(spark, path, types={"Number of Beds": "double"},
                  pad_columns={"Facility ID": 6})
    rows = df.collect()
    assert [r["Facility ID"] for r in rows] == ["010005", "010001", "1234567"]
    assert [r["ZIP Code"] for r in rows] == ["01234", "00501", None]
    assert [r["Number of Beds"] for r in rows] == [25.0, None, None]
    # 'Not Available' is not an NA token: it stays text for the sentinel rule
    assert [r["Hospital overall rating"] for r in rows] == ["4", "Not Available", None]
    assert [r["Note"] for r in rows] == ["ok", None, None]
    assert df.columns == ["Facility ID", "ZIP Code", "Number of Beds", "Hospital overall rating", "Note"]


def test_materialize_writes_run_folder_and_audits_in_same_pass(spark, tmpdir_path):
    df = spark.createDataFrame([("a", None), ("b", "x"), ("c", None)], "k string, cbsa string")
    out, metrics = materialize(spark, df, tmpdir_path, "hospital_geo", new_run_id(),
                               audit_nulls=["cbsa"])
    assert out.count() == 3
    assert metrics["row_count"] == 3 and metrics["null_cbsa"] == 2
    a = audit_counts(df, ["cbsa"]).collect()[0]
    assert (a["row_count"], a["null_cbsa"]) == (3, 2)


def test_date_spine_end_exclusive(spark):
    days = date_spine(spark, "2022-10-01", "2024-10-01")
    assert days.count() == 731
    first, last = days.agg({"date_day": "min"}).collect()[0][0], days.agg({"date_day": "max"}).collect()[0][0]
    assert str(first) == "2022-10-01" and str(last) == "2024-09-30"
    assert date_spine(spark, "2024-01-01", "2024-01-01").count() == 0


def test_odd_column_names_survive_scan_and_rename(spark, tmpdir_path):
    from wardmart.operators import clean_in_place, rename_project
    from wardmart.functions import squash_upper
    path = os.path.join(tmpdir_path, "cost.csv")
    with open(path, "w") as f:
        f.write('Provider CCN,Combined Outpatient + Inpatient Total Charges,'
                'Number of Interns and Residents (FTE),City/Town,"Weird `tick"\n')
        f.write("10001,1234.5,2.5, st paul ,x\n")
    df = scan_csv(spark, path, types={"Combined Outpatient + Inpatient Total Charges": "double",
                                      "Number of Interns and Residents (FTE)": "double"},
                  pad_columns={"Provider CCN": 6})
    out = rename_project(df, [("Provider CCN", "ccn"),
                              ("Combined Outpatient + Inpatient Total Charges", "total_charges"),
                              ("Number of Interns and Residents (FTE)", "interns_residents_fte"),
                              ("Weird `tick", "weird")]).collect()[0]
    assert (out.ccn, out.total_charges, out.interns_residents_fte, out.weird) == ("010001", 1234.5, 2.5, "x")
    cleaned = clean_in_place(df, {"City/Town": squash_upper})
    assert cleaned.columns == df.columns and cleaned.collect()[0]["City/Town"] == "STPAUL"


def test_integer_columns_accept_integral_decimal_text(spark, tmpdir_path):
    import pytest
    path = os.path.join(tmpdir_path, "m.csv")
    with open(path, "w") as f:
        f.write("ccn,n\n1,40.0\n2,\n3,7\n")
    df = scan_csv(spark, path, types={"n": "bigint"})
    assert [r.n for r in df.collect()] == [40, None, 7]
    with open(path, "w") as f:
        f.write("ccn,n\n1,40.5\n")
    with pytest.raises(Exception):
        scan_csv(spark, path, types={"n": "bigint"}).collect()


def test_csv_quotes_line_breaks_and_backslashes(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "quoted.csv")
    with open(path, "w", newline="") as f:
        f.write('id,name,note\r\n1,"ST ""MARY"" HOSP","a\nb"\r\n2,"a\\",x\r\n')
    got = {r.id: r for r in scan_csv(spark, path, multiline=True).collect()}
    assert got["1"].name == 'ST "MARY" HOSP' and got["1"].note == "a\nb"
    assert got["2"].name == "a\\" and got["2"].note == "x"


def test_csv_malformed_record_raises(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "short.csv")
    with open(path, "w") as f:
        f.write("id,name\n1,a\n2\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        scan_csv(spark, path).collect()


def test_bucketed_table_has_one_file_a_bucket(spark, tmpdir_path):
    df = spark.range(1000).repartition(8).withColumnRenamed("id", "k")
    materialize(spark, df, tmpdir_path, "bucketed", new_run_id(), bucket_by=(4, ["k"]),
                database="wardmart_test_" + new_run_id())
    files = [f for _, _, names in os.walk(os.path.join(tmpdir_path, "bucketed")) for f in names
             if f.endswith(".parquet")]
    assert len(files) <= 4


def test_broadcast_check_merges_one_row_a_task(spark):
    df = spark.range(10_000).withColumn("s", F.repeat(F.lit("x"), 100))
    assert has_at_most(df, 10_000) and not has_at_most(df, 9_999)
    assert not has_at_most(df, 10_000, max_bytes=1000)
    assert has_at_most(df.limit(0), 0)

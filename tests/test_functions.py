import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from wardmart.functions import (calendar_columns, date_key, guarded_ratio, known_and_different,
                                pad_id, parse_date, range_flag, sentinel_to_null, squash_upper,
                                stable_round, sum_parts, surrogate_key)
from wardmart.functions.keys import NULL_TOKEN


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {typ}")


def test_pad_id_never_truncates_and_strips_all_whitespace(spark):
    df = one_col(spark, ["10005", " 010001 ", "\t123\t", "1234567", None, "-12", " " + "77"])
    got = [r[0] for r in df.select(pad_id("v", 6)).collect()]
    assert got == ["010005", "010001", "000123", "1234567", None, "-00012", "000077"]


def test_squash_upper(spark):
    df = one_col(spark, [" St. Clair ", "DE KALB", None])
    assert [r[0] for r in df.select(squash_upper("v")).collect()] == ["ST.CLAIR", "DEKALB", None]


def test_sentinel_cast(spark):
    df = one_col(spark, ["4", "Not Available", None])
    got = [r[0] for r in df.select(sentinel_to_null("v", "Not Available", "int")).collect()]
    assert got == [4, None, None]


def test_sentinel_cast_rejects_other_junk(spark):
    df = one_col(spark, ["four"])
    with pytest.raises(Exception):
        df.select(sentinel_to_null("v", "Not Available", "int")).collect()


def test_parse_date_accepts_one_and_two_digit_parts(spark):
    df = one_col(spark, ["1/5/2023", "12/25/2023", "01/05/2023", None])
    got = [r[0] for r in df.select(parse_date("v")).collect()]
    assert got == [dt.date(2023, 1, 5), dt.date(2023, 12, 25), dt.date(2023, 1, 5), None]


def test_range_flag_three_valued(spark):
    df = one_col(spark, [-0.1, 0.0, 0.5, 1.0, 1.02, 71.3, None], "double")
    got = [r[0] for r in df.select(range_flag("v", 0.0, 1.0)).collect()]
    assert got == [True, False, False, False, True, True, None]


def test_known_and_different(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "b"), ("a", None)], "a string, b string")
    got = [r[0] for r in df.select(known_and_different("a", "b")).collect()]
    assert got == [False, True, None, None]


def test_guarded_ratio(spark):
    df = spark.createDataFrame([(5.0, 10.0), (5.0, 0.0), (5.0, -3.0), (5.0, None)], "n double, d double")
    got = [r[0] for r in df.select(guarded_ratio("n", "d")).collect()]
    assert got == [0.5, None, None, None]


def test_sum_parts_null_propagates(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (1.0, None, 3.0)], "a double, b double, c double")
    assert [r[0] for r in df.select(sum_parts("a", "b", "c")).collect()] == [6.0, None]


def test_surrogate_key_matches_macro_text(spark):
    df = spark.createDataFrame([("Cardiology", "X"), ("Cardiology", None), (None, None)],
                               "s string, m string")
    got = [r[0] for r in df.select(surrogate_key("s", "m")).collect()]

    def md5(parts):
        txt = "-".join(NULL_TOKEN if p is None else p for p in parts)
        return hashlib.md5(txt.encode()).hexdigest()
    assert got == [md5(["Cardiology", "X"]), md5(["Cardiology", None]), md5([None, None])]
    one = [r[0] for r in df.select(surrogate_key("m")).collect()]
    assert one[1] == hashlib.md5(NULL_TOKEN.encode()).hexdigest()


def test_stable_round_half_up_and_no_negative_zero(spark):
    df = one_col(spark, [2.5, -0.0000001, 68146.8465785, None], "double")
    got = [r[0] for r in df.select(stable_round("v", 0).alias("a"), stable_round("v", 6).alias("b"))
           .collect()]
    assert got[0] == 3.0 and str(got[1]) == "0.0" and got[3] is None


def test_calendar_columns(spark):
    df = spark.createDataFrame([(dt.date(2022, 10, 1),), (dt.date(2022, 10, 2),),
                                (dt.date(2024, 2, 29),), (dt.date(2024, 9, 30),)], "d date")
    rows = df.select(date_key("d").alias("k"), *calendar_columns("d")).collect()
    assert rows[0]["k"] == 20221001 and rows[0]["calendar_quarter"] == 4
    assert rows[1]["day_of_week"] == 0 and rows[1]["day_name"] == "Sunday"
    assert rows[2]["month_name"] == "February" and rows[2]["day_of_month"] == 29
    assert rows[3]["calendar_year"] == 2024 and rows[3]["day_of_week"] == 1
    assert F is not None


def test_stable_round_keeps_large_nan_and_null(spark):
    rows = [(1e14,), (1e17,), (5e17,), (float("nan"),), (None,), (-1e13,)]
    df = spark.createDataFrame(rows, "v double")
    got = [r[0] for r in df.select(stable_round("v", 6)).collect()]
    assert got[:3] == [1e14, 1e17, 5e17] and got[3] != got[3] and got[4] is None and got[5] == -1e13

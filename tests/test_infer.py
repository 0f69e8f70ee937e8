"""Inferred column types against the modelled loader's own reader."""

import io
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from wardmart.plans.load import load_raw_csv
from wardmart.sources import scan_csv
from wardmart.sources.infer import (BOOLEAN, FLOAT, INTEGER, MISSING, TEXT, class_rows, column_classes, merge_classes,
                                    resolve, value_class)

from test_warehouse_e2e import census, cost_report, crosswalk, hospitals, medicare

# dtype that pandas.read_csv arrives at -> Spark type; an object column of
# True, False and blanks is boolean in the database, one of text is text
KINDS = {"int64": "bigint", "float64": "double", "bool": "boolean"}
TOKENS = {
    "integer": ["1", "0012", "-7", "+5", " 3", "4 ", "9223372036854775807", "-9223372036854775808", "0"],
    "float": ["40.0", "1e5", ".5", "5.", "-2.5E-3", "inf", "-Infinity", "1.5 ", "1e308", "+inf", "0.1"],
    "boolean": ["True", "FALSE", "true", "tRue"],
    "text": ["x", "0x10", "1_000", "--1", "1e400", "99999999999999999999", "T", "1d", "- 1", "1e", "12-3", "true ",
             "1 2", "٣", "NaNs", "1,5"],
    "missing": ["", "NA", "NaN", "null", "N/A", "<NA>"],
}


def write(path, columns):
    rows = zip(*columns.values())
    with open(path, "w") as f:
        for row in [columns.keys(), *rows]:
            f.write(",".join(f'"{v}"' if "," in v else v for v in row) + "\n")


def expected(column):
    got = pd.read_csv(io.StringIO("k,a\n" + "\n".join(f'k,"{v}"' if v else "k," for v in column)))["a"]
    if str(got.dtype) in KINDS:
        return KINDS[str(got.dtype)]
    return "boolean" if pd.api.types.infer_dtype(got, skipna=True) == "boolean" else "string"


def test_types_are_those_of_the_modelled_reader(spark, tmpdir_path):
    rng = random.Random(2)
    columns = {}
    for i in range(120):
        kinds = rng.sample(list(TOKENS), rng.choice([1, 1, 2, 2, 3]))
        columns[f"c{i}"] = [rng.choice(TOKENS[rng.choice(kinds)]) for _ in range(9)]
    columns["k"] = ["k"] * 9        # no line is blank
    path = os.path.join(tmpdir_path, "mixed.csv")
    write(path, columns)
    df = scan_csv(spark, path, infer=True)
    got = dict(df.dtypes)
    assert {c: got[c] for c in columns} == {c: expected(v) for c, v in columns.items()}
    # and so are the values
    pdf, rows = pd.read_csv(path, float_precision="round_trip"), df.collect()
    for c in columns:
        for theirs, row in zip(pdf[c], rows):
            mine = row[c]
            assert (mine is None) == pd.isna(theirs)
            if mine is not None:
                assert str(mine).lower() == str(theirs).lower() if got[c] == "string" else mine == theirs


def test_the_named_cases(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "named.csv")
    write(path, {"beds": ["40.0", "", "7"], "zip": ["0012", "0501", "9"], "blank": ["", "NA", ""],
                 "flag": ["True", "", "False"], "kept": ["0012", "0501", "9"], "big": ["1", "99999999999999999999", "2"]})
    df = scan_csv(spark, path, str_columns=["kept"], infer=True)
    assert dict(df.dtypes) == {"beds": "double", "zip": "bigint", "blank": "double", "flag": "boolean",
                               "kept": "string", "big": "string"}
    assert [tuple(r) for r in df.collect()] == [(40.0, 12, None, True, "0012", "1"),
                                                (None, 501, None, None, "0501", "99999999999999999999"),
                                                (7.0, 9, None, False, "9", "2")]


def test_states_merge_over_splits_and_extracts(spark):
    a = spark.createDataFrame([("1", "True"), ("2", None)], "n string, f string")
    b = spark.createDataFrame([("2.5", None, "x")], "n string, f string, t string")
    states = [column_classes(d, d.columns) for d in (a, b)]
    merged = merge_classes(*states)
    assert {c: resolve(k) for c, k in merged.items()} == {"n": "double", "f": "boolean", "t": "string"}
    both = a.unionByName(b, allowMissingColumns=True)
    assert column_classes(both.repartition(5), both.columns) == merged
    assert resolve(column_classes(a.limit(0), ["n"])["n"]) == "double"


def test_raw_configs_give_the_declared_schema(spark, tmpdir_path):
    """The four raw files and the crosswalk, no measure type declared."""
    frames = {"hospital_general_info": hospitals(spark), "cost_report": cost_report(spark),
              "medicare_inpatient": medicare(spark), "zip_cbsa_crosswalk": crosswalk(spark),
              "census_acs": census(spark)}
    paths = {}
    for name, df in frames.items():
        paths[name] = os.path.join(tmpdir_path, f"{name}.csv")
        df.toPandas().to_csv(paths[name], index=False)
    loaded = load_raw_csv(spark, paths)
    for name, df in frames.items():
        want = {c: "bigint" if t == "int" else t for c, t in df.dtypes}
        if name == "medicare_inpatient":
            want["Tot_Dschrgs"] = "double"      # a count is missing
        assert dict(loaded[name].dtypes) == want, name
    declared = load_raw_csv(spark, paths, types={"medicare_inpatient": {"Tot_Dschrgs": "bigint"}})
    assert dict(declared["medicare_inpatient"].dtypes)["Tot_Dschrgs"] == "bigint"
    with pytest.raises(Exception):
        load_raw_csv(spark, paths, types={"hospital_general_info": {"State": "int"}})["hospital_general_info"].collect()


def test_one_expression_classes_all_columns(spark):
    """Code for each of 60 columns would be too large to be compiled."""
    names = [f"c{i}" for i in range(60)]
    wide = spark.range(3).select(*[F.col("id").cast("string").alias(n) for n in names])
    plan = class_rows(wide, names)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("bit_or") == 1 and plan.count("RLIKE") <= 2
    assert column_classes(wide, names) == {n: INTEGER for n in names}
    assert column_classes(wide.limit(0), names) == {n: MISSING for n in names}


def test_edges_of_numbers(spark):
    values = {"1.": FLOAT, ".5": FLOAT, ".": TEXT, "1.5e": TEXT, "\t+7 ": INTEGER, "-1.5E3\t": FLOAT, "1e400": TEXT,
              "9" * 19: TEXT, "9" * 400 + ".5": TEXT, "0" * 400 + ".5": FLOAT, "1 2": TEXT, "": TEXT, "-Inf": FLOAT,
              "item": TEXT, "TRUE": BOOLEAN, "+": TEXT, "1.2.3": TEXT, " true": TEXT, "12\n": INTEGER}
    rows = spark.createDataFrame([(v, k) for v, k in values.items()], "v string, k int")
    wrong = [r for r in rows.select("v", "k", value_class("v").alias("got")).collect() if r.k != r.got]
    assert not wrong

import pytest

from wardmart.operators import quality as Q


def test_checks_fail_and_pass(spark):
    df = spark.createDataFrame([("a", "Oncology", 0.5), ("a", "Bogus", None), (None, None, 3.0)],
                               "k string, line string, ccr double")
    assert Q.not_null(df, "k").count() == 1
    assert Q.unique(df, "k").count() == 1            # 'a' twice; NULL ignored
    assert Q.unique_combination(df, ["k", "line"]).count() == 0
    assert [r.value_field for r in Q.accepted_values(df, "line", ["Oncology"]).collect()] == ["Bogus"]
    assert Q.out_of_range(df, "ccr", 0, 1).count() == 1
    parent = spark.createDataFrame([("a",)], "k string")
    child = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert [r.from_field for r in Q.relationships(child, "k", parent, "k").collect()] == ["b"]


def test_scoped_not_null(spark):
    df = spark.createDataFrame([(True, None), (False, None), (True, 3)], "meets boolean, r int")
    assert Q.not_null(df, "r", where="meets").count() == 1


def test_report_and_severity(spark):
    df = spark.createDataFrame([(1, None), (2, 0.5)], "k int, ccr double")
    checks = [Q.Check("nn_k", "m", "not_null", Q.not_null(df, "k")),
              Q.Check("nn_ccr", "m", "not_null", Q.not_null(df, "ccr"), "warn")]
    rows = {r.check_name: r for r in Q.quality_report(checks).collect()}
    assert rows["nn_k"].status == "pass" and rows["nn_ccr"].status == "warn"
    assert rows["nn_ccr"].failing_rows == 1
    Q.enforce(Q.quality_report(checks))           # warn does not raise
    bad = checks + [Q.Check("uniq", "m", "unique", Q.unique(df.unionByName(df), "k"))]
    with pytest.raises(AssertionError):
        Q.enforce(Q.quality_report(bad))


def test_identity_dependency_and_order(spark):
    df = spark.createDataFrame([("1", 100.0, 150.0, 50.0, "A"), ("1", 10.0, 15.0, 4.0, "a"),
                                ("2", 1.0, 1.0, 0.0, "B")],
                               "ccn string, net double, total double, allow double, name string")
    s = Q.identity_summary(df, "net", [("total", 1), ("allow", -1)]).collect()[0]
    assert (s.rows_checked, s.rows_failing) == (3, 1)
    assert [r.ccn for r in Q.dependency_fails(df, "ccn", ["name"]).collect()] == ["1"]
    o = Q.order_summary(df, "net", "total").collect()[0]
    assert (o.rows_checked, o.rows_failing) == (3, 0)

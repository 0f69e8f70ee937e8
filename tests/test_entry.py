import __spark_entry__ as E
from wardmart.plans import catalogue


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["service_line_margin_key", "service_line", "metro_name", "avg_margin",
                          "total_medicare_payment", "total_derived_cost", "total_discharge_volume",
                          "meets_volume_threshold", "global_rank", "metro_rank"]


def test_every_query_has_oracle_sql():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(catalogue.oracle_sql()) == set(catalogue.queries())
    assert set(catalogue.queries()) <= set(E.queries())

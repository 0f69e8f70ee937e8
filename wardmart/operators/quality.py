"""Declarative data-quality checks.

Each check is a lazy DataFrame of failing rows, as the warehouse's tests
define them. ``quality_report`` turns a list of checks into one small
DataFrame (one row per check) computed in a single Spark job; ``enforce``
raises only for failing checks of severity ``error``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col_of
from .joins import orphans


@dataclass
class Check:
    """One test. ``failing`` holds the failing rows. Row-level tests also
    give ``source`` and ``predicate`` (failing-row condition), and
    uniqueness tests give ``source`` and ``unique_col``, so the report can
    evaluate many tests over one model in a single pass."""
    name: str
    model: str
    test: str
    failing: DataFrame
    severity: str = "error"
    source: DataFrame | None = None
    predicate: Column | None = None
    unique_col: str | None = None


def _scoped(df: DataFrame, where) -> DataFrame:
    if where is None:
        return df
    return df.where(F.expr(where) if isinstance(where, str) else where)


def not_null(df: DataFrame, col: str, where=None) -> DataFrame:
    """Rows where ``col`` is NULL (optionally only within ``where``)."""
    return _scoped(df, where).where(col_of(col).isNull())


def null_profile(df: DataFrame, cols: list[str], where=None) -> DataFrame:
    """NULL counts of many columns in one aggregate pass (one row)."""
    return _scoped(df, where).agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(col_of(c).isNull()).alias(f"null_{c}") for c in cols])


def unique(df: DataFrame, col: str, where=None) -> DataFrame:
    """Values of ``col`` that occur more than once (NULLs are ignored)."""
    d = _scoped(df, where).where(col_of(col).isNotNull())
    return d.groupBy(col_of(col).alias("unique_field")) \
        .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def unique_combination(df: DataFrame, cols: list[str], where=None) -> DataFrame:
    """Key combinations occurring more than once (NULLs group together)."""
    return _scoped(df, where).groupBy(*[col_of(c) for c in cols]) \
        .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def accepted_values(df: DataFrame, col: str, values: list, where=None) -> DataFrame:
    """Distinct values outside the accepted list with their counts; NULL passes."""
    d = _scoped(df, where)
    return d.where(~col_of(col).isin(list(values))) \
        .groupBy(col_of(col).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))


def relationships(child: DataFrame, col: str, parent: DataFrame, field: str,
                  where=None) -> DataFrame:
    """Non-NULL child keys with no parent row."""
    return orphans(_scoped(child, where).select(col_of(col).alias("from_field")),
                   "from_field", parent, field)


def expression_fails(df: DataFrame, condition, where=None) -> DataFrame:
    """Rows meeting a failure condition (singular assertions)."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    return _scoped(df, where).where(cond)


def out_of_range(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Known values outside [lo, hi]."""
    c = col_of(col)
    return df.where(c.isNotNull() & ((c < lo) | (c > hi)))


def identity_summary(df: DataFrame, total: str, parts: list[tuple[str, int]],
                     tolerance: float = 0.005) -> DataFrame:
    """One row: rows where every term is known, and how many of those break
    ``total = sum(sign x part)`` by more than ``tolerance``."""
    expr = reduce(lambda a, b: a + b, [col_of(c) * F.lit(s) for c, s in parts])
    known = reduce(lambda a, b: a & b, [col_of(c).isNotNull() for c, _ in parts] +
                   [col_of(total).isNotNull()])
    return df.agg(F.count_if(known).alias("rows_checked"),
                  F.count_if(known & (F.abs(col_of(total) - expr) > F.lit(tolerance)))
                  .alias("rows_failing"))


def order_summary(df: DataFrame, smaller: str, larger: str) -> DataFrame:
    """One row: rows with both values known, and rows where ``smaller``
    exceeds ``larger``."""
    a, b = col_of(smaller), col_of(larger)
    return df.agg(F.count_if(a.isNotNull() & b.isNotNull()).alias("rows_checked"),
                  F.count_if(a > b).alias("rows_failing"))


def dependency_fails(df: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """Keys whose attribute tuple is not constant (functional dependency).

    Two grouping passes (key+attrs, then key) treat NULL attributes as
    values and never hold a group's rows together in memory.
    """
    per_tuple = df.groupBy(col_of(key), *[col_of(a) for a in attrs]).agg(F.lit(1).alias("__one"))
    return per_tuple.groupBy(col_of(key)).agg(F.count(F.lit(1)).alias("n_variants")) \
        .where(F.col("n_variants") > 1)


def _meta(c: Check, failing: Column) -> Column:
    return F.struct(F.lit(c.name).alias("check_name"), F.lit(c.model).alias("model"),
                    F.lit(c.test).alias("test"), F.lit(c.severity).alias("severity"),
                    failing.cast("long").alias("failing_rows"))


def quality_report(checks: list[Check]) -> DataFrame:
    """One row per check: name, model, test, severity, failing_rows, status.

    * row-level tests (not_null, expressions) over the same model share one
      aggregate pass: one ``count_if`` per test;
    * uniqueness tests over the same model share one grouping: the tested
      columns are unpivoted to (test, value) pairs, grouped once, and the
      duplicated values counted per test;
    * every other test is counted on its own.
    The branches are unioned into one small DataFrame.
    """
    row_level: dict[int, list[Check]] = {}
    uniques: dict[int, list[Check]] = {}
    parts = []
    for c in checks:
        if c.source is not None and c.predicate is not None:
            row_level.setdefault(id(c.source), []).append(c)
        elif c.source is not None and c.unique_col is not None:
            uniques.setdefault(id(c.source), []).append(c)
        else:
            parts.append(c.failing.agg(F.count(F.lit(1)).alias("n"))
                         .select(F.inline(F.array(_meta(c, F.col("n"))))))
    for group in row_level.values():
        agg = group[0].source.agg(*[F.count_if(c.predicate).alias(f"n{i}")
                                    for i, c in enumerate(group)])
        parts.append(agg.select(F.inline(F.array(*[_meta(c, F.col(f"n{i}"))
                                                   for i, c in enumerate(group)]))))
    for group in uniques.values():
        src = group[0].source
        pairs = F.explode(F.array(*[
            F.struct(F.lit(i).alias("t"), col_of(c.unique_col).cast("string").alias("v"))
            for i, c in enumerate(group)]))
        dup = src.select(pairs.alias("p")).select("p.t", "p.v").where(F.col("v").isNotNull()) \
            .groupBy("t", "v").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > 1)
        per = dup.agg(*[F.count_if(F.col("t") == i).alias(f"n{i}") for i in range(len(group))])
        parts.append(per.select(F.inline(F.array(*[_meta(c, F.col(f"n{i}"))
                                                   for i, c in enumerate(group)]))))
    report = reduce(lambda a, b: a.unionByName(b), parts)
    status = F.when(F.col("failing_rows") == 0, F.lit("pass")) \
        .when(F.col("severity") == "warn", F.lit("warn")).otherwise(F.lit("fail"))
    return report.withColumn("status", status)


def enforce(report: DataFrame) -> list:
    """Collect the (small, one row per check) report; raise on error failures."""
    rows = report.collect()
    failed = [r for r in rows if r["status"] == "fail"]
    if failed:
        names = ", ".join(f"{r['check_name']} ({r['failing_rows']})" for r in failed)
        raise AssertionError(f"data tests failed: {names}")
    return rows

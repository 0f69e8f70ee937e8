"""Joins: size-checked lookup joins, composite null-safe keys, orphans.

Broadcast policy: a side is broadcast only after a count proves that it holds
at most ``max_broadcast_rows`` rows of bounded size. Beyond that the join stays a
shuffle join, which AQE may still turn into a broadcast from runtime sizes
or split when a key is skewed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col_of, quote
# ~200k dimension rows of a few hundred bytes stay well under executor memory
# on every node; anything larger is joined by shuffle.
DEFAULT_BROADCAST_ROWS = 200_000
DEFAULT_BROADCAST_BYTES = 64 << 20


def _bytes_of_row(df: DataFrame) -> Column:
    """Rough width of a row: text and binary by length, 8 bytes a value else."""
    width = F.lit(0)
    for name, kind in df.dtypes:
        width = width + (F.coalesce(F.octet_length(col_of(name)), F.lit(0))
                         if kind in ("string", "binary") else F.lit(8))
    return width


def have_at_most(frames: dict[str, DataFrame], max_rows: int,
                 max_bytes: int = DEFAULT_BROADCAST_BYTES) -> dict[str, bool]:
    """Which frames hold at most ``max_rows`` rows and ``max_bytes`` bytes.

    One job; every task sums up its own rows, and one row a task is merged.
    """
    parts = [df.agg(F.count(F.lit(1)).alias("n"), F.sum(_bytes_of_row(df).cast("bigint")).alias("b"))
             .select(F.lit(name).alias("name"), "n", "b") for name, df in frames.items()]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return {r["name"]: r["n"] <= max_rows and (r["b"] or 0) <= max_bytes for r in union.collect()}


def has_at_most(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """``have_at_most`` of one frame."""
    return have_at_most({"df": df}, max_rows, max_bytes)["df"]


def lookup_join(left: DataFrame, right: DataFrame, on, how: str = "inner",
                small: bool | None = None,
                max_broadcast_rows: int | None = None) -> DataFrame:
    """Join ``right`` (a lookup / dimension side) onto ``left``.

    * ``small=True``: the caller has proven ``right`` bounded (e.g. it is a
      projection of a dimension already checked) -- broadcast it;
    * ``small=False``: plain join, Spark plans it;
    * ``small=None`` with ``max_broadcast_rows``: count ``right`` and
      broadcast it only when it is within the bound;
    * otherwise Spark decides: its static size estimate and AQE's runtime
      sizes pick broadcast vs. shuffle join.
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        return left.join(right, on, how)
    if small is None and max_broadcast_rows:
        small = has_at_most(right, max_broadcast_rows)
    if small:
        right = F.broadcast(right)
    return left.join(right, on, how)


def keyed_join(left: DataFrame, right: DataFrame, keys=(), null_safe_keys=(),
               how: str = "left", max_broadcast_rows: int | None = None) -> DataFrame:
    """Equi-join on ``keys`` plus null-safe equality (``<=>``) on
    ``null_safe_keys``; right-side key columns are dropped.

    Null-safe keys remain hash/merge joinable (Catalyst rewrites them to
    ``coalesce`` + ``isnull`` key pairs).
    """
    keys, null_safe_keys = list(keys), list(null_safe_keys)
    all_keys = keys + null_safe_keys
    tag = {k: f"__r_{i}" for i, k in enumerate(all_keys)}
    r = right.select([F.col(quote(c)).alias(tag[c]) if c in tag else F.col(quote(c))
                      for c in right.columns])
    cond = [col_of(k) == F.col(tag[k]) for k in keys]
    cond += [col_of(k).eqNullSafe(F.col(tag[k])) for k in null_safe_keys]
    if max_broadcast_rows and has_at_most(r, max_broadcast_rows):
        r = F.broadcast(r)
    return left.join(r, reduce(lambda a, b: a & b, cond), how).drop(*tag.values())


def left_join_nullsafe_split(left: DataFrame, right: DataFrame, left_key: str,
                             right_key: str, take: list[str]) -> DataFrame:
    """Left join where NULL left keys bypass the shuffle.

    NULL keys never match, yet a shuffle join sends them all to one task.
    They are split off, given NULL right columns and unioned back.
    """
    r = right.select(F.col(quote(right_key)).alias("__rk"), *[col_of(c) for c in take])
    matched = left.where(col_of(left_key).isNotNull()) \
        .join(r, col_of(left_key) == F.col("__rk"), "left").drop("__rk")
    types = {f.name: f.dataType for f in r.schema.fields}
    nulls = left.where(col_of(left_key).isNull()) \
        .select("*", *[F.lit(None).cast(types[c]).alias(c) for c in take])
    return matched.unionByName(nulls)


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (anti join)."""
    p = parent.select(col_of(parent_key).alias("__pk")).distinct()
    return child.where(col_of(key).isNotNull()) \
        .join(p, col_of(key) == F.col("__pk"), "left_anti")


def select_keys(df: DataFrame, *cols: str) -> DataFrame:
    """Key-only projection of a dimension before joining (column pruning)."""
    return df.select(*[col_of(c) for c in cols])


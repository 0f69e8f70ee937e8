"""Per-key top-1: latest row per key and dominant match.

Both are ``row_number() ... = 1`` over a key partition. Catalyst plans a
partial WindowGroupLimit before the shuffle, so even a key holding a third
of all rows reaches the exchange as at most one row per input partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import col_of
from .joins import lookup_join

_RN = "__rn"


def _order(c: Column, descending: bool, nulls_win: bool) -> Column:
    if descending:
        return c.desc_nulls_first() if nulls_win else c.desc_nulls_last()
    return c.asc_nulls_first() if nulls_win else c.asc_nulls_last()


def latest_per_key(df: DataFrame, keys, order, tie_break=(), nulls_win: bool = True,
                   descending: bool = True) -> DataFrame:
    """Exactly one row per key: the one first by ``order`` (descending).

    ``nulls_win=True`` keeps the warehouse's literal rule (descending order
    puts an unknown date first, so it wins); ``False`` lets the latest known
    value win. ``tie_break`` (Columns or names, ascending) makes the pick
    deterministic. A NULL key is a key of its own.
    """
    ties = [t if isinstance(t, Column) else col_of(t).asc_nulls_last() for t in tie_break]
    w = Window.partitionBy(*[col_of(k) for k in keys]) \
        .orderBy(_order(col_of(order), descending, nulls_win), *ties)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def dominant_match(left: DataFrame, bridge: DataFrame, left_key: str, bridge_key: str,
                   weight: str, take: list[str], tie_break=(), exclude: Column | None = None,
                   nulls_win: bool = True, small: bool | None = None,
                   max_broadcast_rows: int | None = None) -> DataFrame:
    """Attach, to every ``left`` row, the bridge row with the largest
    ``weight`` for its key (many-to-many bridge, top-1 per key).

    ``exclude`` removes bridge rows before the pick (e.g. a sentinel code),
    so a real match never loses to a placeholder. Left rows are all kept;
    unmatched ones get NULLs. The picked side has one row per key, so the
    join cannot fan out.
    """
    b = bridge if exclude is None else bridge.where(exclude)
    best = latest_per_key(b, [bridge_key], weight, tie_break, nulls_win)
    best = best.select(col_of(bridge_key).alias("__bk"), *[col_of(c) for c in take])
    return lookup_join(left, best, col_of(left_key) == F.col("__bk"), "left", small,
                       max_broadcast_rows).drop("__bk")

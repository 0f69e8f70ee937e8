"""Text cleaning expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    """Accept a Column or a raw column name (spaces, '/', '+', '(' allowed)."""
    if isinstance(c, Column):
        return c
    return F.col(quote(c))


def quote(name: str) -> str:
    """Backtick-quote a column name so any character is taken literally."""
    return "`" + name.replace("`", "``") + "`"


def strip_ws(c) -> Column:
    """Strip leading/trailing whitespace of every kind (tabs, NBSP, ...).

    ``trim`` only removes spaces, while the loaders strip all whitespace.
    """
    c = col_of(c)
    return F.regexp_replace(F.regexp_replace(c, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def pad_id(c, width: int) -> Column:
    """Strip, then left-pad with zeros to ``width`` without ever truncating.

    Mirrors a string zero-fill: ids already at or over ``width`` stay whole,
    and a leading sign stays in front of the zeros. NULL stays NULL.
    """
    s = strip_ws(c)
    signed = s.startswith("-") | s.startswith("+")
    return (F.when(F.length(s) >= width, s)
            .when(signed, F.concat(F.substring(s, 1, 1),
                                   F.lpad(F.substring(s, 2, 1 << 30), width - 1, "0")))
            .otherwise(F.lpad(s, width, "0")))


def squash_upper(c) -> Column:
    """trim, drop inner spaces, upper-case (county normalisation)."""
    return F.upper(F.replace(F.trim(col_of(c)), F.lit(" "), F.lit("")))

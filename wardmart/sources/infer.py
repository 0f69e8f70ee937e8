"""Column types of delimited text from all of its values.

Every value has a class, and the classes form a lattice: missing below
boolean, integer and float; integer below float; everything below text. A
column's classes are or-ed as bits in one aggregate over the whole source
(one row a task is merged), so the result depends neither on the order of
rows nor on the splits, and the states of several extracts of one source can
be merged before a type is chosen. The types are those that the modelled
loader arrives at; a second pass casts strictly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col_of

MISSING, BOOLEAN, INTEGER, FLOAT, TEXT = 1, 2, 4, 8, 16

# numbers may stand between blanks; words for infinity are numbers too
_NUMBER = r"^[ \t]*+[-+]?(?:[0-9]++(?:\.[0-9]*+)?|\.[0-9]++)(?:[eE][-+]?[0-9]++)?[ \t]*+$"
_INFINITE = r"^[ \t]*[-+]?(?i:inf|infinity)[ \t]*$"
# what a number's text can begin with; most text is told by its first character
_STARTS = [*"0123456789+-. \tiI"]


def _number(c: Column) -> Column:
    return F.trim(c, F.lit(" \t"))


def value_class(c) -> Column:
    """Class bit of one text value; NULL is a missing one.

    Integers beyond 64 bits and finite literals beyond the doubles are text,
    since no number would keep them.
    """
    c = col_of(c)
    power = c.contains("e") | c.contains("E")
    return (F.when(c.isNull(), MISSING)
            .when(~F.substring(c, 1, 1).isin(_STARTS),
                  F.when(F.lower(c).isin("true", "false"), BOOLEAN).otherwise(TEXT))
            .when(c.rlike(_NUMBER), F.when(
                power | (c.contains(".") & (F.octet_length(c) > 300)),
                F.when(F.abs(_number(c).try_cast("double")) < float("inf"), FLOAT).otherwise(TEXT))
                .when(c.contains("."), FLOAT)               # 300 digits are finite
                .when(_number(c).try_cast("bigint").isNotNull(), INTEGER).otherwise(TEXT))
            .when(c.rlike(_INFINITE), FLOAT).otherwise(TEXT))


def column_classes(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """Classes met in each text column, from one pass over ``df``."""
    if not columns:
        return {}
    met = {r.i: r.c for r in class_rows(df, columns).collect()}
    return {c: met.get(i, MISSING) for i, c in enumerate(columns)}


def class_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """(i, c): classes of the i-th column; none if ``df`` has no rows.

    The values of a row become rows, so that one expression, small enough to
    be compiled, serves all columns; one row a column and task is shuffled.
    """
    values = df.select(F.posexplode(F.array(*[col_of(c) for c in columns])).alias("i", "v"))
    return values.groupBy("i").agg(F.bit_or(value_class("v")).alias("c"))


def merge_classes(*states: dict[str, int]) -> dict[str, int]:
    """Join of the states of several extracts; a column that an extract
    lacks is missing there."""
    names = dict.fromkeys(n for s in states for n in s)
    return {n: reduce(lambda a, s: a | s.get(n, MISSING), states, 0) for n in names}


def resolve(classes: int) -> str:
    """The Spark type of a column: text if the values have nothing better in
    common; bigint for integers throughout, double once one is missing or a
    float; an all-missing column is a double one."""
    values = classes & ~MISSING
    if values == BOOLEAN:
        return "boolean"
    if values & (TEXT | BOOLEAN):
        return "string"
    return "bigint" if classes == INTEGER else "double"


def cast_inferred(c, to: str) -> Column:
    """Strict cast of a text value to its inferred type."""
    c = col_of(c)
    if to == "string":
        return c
    if to == "boolean":
        return F.when(c.isNotNull(), F.lower(c) == "true")
    return _number(c).cast(to)

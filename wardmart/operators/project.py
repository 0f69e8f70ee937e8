"""Projections: rename lists and in-place cleaning."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame

from ..functions.text import col_of


def rename_project(df: DataFrame, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """Keep only the listed source columns, in list order, under new names.

    Source names may hold spaces and symbols (``Combined Outpatient +
    Inpatient Total Charges``); each is quoted, so nothing is parsed.
    """
    return df.select([col_of(src).alias(dst) for src, dst in pairs])


def clean_in_place(df: DataFrame, cleaners: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Every column unchanged and in place, except those in ``cleaners``.

    The column list comes from the frame's own schema (introspection), so
    the projection follows whatever the source table holds.
    """
    out = []
    for name in df.columns:
        c = col_of(name)
        out.append((cleaners[name](c) if name in cleaners else c).alias(name))
    return df.select(out)

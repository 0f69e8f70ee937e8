"""Delimited-file scans with explicit types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import pad_id, quote
from .infer import cast_inferred, column_classes, resolve

# The text tokens a pandas CSV reader turns into a missing
# value by default (pandas documentation, ``na_values``). Spark's CSV reader
# only nulls the empty string, so the rest are mapped here.
PANDAS_NA = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]


INTEGRAL = {"tinyint", "smallint", "int", "integer", "bigint", "long", "short", "byte"}


def normalize_na(df: DataFrame, na_values=PANDAS_NA) -> DataFrame:
    """Turn NA tokens into NULL in every string column, keeping column order."""
    tokens = list(na_values)
    out = []
    for f in df.schema.fields:
        c = F.col(quote(f.name))
        if isinstance(f.dataType, T.StringType):
            c = F.when(~c.isin(tokens), c)
        out.append(c.alias(f.name))
    return df.select(out)


def scan_csv(spark: SparkSession, path: str, types: dict[str, str] | None = None,
             str_columns=(), pad_columns: dict[str, int] | None = None,
             na_values=PANDAS_NA, sep: str = ",", multiline: bool = False, infer: bool = False) -> DataFrame:
    """Read a headed CSV by column name.

    Every column is read as text (so ids such as CCN ``010001`` keep their
    zeros -- schema inference would turn them into doubles), NA tokens become
    NULL, then ``types`` (name -> Spark SQL type) casts the measures.
    ``pad_columns`` (name -> width) strips and zero-pads id columns without
    truncating. Columns named nowhere stay strings, or with ``infer`` get
    the type that all their values allow (see ``infer``), from one more pass
    over the file; columns listed in ``str_columns`` are always text.
    Fields may be quoted, with doubled quotes inside (RFC 4180); a record
    with other fields than the header raises. The scan is split by file
    blocks; ``multiline`` reads fields with line breaks, and then each file
    is one task's.
    """
    raw = (spark.read.option("header", True).option("sep", sep)
           .option("quote", '"').option("escape", '"').option("mode", "FAILFAST")
           .option("inferSchema", False).option("multiLine", multiline).csv(path))
    df = normalize_na(raw, na_values)
    types = dict(types or {})
    for c in str_columns:
        types[c] = "string"
    pads = dict(pad_columns or {})
    found = column_classes(df, [c for c in df.columns if infer and c not in types and c not in pads])
    cols = []
    for name in df.columns:
        c = F.col(quote(name))
        if name in pads:
            c = pad_id(c, pads[name])
        target = types.get(name, "string")
        if name in found:
            c = cast_inferred(c, resolve(found[name]))
        elif target in INTEGRAL:
            # exports that typed a count column as float (it had blanks)
            # write '40.0': accept integral decimal text, still reject
            # fractions and junk through the strict cast
            c = F.when(c.rlike(r"^\s*[-+]?\d+\.0*\s*$"),
                       F.regexp_replace(c, r"\.0*\s*$", "")).otherwise(c).cast(target)
        elif target != "string":
            c = c.cast(target)
        cols.append(c.alias(name))
    return df.select(cols)

"""Surrogate keys: md5 over the text form of natural-key columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import col_of

# Fixed values (must equal the published surrogate-key macro so keys built
# elsewhere from the same natural keys agree): the NULL placeholder and the
# separator placed between columns.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*cols) -> Column:
    """md5 hex of the natural-key columns' text forms joined by '-'.

    NULL parts become a fixed token, so a NULL key still hashes (a NULL metro
    is a real group). Callers should pass string columns: a key that went
    double hashes as '1.0', not '1'.
    """
    parts = [F.coalesce(col_of(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    body = parts[0] if len(parts) == 1 else F.concat_ws(SEPARATOR, *parts)
    return F.md5(body)


def is_md5(key: str) -> Column:
    """Whether a column's text is an MD5 as ``surrogate_key`` writes it."""
    return F.coalesce(col_of(key).rlike(r"^[0-9a-f]{32}\z"), F.lit(False))


def key_bytes(key: str) -> Column:
    """A column's text as bytes that tell all texts apart: 16 for an MD5,
    more than 17 or exactly 17 (the empty one) for others."""
    return F.when(is_md5(key), F.unhex(col_of(key))).otherwise(F.concat(F.lit(bytes(17)), col_of(key).cast("binary")))


def key_text(key: str) -> Column:
    """The text that ``key_bytes`` made the bytes of."""
    return F.when(F.octet_length(col_of(key)) == 16, F.lower(F.hex(col_of(key)))) \
        .otherwise(F.substring(col_of(key), 18, 1 << 30).cast("string"))


def dealt_packed(df: DataFrame, n: int, on: str, keys: list[str]) -> DataFrame:
    """``df.repartition(n, on)`` that carries the MD5 texts ``keys`` as 16
    bytes; other texts stay text. Rows meet by the text of ``on``."""
    at = {k: (f"__bytes{i}", f"__text{i}") for i, k in enumerate(keys)}
    packed = df.withColumns({name: c for k, (b, t) in at.items() for name, c in (
        (b, F.when(is_md5(k), F.unhex(col_of(k)))), (t, F.when(~is_md5(k), col_of(k))))}).drop(*keys)
    text = {k: F.coalesce(F.lower(F.hex(b)), F.col(t)) for k, (b, t) in at.items()}
    dealt = packed.repartition(n, text.get(on, col_of(on)))
    return dealt.select([text[c].alias(c) if c in at else col_of(c) for c in df.columns])
